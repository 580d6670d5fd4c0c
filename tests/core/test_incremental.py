"""State over arriving shards, against one pass over all of them."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quernstone.operators import cohort, pools
from quernstone.sources import corpus
from quernstone.streaming import incremental


def shards(rng, folder, names):
    folder.mkdir()
    for name in names:
        n = rng.randrange(1, 60)
        rows = {
            "audio_file": [f"{rng.randrange(10**6):06d}-{name}-{k}" for k in range(n)],
            "speaker": [rng.choice(["hot", "hot", "hot", "a", "b", None]) for _ in range(n)],
            "video_id": [rng.choice(["v1", "v2", None]) for _ in range(n)],
            "duration": [rng.choice([None, 1.5, 2.25, 8.0]) for _ in range(n)],
            "squim_mos": [rng.choice([None, float("nan"), 4.0, 4.25, rng.random()]) for _ in range(n)],
            "snr_db": [rng.choice([None, 20.0, 25.5]) for _ in range(n)],
        }
        yield name, pa.table(rows, pa.schema([("audio_file", pa.string()), ("speaker", pa.string()), ("video_id", pa.string()), ("duration", pa.float64()), ("squim_mos", pa.float64()), ("snr_db", pa.float64())]))


def test_caps_and_profiles_over_arriving_shards(spark, tmp_path):
    rng = random.Random(5)
    valid = F.col("duration").isNotNull()
    arriving = list(shards(rng, tmp_path / "in", [f"train-{k}" for k in range(6)]))
    rng.shuffle(arriving)
    assert incremental.current(spark, str(tmp_path / "caps")) is None
    for step in range(0, 6, 2):  # the stream is started anew for each pair of shards, which come in any order
        for name, table in arriving[step : step + 2]:
            pq.write_table(table, tmp_path / "in" / f"{name}.parquet")
        incremental.cap_new_shards(spark, str(tmp_path / "in"), str(tmp_path / "caps"), str(tmp_path / "s1"), cap=7, valid=valid, files=1).awaitTermination()
        incremental.profile_new_shards(spark, str(tmp_path / "in"), str(tmp_path / "counts"), str(tmp_path / "s2"), files=1).awaitTermination()
        every = corpus.shards(spark, str(tmp_path / "in"), "train")
        want = pools.cap_per_key(every, "speaker", "audio_file", 7, valid)
        got = incremental.current(spark, str(tmp_path / "caps"))
        assert sorted(map(repr, got.select("speaker", "audio_file", "duration").collect())) == sorted(map(repr, want.select("speaker", "audio_file", "duration").collect()))
        counts = incremental.current(spark, str(tmp_path / "counts"))
        assert incremental.totals_of(counts).first() == cohort.corpus_totals(every).first()
        profiles = {r.speaker: (r.hours, r.squim, r.snr) for r in cohort.speaker_profile(every.withColumn("f0_speaker", F.lit(1.0))).collect()}
        found = {r.speaker: (r.hours, r.squim, r.snr) for r in incremental.profiles_of(counts).collect()}
        assert found.keys() == profiles.keys()
        assert all(x == (None if y is None else pytest.approx(y)) for k in found for x, y in zip(found[k], profiles[k]))
    assert len(list((tmp_path / "caps").iterdir())) <= 3


def test_a_repeated_batch_counts_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", "v", 2.0, 4.0, None)], "speaker string, video_id string, duration double, squim_mos double, snr_db double")
    merged = lambda before: incremental.partial_profiles(rows) if before is None else incremental.merged_profiles(before, incremental.partial_profiles(rows))
    for batch in (0, 1, 1, 2, 2, 2):
        incremental._advance(spark, str(tmp_path / "t"), batch, merged)
    assert incremental.totals_of(incremental.current(spark, str(tmp_path / "t"))).first().n_rows == 3
