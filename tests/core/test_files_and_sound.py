"""Sources, sinks and waveform measures, on files written here."""

import io
import random
import wave

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quernstone.functions import audio, vectors
from quernstone.operators import pairs, quality
from quernstone.sources import corpus, sinks
from quernstone.streaming import incremental


def wav(x, rate=24_000, channels=1, width=2):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes((np.asarray(x) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def test_shards_with_missing_columns_and_bad_files(spark, tmp_path):
    d = tmp_path / "data"
    d.mkdir()
    pq.write_table(pa.table({"audio_file": ["a"], "duration": [1.0], "extra": [1]}), d / "train-0.parquet")
    pq.write_table(pa.table({"audio_file": ["b"], "snr_db": [2.0]}), d / "train-1.parquet")
    pq.write_table(pa.table({"audio_file": ["c"]}), d / "val-0.parquet")
    got = corpus.shards(spark, str(d), "train")
    assert sorted((r.audio_file, r.duration, r.snr_db, r.text) for r in got.collect()) == [("a", 1.0, None, None), ("b", None, 2.0, None)]
    assert "extra" in corpus.shards(spark, str(d), "train", None).columns
    first = corpus.shard_paths(spark, str(d), "train", 1)
    assert len(first) == 1 and corpus.shards(spark, first, "train").first().audio_file == "a"
    (d / "train-2.parquet").write_bytes(b"not parquet")
    assert corpus.shards(spark, str(d), "train", skip_bad=True).count() == 2
    pq.write_table(pa.table({"audio_file": pa.array([], pa.string())}), d / "train-3.parquet")
    (d / "train-4.parquet").write_bytes((d / "train-0.parquet").read_bytes()[:-40])
    (d / "train-5.parquet").write_bytes(b"")  # not listed
    audit = {r.path.rsplit("/", 1)[1]: (r.rows, r.columns, r.error is None) for r in corpus.shard_audit(spark, str(d), "train").collect()}
    good = {"train-0.parquet": (1, "audio_file string, duration double, extra int64", True), "train-1.parquet": (1, "audio_file string, snr_db double", True), "train-3.parquet": (0, "audio_file string", True)}
    assert audit == good | {f"train-{k}.parquet": (None, None, False) for k in (2, 4)}


def test_an_audit_of_a_store_that_only_spark_opens(spark, tmp_path, monkeypatch):
    pq.write_table(pa.table({"audio_file": ["a", "b"]}), tmp_path / "train-0.parquet")
    (tmp_path / "train-1.parquet").write_bytes(b"not parquet")
    assert corpus._footer("viewfs://store/x.parquet") == (None, None, None)
    found = corpus.shard_audit(spark, str(tmp_path), "train").collect()
    assert {(r.rows, r.error is None) for r in found} == {(2, True), (None, False)}


def test_lines_of_split_files(spark, tmp_path):
    rng = random.Random(3)
    lines = ["x" * rng.randrange(60) + str(k) for k in range(4000)]
    lines[7] = ""
    (tmp_path / "long.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    log = [f"Step [{k}] Loss: {k}.5, Disc Loss: 1.0, Gen Loss: 2.0" if k % 3 else f"note {k}" for k in range(3000)]
    (tmp_path / "log").write_text("\r\n".join(log), encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for most in ("1500", "100000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            assert spark.read.text(str(tmp_path / "long.txt")).rdd.getNumPartitions() > (20 if most == "1500" else 0)
            got = {r.idx: r.value for r in corpus.indexed_lines(spark, str(tmp_path / "long.txt")).collect()}
            assert got == dict(enumerate(lines))
            assert tuple(corpus.last_losses(spark, str(tmp_path / "log")).first()) == (2999.5, 1.0, 2.0)
            (tmp_path / "none").write_text("")
            assert corpus.indexed_lines(spark, str(tmp_path / "none")).collect() == [] == corpus.last_losses(spark, str(tmp_path / "none")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_sound_files(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(f"d/clip.{k}.wav", f"s{k % 3}" if k % 7 else "a/b", [float(x) for x in rng.uniform(-1, 1, 30 + k)]) for k in range(40)]
    df = spark.createDataFrame(rows + [("n.wav", "s1", None), (None, "s1", [0.1])], "audio_file string, speaker string, samples array<float>").repartition(5)
    sinks.write_sounds(df, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["_SUCCESS", "a_b", "s0", "s1", "s2"]
    got = {r.path.split("/out/")[1]: r.samples for s in ("a_b", "s0", "s1", "s2") for r in corpus.wav_directory(spark, str(tmp_path / "out" / s)).collect()}
    assert got.keys() == {f"{s.replace('/', '_')}/clip.{k}.wav" for k, (_, s, _) in enumerate(rows)}
    assert all(np.allclose(got[f"{s.replace('/', '_')}/clip.{k}.wav"], x, atol=1e-4) for k, (_, s, x) in enumerate(rows))
    with pytest.raises(Exception, match="two rows have this name"):
        sinks.write_sounds(df, str(tmp_path / "out"))
    sinks.write_sounds(df.limit(3), str(tmp_path / "out"), mode="overwrite")
    assert not (tmp_path / "out" / "_temporary").exists()


def test_a_failed_attempt_leaves_no_file(tmp_path):
    batch = pa.record_batch({"name": ["s/a.wav", "s/b.wav"], "samples": [[0.5] * 9, [0.25] * 9]})

    def failing():
        yield batch
        raise RuntimeError("executor lost")

    writer = sinks.SoundWriter(str(tmp_path), 24_000, False)
    with pytest.raises(RuntimeError):
        writer.write(failing())
    again = writer.write(iter([batch]))
    assert not (tmp_path / "s").exists() and again.files == 2
    writer.commit([again, None])
    assert sorted(p.name for p in (tmp_path / "s").iterdir()) == ["a.wav", "b.wav"] and not (tmp_path / "_temporary").exists()
    other = sinks.SoundWriter(str(tmp_path / "x"), 24_000, False)
    other.abort([other.write(iter([batch]))])
    assert not list((tmp_path / "x").iterdir())


def test_line_files(spark, tmp_path):
    (tmp_path / "e.tsv").write_text("#c\tx\nno tab\nk\ta\tb\n", encoding="utf-8")
    assert [tuple(r) for r in corpus.evaluation_set(spark, str(tmp_path / "e.tsv")).collect()] == [("k", "a\tb")]
    (tmp_path / "s.txt").write_text("one\ntwo\nthree\n", encoding="utf-8")
    (tmp_path / "c.txt").write_text("x\ny\n", encoding="utf-8")
    got = sorted(tuple(r) for r in corpus.scored_lines(spark, str(tmp_path / "s.txt"), str(tmp_path / "c.txt")).select("idx", "ref", "category").collect())
    assert got == [(0, "one", "x"), (1, "two", "y"), (2, "three", "all")]
    assert {r.category for r in corpus.scored_lines(spark, str(tmp_path / "s.txt")).collect()} == {"all"}
    (tmp_path / "l.txt").write_text("القُرآن # c\n\n# only\nفقه\n", encoding="utf-8")
    assert sorted(r.word for r in corpus.lexicon(spark, str(tmp_path / "l.txt"), ["فقه"]).collect()) == ["القران", "فقه"]
    (tmp_path / "w.txt").write_text(" a\nb \n", encoding="utf-8")
    assert corpus.whole_text(spark, str(tmp_path / "w.txt")).first().text == "a\nb"
    (tmp_path / "c.yml").write_text("log_dir: out/x  # c\nother: 1\n", encoding="utf-8")
    (tmp_path / "log").write_text("Step [1] Loss: 9.0, Disc Loss: 1.0, Gen Loss: 2.0\nStep [2] Loss: 0.5, Disc Loss: 1.5, Gen Loss: 2.5\ndone\n", encoding="utf-8")
    assert tuple(corpus.last_losses(spark, str(tmp_path / "log")).first()) == (0.5, 1.5, 2.5)
    hyps = spark.createDataFrame([(1, "h")], "idx int, hyp string")
    assert [(r.idx, r.hyp) for r in corpus.with_hypotheses(corpus.default_set(spark, ["a", "b"]), hyps).collect()] == [(1, "h")]
    assert corpus.setting(spark, str(tmp_path / "c.yml"), "log_dir").first().value == "out/x"


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("d/clip.a.wav", "s1", "p" * 20, 0), ("x.wav", "s2", "short", 1)], "audio_file string, speaker string, phonemes string, speaker_id int")
    assert [r.line for r in sinks.train_lines(rows).collect()] == ["s1/clip.a.wav|" + "p" * 20 + "|0"]
    sinks.write_lines(sinks.train_lines(rows), str(tmp_path / "list"))
    assert spark.read.text(str(tmp_path / "list")).count() == 1
    sinks.write_table(rows, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    sinks.write_chunks(spark.createDataFrame([(3, 1.5, "stop", "a b")], "idx int, dur double, kind string, text string"), str(tmp_path / "c"))
    assert spark.read.text(str(tmp_path / "c")).first().value == "03\t1.50s\tstop\ta b"
    sinks.write_aligned(corpus.default_set(spark, ["x"]), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).columns == ["idx", "text", "category"]
    sinks.rewrite_marks(spark.createDataFrame([("\u0634\u064e\u0651",)], "value string"), str(tmp_path / "m"))
    assert spark.read.text(str(tmp_path / "m")).first().value == "\u0634\u0651\u064e"


def test_wav_round_trip(spark, tmp_path):
    x = np.sin(np.arange(4000) / 10) / 2
    rows = [(wav(x),), (b"junk",), (None,), (wav(x[:10]),), (wav(x, 8000),), (wav(x, channels=2),)]
    df = spark.createDataFrame(rows, "b binary")
    got = [r[0] for r in df.select(corpus.decode_wav(F.col("b"), 24_000, 100)).collect()]
    assert [g is not None for g in got] == [True, False, False, False, False, False]
    assert np.allclose(got[0].samples, x, atol=1e-3) and got[0].rate == 24_000
    for k, r in enumerate(rows[-2:]):
        (tmp_path / f"{k}.wav").write_bytes(r[0])
    assert sorted((r.rate, len(r.samples)) for r in corpus.wav_directory(spark, str(tmp_path)).collect()) == [(8000, 4000), (24_000, 2000)]
    back = df.limit(1).select(sinks.encode_wav(corpus.decode_wav(F.col("b"))["samples"]).alias("b")).select(corpus.decode_wav(F.col("b")).alias("w")).first().w
    assert np.allclose(back.samples, x, atol=1e-3)


def tone(hz, n=24_000, rate=24_000):
    return np.sin(2 * np.pi * hz * np.arange(n) / rate).astype(np.float32)


def test_spectra():
    rng = np.random.default_rng(0)
    noise, low, high = rng.normal(size=24_000) / 10, tone(1000), tone(9500)
    p = audio.profile_of(low + 1e-6 * noise)
    assert p["high_low_db"] < -80 and abs(p["centroid_hz"] - 1000) < 50
    assert audio.profile_of(noise)["flatness"] > 0.5 and audio.profile_of(noise)["dead_frac"] == 0
    assert audio.profile_of(noise + high)["pkmean_9_10k"] > 10 > audio.profile_of(noise)["pkmean_9_10k"]
    b = audio.bands_of(noise + high)
    assert b["pkmean_8_10k"] > 5 and b["db_8_10k"] > b["db_10_12k"] and set(b) == set(audio.BANDS)
    assert set(p) == set(audio.PROFILE) and audio.profile_of(noise[:100]) is None is audio.bands_of(noise[:100])


def test_sound_columns(spark):
    x = np.concatenate([np.zeros(5000), tone(500, 6000) / 2, np.zeros(5000)])
    df = spark.createDataFrame([([float(v) for v in x],), ([0.0] * 3000,), ([0.1] * 10,)], "s array<float>")
    rows = df.select("s", audio.band_profile(F.col("s")).alias("p"), audio.bands(F.col("s")).alias("b"), audio.trim_silence(F.col("s")).alias("t"), vectors.peak_normalize(F.col("s")).alias("n"), quality.audible("s").alias("a"), F.size(vectors.frames(F.col("s"))).alias("f"), F.size(audio.with_pause(F.col("s"), F.lit("comma"))).alias("z"), audio.retained_power(F.col("s"), F.col("s")).alias("k")).collect()
    assert rows[0].p is not None and rows[2].p is None is rows[2].b
    assert 6000 < len(rows[0].t) < 7000 and abs(rows[0].t[0]) < 1e-6 and len(rows[1].t) == 3000
    assert max(abs(v) for v in rows[0].n) == pytest.approx(0.95) and rows[1].n is None
    assert [r.a for r in rows] == [True, False, True] and [r.f for r in rows] == [28, 2, 0]
    assert rows[2].z == 10 + int(0.22 * 24_000) and rows[0].k == pytest.approx(1.0)


def test_pairs_by_blocks(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(60, 8))
    rows = [(k, k % 3, [float(x) for x in v[k]]) for k in range(60)]
    got = {r.scope: r for r in pairs.similarity_report(pairs.cosine_counts(spark.createDataFrame(rows, "k int, g int, v array<double>"), "k", "g", "v", block=13)).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s, same = u @ u.T, np.equal.outer(np.arange(60) % 3, np.arange(60) % 3)
    for scope, mask in (("within", same & ~np.eye(60, dtype=bool)), ("across", ~same)):
        c = s[mask]
        assert got[scope].n == c.size and np.allclose([got[scope].mean, got[scope].p10, got[scope].p90], [c.mean(), *np.percentile(c, [10, 90])], atol=2e-6)


def test_stream_filters_new_shards(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    for k, d in enumerate((5.0, 50.0)):
        pq.write_table(pa.table({"audio_file": [f"f{k}"], "speaker": ["s"], "duration": [d]}), src / f"train-{k}.parquet")
        incremental.filter_new_shards(spark, str(src), str(out), str(tmp_path / "state")).awaitTermination()
    assert [r.audio_file for r in spark.read.parquet(str(out)).collect()] == ["f0"]


def test_band_measures_against_loops():
    import numpy as np

    rng = np.random.default_rng(5)
    x = rng.normal(size=9000) * 0.1 + np.sin(np.arange(9000) * 2.4)
    frames = [x[k : k + 2048] * np.hanning(2048) for k in range(0, 9000 - 2047, 512)]
    hz, amplitude = np.fft.rfftfreq(2048, 1 / 24_000), [np.abs(np.fft.rfft(f)) for f in frames]
    part = lambda lo, hi: [k for k, h in enumerate(hz) if lo <= h < hi]
    power = [a**2 for a in amplitude]
    low, high = (np.mean([sum(p[k] for k in part(*b)) for p in power]) for b in ((300, 8000), (8200, 11_500)))
    flat = np.mean([np.exp(np.mean([np.log(p[k] + 1e-20) for k in part(8200, 11_500)])) for p in power]) / np.mean([[p[k] for k in part(8200, 11_500)] for p in power])
    got, mean = audio.profile_of(x), np.mean(power, axis=0)
    assert np.isclose(got["high_low_db"], 10 * np.log10(high / low)) and np.isclose(got["flatness"], flat)
    assert np.isclose(got["centroid_hz"], sum(p @ hz for p in power) / np.sum(power))
    for k in range(7, 12):
        m = mean[part(1000 * k, 1000 * k + 1000)]
        assert np.isclose(got[f"pkmean_{k}_{k + 1}k"], m.max() / m.mean()) and np.isclose(got[f"db_{k}_{k + 1}k"], 10 * np.log10(m.mean() / mean.max()))
    got = audio.bands_of(x)
    for a, b in audio.BAND_EDGES:
        m = np.array([f[part(1000 * a, 1000 * b)] for f in amplitude])
        assert np.isclose(got[f"db_{a}_{b}k"], 20 * np.log10(m.mean())) and np.isclose(got[f"pkmean_{a}_{b}k"], m.max(axis=1).mean() / m.mean())


def test_trim_of_planted_silence():
    import numpy as np

    x = np.concatenate([np.zeros(3000), np.full(2000, 0.5), np.zeros(100), np.full(500, -0.5), np.zeros(2000)]).astype(np.float32)
    got = audio.trimmed(x)
    want = x[3000 - 480 : 5599 + 480].copy()
    want[:120] *= np.linspace(0, 1, 120, dtype=np.float32)
    want[-120:] *= np.linspace(1, 0, 120, dtype=np.float32)
    assert np.allclose(got, want) and len(got) == len(want)
    assert len(audio.trimmed(x[:3000])) == 3000 and len(audio.trimmed(np.full(100, 0.1, np.float32))) == 100 and len(audio.trimmed(x[:0])) == 0
