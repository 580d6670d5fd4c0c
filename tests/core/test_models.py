"""Models on columns: once a worker, in batches, with errors as flags."""

import os
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from quernstone.functions import models
from quernstone.operators import frontend
from quernstone.plans import registry


def counting(folder):
    """Makes a model that leaves a file for each time it is made and each batch it is asked."""

    def make():
        open(f"{folder}/made-{os.getpid()}-{uuid.uuid4().hex}", "w").close()

        def say(texts):
            open(f"{folder}/asked-{len(texts)}-{max(map(len, texts))}-{uuid.uuid4().hex}", "w").close()
            if any("!" in t for t in texts):
                raise ValueError("can't say !")
            return [t.replace("x ", "x").upper() for t in texts]

        return say

    return make


def test_a_model_is_made_once_a_worker_and_its_errors_are_flags(spark, tmp_path):
    rng = random.Random(1)
    rows = [(k, rng.choice([None, "", "a b", "x a", "a !", "x !", "word " * rng.randrange(1, 40) + "end"])) for k in range(600)]
    df = spark.createDataFrame(rows, "k int, t string").repartition(6)
    found = df.select("k", "t", models.sounds_of(F.col("t"), counting(str(tmp_path)), batch=16).alias("s"))
    for _ in range(2):
        got = {r.k: r.s for r in found.collect()}
        for k, t in rows:
            if t and "!" in t:
                assert got[k].sounds is None and got[k].error == "ValueError: can't say !"
            else:
                t = t or ""
                assert got[k].error is None and got[k].sounds == t.replace("x ", "x").upper()
                assert got[k].word_sounds == (["X", "A"] if t == "x a" else None)
    made = [f.split("-")[1] for f in os.listdir(tmp_path) if f.startswith("made")]
    assert made and len(made) == len(set(made))
    asked = [f.split("-")[1:3] for f in os.listdir(tmp_path) if f.startswith("asked")]
    assert max(int(n) for n, _ in asked) == 16


def test_a_filter_on_the_result_asks_no_more(spark, tmp_path):
    df = spark.createDataFrame([(k, f"w{k}") for k in range(40)], "k int, t string").coalesce(1)
    rows = frontend.phonemize(df.withColumn("text", F.lit("اب ق")), counting(str(tmp_path)), F.array(F.lit("z")))
    assert rows.filter("error is null and n_words = 2").count() == 40
    assert sum(int(f.split("-")[1]) for f in os.listdir(tmp_path) if f.startswith("asked")) == 40


def test_batches_by_length():
    rng = np.random.default_rng(3)
    for most, padded in ((64, 1 << 20), (5, 100), (1, 1), (64, 50)):
        lengths = rng.integers(1, 60, 300)
        parts = list(models.batches_by_length(lengths, most, padded))
        assert sorted(np.concatenate(parts).tolist()) == list(range(300))
        assert all(len(p) <= most and (len(p) == 1 or len(p) * lengths[p].max() <= padded) for p in parts)
    assert list(models.batches_by_length(np.array([], np.int64), 4, 4)) == []


def test_counters_count_errors(spark):
    rows = spark.createDataFrame([("قب ا ب",), ("ب @",), (None,), ("",), ("abc ق",)], "text string")
    got = frontend.phonemize(rows, registry.Speller, F.array(F.lit("z")))
    assert [r.spoken for r in got.collect()] == ["ɡb a b", "", "", "", "ɡ"]
    c = frontend.counters(got).first()
    assert (c.sentences, c.errors, c.words, c.q_words, c.q_kept, c.misaligned_sentences, c.latin_dropped) == (5, 1, 4, 2, 0, 1, 1)
    plain = frontend.phonemize(rows, registry.Speller, F.array(F.lit("z")), dialect=False).collect()
    assert [r.spoken for r in plain] == ["qb ab", "", "", "", "q"] and plain[1].error == "ValueError: no sound for @"


def test_phonemize_has_all_kinds_of_rows(spark, sf_dir):
    c = frontend.counters(registry.QUERIES["phonemize"](spark, sf_dir).withColumn("text", F.lit(""))).first()
    assert c.sentences == 200 and c.errors > 0 and c.misaligned_sentences > 0 and c.q_words > 100


def test_gate_has_all_branches(spark, sf_dir):
    assert {r.gate: r.verdict for r in registry.QUERIES["frontend_gate"](spark, sf_dir).collect()} == {"letters": "FAIL", "all": "WARN", "aligned": "PASS"}


def test_encode_clips_by_brute_force(spark, sf_dir):
    waves = {r.vec_id: np.array(r.embedding[: r.vec_id % 60], np.float32) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    got = {r.vec_id: r for r in registry.QUERIES["encode_clips"](spark, sf_dir).collect()}
    assert got.keys() == waves.keys()
    for k, x in waves.items():
        if len(x) < 8:
            assert got[k].vector is None and got[k].error == ("ValueError: too short" if len(x) else None)
        else:
            v = np.array([x[j::4].sum(dtype=np.float64) for j in range(4)])
            assert got[k].error is None and got[k].vector == pytest.approx(v / np.linalg.norm(v), abs=2e-3)
            assert all(float(np.float16(y)) == y for y in got[k].vector)


def test_vectors_without_length_are_errors(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, [3.0, 4.0]), (3, [float("nan"), 1.0]), (4, [])], "k int, x array<float>")
    make = lambda: lambda padded, shares: padded
    got = {r.k: (r.e.vector, r.e.error) for r in rows.select("k", models.encoded(F.col("x"), make, half=False).alias("e")).collect()}
    assert got[1] == (None, "no vector") == got[3] and got[4] == (None, None) and got[2][0] == pytest.approx([0.6, 0.8])
