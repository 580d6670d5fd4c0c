"""What the review of round 3 found, each at small size."""

from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from quernstone.functions import alignment, models
from quernstone.operators import frontend, pairs, pools
from quernstone.plans import registry


def test_every_turn_is_scored_against_itself(spark, sf_dir):
    """each turn without some of its words is a pair, and each but a conversation's last with the next."""
    turns = [(r.conv_id, r.turn) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn").collect()]
    want = {10**9 + c * 1000 + k for c, k in turns} | {c * 1000 + k for c, k in turns if (c, k + 1) in set(turns)}
    assert {r.idx for r in registry.QUERIES["edit_distance"](spark, sf_dir).collect()} == want
    con = duckdb.connect()
    con.execute("create view conversations as select * from '" + sf_dir + "/conversations.parquet'")
    for t in ("documents", "labels", "events", "embeddings"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    assert {r[0] for r in con.execute(registry.ORACLE_SQL["edit_distance"]).fetchall()} == want


def test_pairs_are_multiplied_once_and_counted_exactly(spark, monkeypatch):
    """more rows than a tile, null groups, repeated keys; blocks without and with a given size."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(150, 4)).round(2)
    rows = [(k % 140, [None, 0, 1, 2, 3][k % 5], [float(x) for x in v[k]]) for k in range(150)]
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = Counter()
    for i in range(150):
        for j in range(150):
            if rows[i][0] != rows[j][0]:
                same = rows[i][1] is not None and rows[i][1] == rows[j][1]
                want["within" if same else "across", int(np.rint(u[i] @ u[j] * 10**6))] += 1
    monkeypatch.setattr(pairs, "TILE", 16)
    df = spark.createDataFrame(rows, "k int, g int, v array<double>")
    for block in (None, 40, 1000):
        found = pairs.cosine_counts(df, "k", "g", "v", block)
        assert {(r.scope, round(r.cos * 10**6)): r.n for r in found.collect()} == want
    sent = pairs.cosine_counts(df, "k", "g", "v")._jdf.queryExecution().toString()
    assert "(a#" in sent and " < b#" in sent  # blocks meet in one order alone


def test_a_sample_sorts_some_rows_alone(spark):
    """of many tasks' rows only those are sorted that can be drawn."""
    rows = spark.range(40_000).select(F.col("id").cast("string").alias("k"), F.repeat(F.lit("x"), 60).alias("t")).repartition(20)
    rows = rows.unionByName(spark.createDataFrame([(None, "n")], "k string, t string"))
    want = [r.k for r in rows.orderBy(*pools.shuffled("k")).limit(300).collect()]
    found = pools.sample(rows, "k", 300)
    assert [r.k for r in found.collect()] == want and want[0] is None
    metrics = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in metrics and "substring(md5" in metrics
    assert pools.sample(rows, "k", 50_000).count() == 40_001
    assert pools.sample(rows.limit(0), "k", 5).count() == 0


def test_batches_are_worked_on_in_slices(spark):
    """F5, F7, F8: what is made of a batch is held for some rows and characters at a time, in the same order."""
    for lengths, most, chars, want in (([3] * 5, 2, 100, [2, 2, 1]), ([3, 9, 1, 1, 8], 9, 8, [1, 1, 2, 1]), ([], 2, 2, [0]), ([50], 2, 2, [1])):
        parts = [range(len(lengths))[s] for s in models.slices_of(iter(lengths), most, chars)]
        assert [len(p) for p in parts] == want and [k for p in parts for k in p] == list(range(len(lengths)))
    texts = [None, "", "a b. c", "x, y" * 700_000] + [f"w{k} a ق. b" for k in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").coalesce(1)

    def make():
        def say(asked):
            assert len(asked) <= 64
            return [t.replace(" a ", " a") for t in asked]

        return say

    out = df.select("k", "t", models.sounds_of(F.col("t"), make).alias("s"), alignment.recover_marks(F.col("t"), F.col("t"), F.lit(None).cast("string")).alias("r"), alignment.chunk_text(F.col("t"), 50, "abcxy ").alias("c"))
    rows = sorted(out.collect())
    assert [r.k for r in rows] == list(range(len(texts)))
    for r in rows:
        assert r.s.error is None and r.s.sounds == (r.t or "").replace(" a ", " a")
        assert (r.r.text, r.r.coverage) == alignment.recover(r.t, r.t, None)
        assert [tuple(c) for c in r.c] == alignment.chunk(r.t, 50, frozenset("abcxy "))


def test_gates_read_the_rows_once(spark, tmp_path):
    """three gates over one pass, as over the rows themselves."""
    rows = [("ab c", False, 3), ("", False, 0), (None, True, 2), ("bق", False, 1), (None, True, 4)]
    touched = spark.sparkContext.accumulator(0)

    def told(x):
        touched.add(1)
        return x

    df = spark.createDataFrame(spark.sparkContext.parallelize(rows).map(told), "spoken string, misaligned boolean, n_words long")
    tally = frontend.tallied(df)
    seen = touched.value
    plain = df.withColumns({"n_q_words": F.lit(0), "n_q_kept": F.lit(0), "text": F.lit("")})
    for keep in ("true", "not misaligned", "spoken = 'none'"):
        for symbols in ("ab ", "abc ق", ""):
            known = spark.createDataFrame([(s,) for s in symbols], "symbol string")
            before = touched.value
            got = frontend.tallied_gate(tally.filter(keep) if "spoken" not in keep else tally.filter("false"), known).collect()
            assert touched.value == before
            assert got == frontend.gate(frontend.oov_count(plain.filter(keep), "spoken", known), frontend.counters(plain.filter(keep))).collect()
    assert seen == len(rows)
