"""Sums and places in two levels, against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quernstone.operators import cohort
from quernstone.operators.scans import islands, places, running_before
from quernstone.plans.registry import QUERIES


def test_running_sums_by_brute_force(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice([None, 0.0, 0.5, 2.25]), f"x{rng.randrange(9)}") for k in rng.sample(range(1000), 400)]
    df = spark.createDataFrame(rows, "k long, amount double, before string")
    want, total = {}, 0.0
    for k, amount, _ in sorted(rows, reverse=True):
        want[k] = total
        total += amount or 0.0
    for parts in (None, 1, 7, 64):
        got = {r.k: r.before for r in running_before(df, [F.desc("k")], F.col("amount"), parts=parts).collect()}
        assert got == want
        short = {r.k: r.before for r in running_before(df, [F.desc("k")], F.col("amount"), parts=parts, below=30.25).collect()}
        assert short == {k: v for k, v in want.items() if v < 30.25}
        assert {r.k: r.place for r in places(df, [F.col("k")], parts=parts).collect()} == {k: n for n, k in enumerate(sorted(want))}
    assert running_before(df.limit(0), [F.col("k")]).collect() == [] and places(df.limit(0), [F.col("k")]).collect() == []


def test_equal_keys_get_neighbouring_places(spark):
    df = spark.createDataFrame([(1,)] * 50 + [(None,)] * 20 + [(2,)] * 30, "k long")
    got = sorted((r.place, r.k) for r in places(df, [F.asc_nulls_last("k")], parts=5).collect())
    assert got == [(n, 1 if n < 50 else 2 if n < 80 else None) for n in range(100)]


def test_greedy_prefix_takes_the_row_that_reaches_the_budget(spark):
    rows = spark.createDataFrame([("a", 10.0, 0.9), ("b", 10.0, 0.8), ("c", 10.0, 0.7), ("d", 1.0, 0.6)], "speaker string, hours double, cos double")
    assert [r.speaker for r in cohort.greedy_prefix(rows, 25.0).orderBy("speaker").collect()] == ["a", "b", "c"]
    assert [r.speaker for r in cohort.greedy_prefix(rows, 10.0).collect()] == ["a"]


def test_islands_by_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for k in range(500):
        start = float(rng.choice([rng.randrange(0, 3000), 40, 41]))
        rows.append((k, rng.choice(["hot", "hot", "hot", "a", None]), rng.choice([start, start, start, None]), rng.choice([start + rng.choice([0, 1, 3, 9]), start + 2, start - 1, None])))
    rows.append((999, "hot", 100.0, 700.0))
    want = {}
    for key in ("hot", "a", None):
        reach, number = None, -1
        for k, _, start, end in sorted((r for r in rows if r[1] == key and None not in r[2:] and r[2] <= r[3]), key=lambda r: (r[2], r[3], r[0])):
            number += reach is None or start >= reach
            reach = end if reach is None else max(reach, end)
            want[k] = number
    df = spark.createDataFrame(rows, "k long, video string, start double, finish double")
    for parts in (1, 4, 23):
        got = {r.k: r.island for r in islands(df, "video", "start", "finish", "k", parts).collect()}
        assert got == {k: want.get(k) for k, *_ in rows}
    assert islands(df.limit(0), "video", "start", "finish", "k").collect() == []


@pytest.mark.parametrize("name", ["dense_id", "append_id", "greedy_prefix", "selection", "train_list"])
def test_no_window_over_all_rows(spark, sf_dir, name):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Window \[[^\]]*\], (?!\[_range)\[[^\]]*\]|Window.*windowspecdefinition\((?!_range)", text), text
