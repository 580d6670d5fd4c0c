"""Percentiles of large groups, against those of Spark over whole groups."""

import math

import pytest
from pyspark.sql import functions as F

from quernstone.operators import cohort, ranks
from quernstone.operators.ranks import Percentiles, percentiles_by


def both_ways(rows, keys, p, bound):
    got = percentiles_by(rows, keys, {"q": p}, {"n": F.count("*")}, bound).collect()
    want = percentiles_by(rows, keys, {"q": p}, {"n": F.count("*")}).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    return got


@pytest.mark.parametrize("value", ["rand(3)", "floor(rand(4) * 3)", "if(rand(5) < 0.5, 1, if(rand(6) < 0.97, 2, 1 + rand(7)))", "exp(700 * (rand(8) - 0.5))", "if(id % 3 = 0, null, if(id % 7 = 0, double('nan'), -rand(9)))", "0"])
def test_equal_to_whole_groups(spark, value):
    rows = spark.range(6000).selectExpr("if(id % 2 = 0, 'hot', if(id % 3 = 0, null, concat('g', id % 50))) as g", f"double({value}) as x")
    for p in (Percentiles(F.col("x"), (0.0, 0.25, 0.5, 0.75, 1.0)), Percentiles(F.col("x"), (0.1, 0.5, 1.0), discrete=True)):
        both_ways(rows, ["g"], p, 40)
        both_ways(rows, [], p, 40)


def test_no_task_holds_a_hot_group(spark):
    """A million distinct values of one speaker: ranges narrow down to the bound, and few rows are shuffled."""
    rows = spark.range(1_000_000).selectExpr("if(id < 999000, 'hot', concat('s', id % 9)) as speaker", "(id * 7919 % 1000003) / 7.0D as f0_median")
    bound = 2000
    hot = rows.filter("speaker = 'hot'").selectExpr("speaker", "f0_median as v")
    state = spark.createDataFrame([("hot", 0, 499_499, -1.0, 1e9, 0, 999_000)], "_speaker string, j int, rank long, lo double, hi double, below long, inside long")
    narrow = ranks._narrowed(hot, state, ["speaker"], bound).first()
    inside = hot.filter((F.col("v") >= narrow.lo) & (F.col("v") <= narrow.hi)).count()
    assert inside == narrow.inside <= bound and narrow.below <= 499_499 < narrow.below + inside
    assert hot.filter(F.col("v") < narrow.lo).count() == narrow.below
    got = {r.speaker: r for r in cohort.speaker_f0(rows, bound).collect()}
    values = sorted((i * 7919 % 1000003) / 7.0 for i in range(999_000))
    assert got["hot"].f0_speaker == (values[499_499] + values[499_500]) / 2 and got["hot"].n_f0 == 999_000 and len(got) == 10


def test_cohort_with_hot_speakers(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 > 0, 'a', concat('b', id % 20)) as speaker", "concat('v', id % 2) as video_id", "if(id % 10 = 0, double('nan'), id * 31 % 997 / 3.0D) as f0_median", "id / 100.0D as duration", "id % 50 / 7.0D as squim_mos", "double(null) as snr_db", "150.0D as f0_speaker")
    for f in (cohort.speaker_profile, cohort.speaker_f0, cohort.video_f0, lambda r, **k: cohort.lower_median(r, "speaker", "f0_median", **k)):
        got, want = (sorted(map(tuple, f(rows, **how).collect()), key=repr) for how in ({"bound": 100}, {}))
        assert len(got) == len(want) and all(a == b or (isinstance(a, float) and math.isclose(a, b, rel_tol=1e-12)) for x, y in zip(got, want) for a, b in zip(x, y))


def test_odd_groups(spark):
    empty = spark.createDataFrame([], "g string, x double")
    assert percentiles_by(empty, ["g"], {"q": Percentiles(F.col("x"))}).collect() == []
    assert [r.q for r in percentiles_by(empty, [], {"q": Percentiles(F.col("x"), discrete=True)}).collect()] == [None]
    rows = spark.createDataFrame([("a", None)] * 9 + [("b", 1.0)] * 9, "g string, x double")
    assert {r.g: r.q for r in percentiles_by(rows, ["g"], {"q": Percentiles(F.col("x"))}, bound=3).collect()} == {"a": None, "b": [1.0]}
