"""Verdicts: what measurements say, as an ordered choice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bands above 8 kHz whose peak over mean tells tonal drift.
TONAL = ["pkmean_8_9k", "pkmean_9_10k", "pkmean_10_11k", "pkmean_11_12k"]


def mean_metrics(rows: DataFrame, names: list[str]) -> DataFrame:
    """One row: each metric's mean over files that have one."""
    return rows.agg(*(F.avg(n).alias(n) for n in names))


def against_reference(run: DataFrame, reference: DataFrame) -> DataFrame:
    """``metric``, ``value`` and ``ref`` of two tables of ``metric`` and ``value``; without reference, NaN."""
    return run.join(reference.withColumnRenamed("value", "ref"), "metric", "left").withColumn("ref", F.coalesce("ref", F.lit(float("nan"))))


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, (F.coalesce(c, F.lit(False)) for c in conditions), F.lit(False))


def band_verdict(prefix: str = "ref_") -> Column:
    """ZEROED, TONAL, HISSING or STRUCTURED, from a run's metrics and, prefixed, the reference's."""
    ref = lambda n: F.col(f"{prefix}{n}")
    zeroed = (F.col("dead_frac") > 0.5) | (F.col("high_low_db") < -45)
    tonal = _any([(ref(n) != 0) & ~F.isnan(ref(n)) & (F.col(n) > F.greatest(3 * ref(n), F.lit(6.0))) for n in TONAL])
    hissing = (F.col("flatness") > 0.6) & (F.col("high_low_db") > F.coalesce(ref("high_low_db"), F.lit(-99.0)) + 6)
    return F.when(zeroed, "ZEROED").when(tonal, "TONAL").when(hissing, "HISSING").otherwise("STRUCTURED")


def bandwidth_verdict(prefix: str = "ref_") -> Column:
    """BUZZ, DEAD or OK, from a run's band metrics and, prefixed, the reference's."""
    ref = lambda n, default: F.coalesce(F.col(f"{prefix}{n}"), F.lit(default))
    worst = F.greatest(*(F.coalesce(F.col(n) / F.greatest(ref(n, 1e-9), F.lit(1e-9)), F.lit(0.0)) for n in ("pkmean_8_10k", "pkmean_10_12k")))
    gain = F.coalesce("db_8_10k", F.lit(-99.0)) - ref("db_8_10k", -99.0)
    return F.when(worst > 2.0, "BUZZ").when(gain < -20, "DEAD").otherwise("OK")


def f0_verdict() -> Column:
    """MULTI, SUSPICIOUS or SINGLE, from the columns of ``cohort.f0_spread``."""
    return F.when((F.col("low") > 0) & (F.col("high") > 0), "MULTI").when(F.col("max_f0") - F.col("min_f0") > 50, "SUSPICIOUS").otherwise("SINGLE")


def preflight(checks: DataFrame) -> DataFrame:
    """``passed`` if every row's ``ok`` is true; true without rows."""
    return checks.agg(F.coalesce(F.bool_and(F.coalesce("ok", F.lit(False))), F.lit(True)).alias("passed"))
