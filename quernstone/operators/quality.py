"""Row filters that take a missing measurement for no objection, and what each filter costs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """Thresholds of the row filter."""

    min_dur: float = 1.5
    max_dur: float = 12.0
    min_snr: float = 20.0
    min_squim: float = 4.2
    max_music: float = 0.05
    max_cer: float = 0.10
    min_coverage: float = 0.75


def tolerant(column: str, good: Column) -> Column:
    """Whether a measurement is missing (null or NaN) or good."""
    c = F.col(column)
    return c.isNull() | F.isnan(c) | good


def checks(a: Limits = Limits()) -> dict[str, Column]:
    """The named predicates, each true or false for any row; a missing duration fails."""
    return {
        "duration": F.coalesce(F.col("duration").between(a.min_dur, a.max_dur), F.lit(False)),
        "snr_db": tolerant("snr_db", F.col("snr_db") >= a.min_snr),
        "squim_mos": tolerant("squim_mos", F.col("squim_mos") >= a.min_squim),
        "music_score": tolerant("music_score", F.col("music_score") <= a.max_music),
        "cer": tolerant("cer_yt_vs_cohere", F.col("cer_yt_vs_cohere") <= a.max_cer),
        "coverage": tolerant("coverage", F.col("coverage") >= a.min_coverage),
        "boundary": ~F.col("boundary_clipped").eqNullSafe(True),
    }


def passes(a: Limits = Limits()) -> Column:
    """All checks at once."""
    out = F.lit(True)
    for c in checks(a).values():
        out &= c
    return out


def row_quality(rows: DataFrame, a: Limits = Limits()) -> DataFrame:
    return rows.filter(passes(a))


def retention_report(rows: DataFrame, a: Limits = Limits()) -> DataFrame:
    """``check``, ``hours`` and ``share`` of rows that pass each check alone, and all of them, in one pass."""
    named = checks(a) | {"all": passes(a)}
    sums = [x for k, c in named.items() for x in ((F.sum(F.when(c, F.col("duration"))) / 3600).alias(f"h_{k}"), F.avg(c.cast("double")).alias(f"s_{k}"))]
    one = rows.agg(*sums)
    lines = F.array(*(F.struct(F.lit(k).alias("check"), F.coalesce(f"h_{k}", F.lit(0.0)).alias("hours"), F.col(f"s_{k}").alias("share")) for k in named))
    return one.select(F.inline(lines))


def pitch_gate(rows: DataFrame, floor: float = 165.0) -> DataFrame:
    """Rows whose speaker's pitch is measured and at least ``floor``."""
    return rows.filter(~F.isnan("f0_speaker") & (F.col("f0_speaker") >= floor))


def within_budget(tokens: str, budget: int = 510, frame: int = 2) -> Column:
    """Whether a text's tokens and the ``frame`` ones around them fit a model's input."""
    return F.coalesce(F.col(tokens) + frame <= budget, F.lit(False))


def has_text(column: str) -> Column:
    return F.coalesce(F.col(column) != "", F.lit(False))


def filled(rows: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with empty texts for null ones."""
    return rows.withColumns({c: F.coalesce(c, F.lit("")) for c in columns})


def audible(samples: str = "samples", peak: float = 1e-5) -> Column:
    """Whether the samples' peak reaches ``peak``."""
    return F.coalesce(F.array_max(F.transform(samples, lambda x: F.abs(x))) >= peak, F.lit(False))


def voiced_median(frames: str, low: float = 65.0, high: float = 350.0, least: int = 10) -> Column:
    """The lower median of the pitch frames strictly between two bounds; null if there are fewer than ``least``."""
    kept = F.array_sort(F.filter(frames, lambda x: (x > low) & (x < high)))
    return F.when(F.size(kept) >= least, F.get(kept, F.floor((F.size(kept) - 1) / 2).cast("int")))
