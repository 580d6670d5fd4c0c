"""Word and character error rates of hypotheses against references."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.distance import text_distances
from quernstone.functions.text import QAF, tokens, wer_norm


def scored(pairs: DataFrame, ref: str = "ref", hyp: str = "hyp", spread: int | None = None) -> DataFrame:
    """Each pair with its edits and sizes in words and characters (code points) of normalised text.

    Without a hypothesis a pair isn't scored; it is left out, as is one without a reference. Distances are
    unit-cost. Scoring costs much time for few bytes, so the pairs are dealt to ``spread`` tasks
    (``spark.sql.shuffle.partitions``, if it isn't given) before it, wherever they come from.
    """
    spread = spread or int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pairs.filter(F.col(hyp).isNotNull() & F.col(ref).isNotNull()).withColumns({"ref_norm": wer_norm(F.col(ref)), "hyp_norm": wer_norm(F.col(hyp))})
    rows = rows.repartition(spread).withColumn("_edits", text_distances(F.col("ref_norm"), F.col("hyp_norm")))
    out = {"word_edits": F.col("_edits.words"), "words": F.size(tokens(F.col("ref_norm"))).cast("long"), "chars": F.char_length("ref_norm").cast("long"), "char_edits": F.col("_edits.chars")}
    return rows.withColumns(out).withColumn("wer", rate(F.col("word_edits"), F.col("words"))).drop("_edits")


def rate(edits: Column, total: Column) -> Column:
    """Edits over a total of at least one."""
    return edits / F.greatest(total, F.lit(1))


def micro(edits: str, total: str, when: Column | None = None) -> Column:
    """Summed edits over summed sizes, over rows where ``when`` holds; 0 without rows."""
    e, n = (F.col(c) if when is None else F.when(when, F.col(c)) for c in (edits, total))
    return rate(F.coalesce(F.sum(e), F.lit(0)), F.coalesce(F.sum(n), F.lit(0)))


def error_rates(rows: DataFrame, *by: str) -> DataFrame:
    """Word and character error rates, and the word error rate of references without qaf, of scored rows."""
    return rows.groupBy(*by).agg(F.count("*").alias("pairs"), micro("word_edits", "words").alias("wer"), micro("char_edits", "chars").alias("cer"), micro("word_edits", "words", ~F.col("ref_norm").contains(QAF)).alias("wer_no_q"))


def by_category(rows: DataFrame, category: str = "category") -> DataFrame:
    """Word error rate and words of each category, worst first; no rows unless there are two categories or more."""
    found = rows.groupBy(category).agg(micro("word_edits", "words").alias("wer"), F.sum("words").alias("words"))
    several = found.agg((F.count("*") > 1).alias("_several"))
    return found.join(F.broadcast(several)).filter("_several").drop("_several").orderBy(F.desc("wer"), category)


def wer_gate(rows: DataFrame, threshold: float | None = None) -> DataFrame:
    """The overall rate, the threshold (0.35, or what ``WER_ABORT`` says) and whether it is exceeded."""
    limit = float(os.environ.get("WER_ABORT", 0.35)) if threshold is None else threshold
    found = rows.agg(micro("word_edits", "words").alias("wer")).withColumn("threshold", F.lit(limit))
    return found.withColumn("abort", F.col("wer") > F.col("threshold"))


def synthesis_report(rows: DataFrame, seconds: str = "seconds", duration: str = "dur") -> DataFrame:
    """Pieces, the median time taken for a second of sound, and the longest piece."""
    factor = F.col(seconds) / F.greatest(F.col(duration), F.lit(1e-6))
    return rows.agg(F.count("*").alias("pieces"), F.median(factor).alias("median_rtf"), F.max(duration).alias("longest"))
