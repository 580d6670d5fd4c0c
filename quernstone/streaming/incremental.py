"""Incremental curation over shards as they arrive: the row filter, caps by key and running profiles.

State is a table below a folder that all machines see: one version a batch, written whole under the batch's number
and then read by the next one. A batch that is repeated after a failure starts from the version before it again, so
it counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quernstone.operators.pools import cap_per_key
from quernstone.operators.quality import Limits, row_quality
from quernstone.sources.corpus import MANIFEST, measured


def filter_new_shards(spark: SparkSession, source: str, target: str, state: str, limits: Limits = Limits(), schema: str = MANIFEST) -> StreamingQuery:
    """Appends the rows of shards that ``state`` hasn't seen and that pass the filter to ``target``, then ends.

    Each shard is read once, also over restarts; the filter needs no state of its own.
    """
    rows = spark.readStream.schema(schema).parquet(source)
    kept = row_quality(rows, limits).writeStream.format("parquet").outputMode("append")
    return kept.option("checkpointLocation", state).trigger(availableNow=True).start(target)


def _versions(spark: SparkSession, table: str) -> dict[int, object]:
    """The paths of the table's whole versions by number, and the file system's."""
    root = spark._jvm.org.apache.hadoop.fs.Path(table)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return {}
    there = (s.getPath() for s in files.listStatus(root))
    whole = (p for p in there if p.getName().startswith("v") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))
    return {int(p.getName()[1:]): p for p in whole}


def current(spark: SparkSession, table: str) -> DataFrame | None:
    """The last whole version of a table of state; None before the first batch."""
    versions = _versions(spark, table)
    return spark.read.parquet(versions[max(versions)].toString()) if versions else None


def _advance(spark: SparkSession, table: str, batch: int, merged: Callable[[DataFrame | None], DataFrame], kept: int = 2) -> None:
    """Writes the version of ``batch``, merged of the last one before it, and removes all but the last ``kept``."""
    versions = {k: p for k, p in _versions(spark, table).items() if k < batch}
    before = spark.read.parquet(versions[max(versions)].toString()) if versions else None
    merged(before).write.mode("overwrite").parquet(f"{table}/v{batch:012d}")
    for k in sorted(versions)[: -kept or None]:
        versions[k].getFileSystem(spark._jsc.hadoopConfiguration()).delete(versions[k], True)


def _over_new_shards(spark: SparkSession, source: str, table: str, state: str, schema: str, merged: Callable[[DataFrame | None, DataFrame], DataFrame], files: int | None) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    rows = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(source)

    def step(batch: DataFrame, number: int) -> None:
        _advance(batch.sparkSession, table, number, lambda before: merged(before, batch))

    return rows.writeStream.foreachBatch(step).option("checkpointLocation", state).trigger(availableNow=True).start()


def cap_new_shards(spark: SparkSession, source: str, table: str, state: str, key: str = "speaker", order: str = "audio_file", cap: int = 40, valid: Column | None = None, schema: str = MANIFEST, files: int | None = None) -> StreamingQuery:
    """Keeps in ``table`` the first ``cap`` valid rows of each key over all shards so far, in the order of a column.

    Each batch (of ``files`` shards at most) meets the rows that are kept, ``cap`` a key at most, so a shard that
    comes late takes the places that are its rows' and the result is that of one pass over all shards, in whatever
    order and batches they arrive and however often the stream is stopped. ``current`` reads it. ``order`` must tell
    a key's rows apart. Null keys are a key like any other; an empty shard changes nothing.
    """

    def merged(before: DataFrame | None, batch: DataFrame) -> DataFrame:
        fresh = cap_per_key(batch, key, order, cap, valid)
        return fresh if before is None else cap_per_key(before.unionByName(fresh), key, order, cap)

    return _over_new_shards(spark, source, table, state, schema, merged, files)


#: Measures whose medians a profile has.
MEASURES = ("squim_mos", "snr_db")


def partial_profiles(rows: DataFrame) -> DataFrame:
    """Mergeable counts of clips: ``speaker``, ``video_id``, ``measure``, ``value``, ``n`` and ``seconds``.

    A row without a measure counts the clips of a speaker and video and sums their seconds; one with a measure
    counts how many of the speaker's clips have a value.
    """
    sums = rows.groupBy("speaker", "video_id").agg(F.count("*").alias("n"), F.sum("duration").alias("seconds"))
    sums = sums.select("speaker", "video_id", F.lit(None).cast("string").alias("measure"), F.lit(None).cast("double").alias("value"), "n", "seconds")
    values = rows.select("speaker", F.inline(F.array(*(F.struct(F.lit(m).alias("measure"), measured(F.col(m).cast("double")).alias("value")) for m in MEASURES)))).filter("value is not null")
    counts = values.groupBy("speaker", "measure", "value").agg(F.count("*").alias("n"))
    return sums.unionByName(counts.select("speaker", F.lit(None).cast("string").alias("video_id"), "measure", "value", "n", F.lit(None).cast("double").alias("seconds")))


def merged_profiles(a: DataFrame, b: DataFrame) -> DataFrame:
    """The partial counts of two sets of clips that have no clip in common."""
    both = a.unionByName(b).groupBy("speaker", "video_id", "measure", "value")
    return both.agg(F.sum("n").alias("n"), F.sum("seconds").alias("seconds")).select("speaker", "video_id", "measure", "value", "n", "seconds")


def profile_new_shards(spark: SparkSession, source: str, table: str, state: str, schema: str = MANIFEST, files: int | None = None) -> StreamingQuery:
    """Keeps in ``table`` the partial counts of all shards so far; a new shard is read once and merged into them."""
    merged = lambda before, batch: partial_profiles(batch) if before is None else merged_profiles(before, partial_profiles(batch))
    return _over_new_shards(spark, source, table, state, schema, merged, files)


def totals_of(counts: DataFrame) -> DataFrame:
    """``cohort.corpus_totals`` of the clips that partial counts are of."""
    sums = counts.filter("measure is null")
    return sums.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), (F.sum("seconds") / 3600).alias("hours"), F.countDistinct("speaker").alias("speakers"), F.countDistinct("video_id").alias("videos"))


def profiles_of(counts: DataFrame) -> DataFrame:
    """``speaker``, ``hours``, and the medians ``squim`` and ``snr``, exact, of the clips that partial counts are of."""
    median = lambda m: F.percentile(F.when(F.col("measure") == m, F.col("value")), 0.5, F.when(F.col("measure") == m, F.col("n")).otherwise(1))
    return counts.groupBy("speaker").agg((F.sum(F.when(F.col("measure").isNull(), F.col("seconds"))) / 3600).alias("hours"), median("squim_mos").alias("squim"), median("snr_db").alias("snr"))
