"""Speaker profiles, and growing a cohort of speakers around the best one under a budget of hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.vectors import centroids, dot, norm
from quernstone.operators.ranks import BOUND, Percentiles, percentiles_by
from quernstone.operators.scans import places, running_before
from quernstone.sources.corpus import measured

#: Columns of a written selection.
SELECTION = ["audio_file", "speaker", "speaker_id", "video_id", "duration", "text", "text_tashkeel", "text_tashkeel_raw", "coverage", "squim_mos", "snr_db", "in_voice_core"]
#: Lower and upper bounds of the pitch report's buckets; what lies at or above the last bound is left out.
BUCKETS = [(0, 130), (130, 145), (145, 155), (155, 170), (170, 190), (190, 400)]


def speaker_f0(features: DataFrame, bound: int = BOUND) -> DataFrame:
    """``f0_speaker``, the median of a speaker's measured clips, and their number ``n_f0``."""
    found = percentiles_by(features, ["speaker"], {"q": Percentiles(F.col("f0_median"))}, {"n_f0": F.count(measured("f0_median"))}, bound)
    return found.select("speaker", F.get("q", F.lit(0)).alias("f0_speaker"), "n_f0")


def with_speaker_f0(rows: DataFrame, features: DataFrame) -> DataFrame:
    return rows.join(speaker_f0(features), "speaker", "left")


def f0_buckets(rows: DataFrame) -> DataFrame:
    """Speakers and hours, of all their rows, by pitch bucket; every bucket has a row."""
    per = rows.groupBy("speaker").agg(F.first("f0_speaker", ignorenulls=True).alias("f0"), (F.sum("duration") / 3600).alias("hours"))
    bucket = F.coalesce(*(F.when((F.col("f0") >= lo) & (F.col("f0") < hi), F.lit(lo)) for lo, hi in BUCKETS))
    found = per.select(bucket.alias("lo"), "hours").filter("lo is not null").groupBy("lo").agg(F.count("*").alias("speakers"), F.sum("hours").alias("hours"))
    bounds = F.array(*(F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for lo, hi in BUCKETS))
    every = rows.sparkSession.range(1).select(F.inline(bounds))
    return every.join(found, "lo", "left").select("lo", "hi", F.coalesce("speakers", F.lit(0)).alias("speakers"), F.coalesce("hours", F.lit(0.0)).alias("hours"))


def corpus_totals(rows: DataFrame) -> DataFrame:
    """Rows, hours, and distinct speakers and videos, nulls not counted."""
    return rows.agg(F.count("*").alias("n_rows"), (F.sum("duration") / 3600).alias("hours"), F.countDistinct("speaker").alias("speakers"), F.countDistinct("video_id").alias("videos"))


def speaker_profile(rows: DataFrame, bound: int = BOUND) -> DataFrame:
    """``hours``, median ``squim`` and ``snr``, and ``f0`` of each speaker's rows."""
    wanted = {"squim": Percentiles(F.col("squim_mos")), "snr": Percentiles(F.col("snr_db"))}
    found = percentiles_by(rows, ["speaker"], wanted, {"hours": F.sum("duration") / 3600, "f0": F.first("f0_speaker", ignorenulls=True)}, bound)
    return found.select("speaker", "hours", *(F.get(c, F.lit(0)).alias(c) for c in wanted), "f0")


def argmax_seed(profiles: DataFrame) -> DataFrame:
    """The one profile with the largest product of hours and quality; at ties the smallest speaker."""
    strength = F.col("hours") * F.coalesce("squim", F.lit(0.0))
    return profiles.withColumn("strength", strength).orderBy(F.desc_nulls_last("strength"), "speaker").limit(1).drop("strength")


def candidates(profiles: DataFrame, vectors: DataFrame, tolerance: float = 15.0) -> DataFrame:
    """Profiles whose pitch is near the seed's, with ``cos``, the cosine to the seed's centroid.

    ``vectors`` has ``speaker`` and ``ecapa``. The seed is a single row, so meeting it moves no other data.
    """
    both = profiles.join(centroids(vectors, "speaker", "ecapa"), "speaker")
    seed = argmax_seed(both).select(F.col("centroid").alias("seed_centroid"), F.col("f0").alias("seed_f0"), F.col("speaker").alias("seed"))
    met = both.join(F.broadcast(seed), F.abs(F.col("f0") - F.col("seed_f0")) <= tolerance)
    return met.withColumn("cos", dot(F.col("centroid"), F.col("seed_centroid"))).drop("centroid", "seed_centroid", "seed_f0")


def greedy_prefix(rows: DataFrame, budget: float = 25.0, order: tuple[Column, ...] | None = None, amount: str = "hours") -> DataFrame:
    """Rows in order (cosine falling, then speaker) until ``budget`` is reached; the row that reaches it is in.

    Amounts are summed by ranges of the order, and ranges beyond the budget are not looked into.
    """
    return running_before(rows, list(order or (F.desc("cos"), F.col("speaker"))), F.col(amount).cast("double"), "hours_before", below=budget)


def voice_core(rows: DataFrame, vectors: DataFrame, budget: float = 25.0, tolerance: float = 15.0) -> DataFrame:
    """The speakers of the core, with cosine, pitch and hours."""
    return greedy_prefix(candidates(speaker_profile(rows), vectors, tolerance), budget)


def with_core_flag(rows: DataFrame, core: DataFrame) -> DataFrame:
    """``in_voice_core``: whether the row's speaker is in the core."""
    members = core.select("speaker", F.lit(True).alias("_in")).distinct()
    return rows.join(members, "speaker", "left").withColumn("in_voice_core", F.coalesce("_in", F.lit(False))).drop("_in")


def dense_ids(rows: DataFrame, key: str = "speaker", name: str = "speaker_id") -> DataFrame:
    """Distinct keys with their places, from 0, in sorted order."""
    keys = rows.select(key).filter(F.col(key).isNotNull()).distinct()
    return places(keys, [F.col(key)], name).withColumn(name, F.col(name).cast("int"))


def append_ids(ids: DataFrame, more: DataFrame, key: str = "speaker", name: str = "speaker_id") -> DataFrame:
    """``ids``, and the keys of ``more`` that it lacks with the numbers after its last, in sorted order."""
    fresh = dense_ids(more.join(ids, key, "left_anti"), key, "_k")
    size = ids.agg(F.count("*").alias("_n"))
    return ids.select(key, name).unionByName(fresh.join(F.broadcast(size)).select(key, (F.col("_n") + F.col("_k")).cast("int").alias(name)))


def selection(rows: DataFrame, vectors: DataFrame, budget: float = 25.0, tolerance: float = 15.0, core: bool = True) -> DataFrame:
    """Rows that passed the filters, with ``speaker_id`` and ``in_voice_core``."""
    chosen = voice_core(rows, vectors, budget, tolerance) if core else rows.select("speaker").limit(0)
    return with_core_flag(rows, chosen).join(dense_ids(rows), "speaker")


def keep_selected(rows: DataFrame, chosen: DataFrame, key: str = "audio_file") -> DataFrame:
    """Rows whose key was selected, with the selection's speaker; blobs are read only after this join."""
    return rows.drop("speaker").join(chosen.select(key, "speaker"), key)


def video_f0(rows: DataFrame, group: str = "video_id", floor: float = 155.0, bound: int = BOUND) -> DataFrame:
    """Count, quartiles and pitch band of each video's measured clips."""
    wanted = {"q": Percentiles(F.col("f0_median"), (0.25, 0.5, 0.75))}
    quartiles = percentiles_by(rows, [group], wanted, {"n": F.count(measured("f0_median"))}, bound).filter("n > 0")
    return quartiles.select(group, "n", F.col("q")[1].alias("median_f0"), F.col("q")[0].alias("p25"), F.col("q")[2].alias("p75"), F.when(F.col("q")[1] < floor, "low").otherwise("high").alias("band"))


def f0_spread(videos: DataFrame) -> DataFrame:
    """Videos in either band, and the range of their medians."""
    return videos.agg(F.count("*").alias("videos"), F.count_if(F.col("band") == "low").alias("low"), F.count_if(F.col("band") == "high").alias("high"), F.min("median_f0").alias("min_f0"), F.max("median_f0").alias("max_f0"))


def lower_median(rows: DataFrame, group: str, value: str, bound: int = BOUND) -> DataFrame:
    """The lower middle value of each group's measured rows."""
    found = percentiles_by(rows, [group], {"q": Percentiles(F.col(value), discrete=True)}, bound=bound)
    return found.select(group, F.get("q", F.lit(0)).alias("lower_median"))


def row_norm_ratio(rows: DataFrame, key: str, vector: str, floor: float = 0.5, bound: int = BOUND) -> DataFrame:
    """Each vector's norm over the lower median norm, and whether it is above ``floor``."""
    sized = rows.select(key, norm(F.col(vector)).alias("norm"))
    middle = percentiles_by(sized, [], {"q": Percentiles(F.col("norm"), discrete=True)}, bound=bound).select(F.get("q", F.lit(0)).alias("median_norm"))
    return sized.join(F.broadcast(middle)).select(key, "norm", (F.col("norm") / F.col("median_norm")).alias("ratio"), (F.col("norm") / F.col("median_norm") > floor).alias("trained"))
