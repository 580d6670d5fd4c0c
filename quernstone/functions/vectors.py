"""Vector functions on array columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column, eps: float = 0.0) -> Column:
    """The vector over its length plus ``eps``."""
    length = norm(v) + eps
    return F.transform(v, lambda x: x.cast("double") / length)


def peak_normalize(v: Column, peak: float = 0.95, silent: float = 1e-5) -> Column:
    """Samples scaled to a peak; null if the peak is below ``silent``."""
    top = F.array_max(F.transform(v, lambda x: F.abs(x.cast("double"))))
    return F.when(top >= silent, F.transform(v, lambda x: x.cast("double") / top * peak))


def frames(v: Column, width: int = 2048, hop: int = 512) -> Column:
    """Sliding windows over samples; none if there are fewer than ``width``."""
    starts = F.when(F.size(v) >= width, F.sequence(F.lit(0), F.size(v) - width, F.lit(hop))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(v, i + 1, width))


def centroids(rows: DataFrame, group: str, vector: str, eps: float = 1e-9) -> DataFrame:
    """``group`` and ``centroid``: the mean of the group's vectors, brought to unit length.

    Components are averaged where they stand, with partial sums before the shuffle, so no group is gathered.
    """
    parts = rows.select(group, F.posexplode(vector).alias("pos", "x")).groupBy(group, "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    mean = F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda p: p["x"])
    return parts.groupBy(group).agg(mean.alias("centroid")).select(group, l2_normalize(F.col("centroid"), eps).alias("centroid"))
