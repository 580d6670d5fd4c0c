"""Running sums and places over all rows in two levels, so that no task sees more than a range of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.checkpoints import cut_lineage


def running_before(rows: DataFrame, order: list[Column], amount: Column | None = None, name: str = "before", parts: int | None = None, below: float | None = None) -> DataFrame:
    """``rows`` with ``name``: the sum of ``amount`` over all rows that come before in ``order``, 0 for the first.

    Without ``amount`` rows are counted, which gives places from 0. The rows are dealt to ``parts`` ranges of the
    order (``spark.sql.shuffle.partitions``, if it isn't given) and checkpointed; each range is summed, the sums,
    one a range, are added up on the driver, and then each range is summed from its start. ``below`` keeps the
    rows whose sum is below it, and ranges that start beyond it are not looked into (amounts mustn't be negative).

    The order must be total but for rows that are equal in all that matters: rows of one order key are in one
    range. Null amounts count nothing. No rows give no rows. A column that is called ``name`` is replaced.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = rows.drop(name)
    part, size = "_range", "_amount"
    dealt = given.withColumn(size, F.lit(1) if amount is None else F.coalesce(amount, F.lit(0)))
    dealt = cut_lineage(dealt.repartitionByRange(parts, *order).withColumn(part, F.spark_partition_id()))
    sums = sorted((r[part], r["s"]) for r in dealt.groupBy(part).agg(F.sum(size).alias("s")).collect())
    zero = 0 if amount is None else 0.0
    starts, total = [], zero
    for k, s in sums:
        if below is None or total < below:
            starts.append((k, total))
        total += s
    kind = "long" if amount is None else "double"
    known = rows.sparkSession.createDataFrame(starts, f"{part} int, _start {kind}")
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    found = dealt.join(F.broadcast(known), part)
    found = found.withColumn(name, F.col("_start") + F.coalesce(F.sum(size).over(inside), F.lit(zero)))
    found = found if below is None else found.filter(F.col(name) < below)
    return found.select(*given.columns, name)


def places(rows: DataFrame, order: list[Column], name: str = "place", parts: int | None = None) -> DataFrame:
    """``rows`` with ``name``, each row's place in ``order`` from 0."""
    return running_before(rows, order, None, name, parts)


def islands(rows: DataFrame, key: str, start: str, end: str, order: str, parts: int | None = None, name: str = "island") -> DataFrame:
    """``rows`` with ``name``, the number from 0 of each key's island: intervals that overlap, directly or over others.

    Two intervals overlap if one begins before the other ends; intervals that only touch don't. They are dealt to
    ranges of key and start, swept in each range, and what the ranges before have reached is carried over their
    borders, so a key may have any number of intervals; no task sees more than a range. Intervals without a start or
    an end, or that end before they begin, belong to no island (null) and join none; null keys are a key like any
    other. Intervals that begin and end alike are told apart by ``order``, which must be unique in a key.
    """
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part, reach, fresh = "_range", "_reach", "_fresh"
    given = rows.drop(name)
    sound = F.coalesce(F.col(start) <= F.col(end), F.lit(False))
    dealt = cut_lineage(given.filter(sound).repartitionByRange(parts, key, start, end, order).withColumn(part, F.spark_partition_id()))

    def carried(frame: DataFrame, total: Column, over) -> DataFrame:
        """``frame`` with ``_before``: ``over`` (a maximum or sum) of the totals of the key's ranges before."""
        of = frame.groupBy(F.col(key).alias("_key"), F.col(part).alias("_part")).agg(total.alias("_total"))
        before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        of = of.withColumn("_before", over("_total").over(before)).drop("_total")
        return frame.join(of, F.col(key).eqNullSafe(F.col("_key")) & (F.col(part) == F.col("_part")), "left").drop("_key", "_part")

    inside = Window.partitionBy(key, part).orderBy(start, end, order)
    swept = carried(dealt, F.max(end), F.max)
    reached = F.greatest(F.col("_before"), F.max(end).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    swept = cut_lineage(swept.withColumn(reach, reached).withColumn(fresh, F.coalesce(F.col(start) >= F.col(reach), F.lit(True)).cast("long")).drop("_before", reach))
    counted = carried(swept, F.sum(fresh), F.sum)
    number = F.coalesce("_before", F.lit(0)) + F.sum(fresh).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - 1
    found = counted.withColumn(name, number).select(*given.columns, name)
    return found.unionByName(given.filter(~sound).withColumn(name, F.lit(None).cast("long")))
