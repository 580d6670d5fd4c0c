"""Caps per key, reproducible samples, ordered de-duplication, and set operations by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hexadecimal digits of a digest by which rows are counted.
DIGITS = 4


def cap_per_key(rows: DataFrame, key: str, order: str, cap: int = 40, valid: Column | None = None) -> DataFrame:
    """The first ``cap`` valid rows of each key in the order of a column.

    Spark keeps ``cap`` rows of a key before it shuffles, so a hot key costs no more than ``cap`` rows a task.
    """
    rows = rows if valid is None else rows.filter(valid)
    place = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return rows.withColumn("_place", place).filter(F.col("_place") <= cap).drop("_place")


def shuffled(key: str) -> list[Column]:
    """A reproducible random order: by the digest of a key, then the key."""
    return [F.md5(F.col(key).cast("string")), F.col(key)]


def sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows, the first in ``shuffled`` order; the same whatever the files and their order.

    First the rows are counted by the first digits of their digests, so that only those are sorted that can be among
    the first: some ``n`` in all, and not ``n`` of each task. Null keys come before all others.
    """
    head = F.coalesce(F.substring(shuffled(key)[0], 1, DIGITS), F.lit(""))
    total, last = 0, None
    for r in rows.groupBy(head.alias("head")).agg(F.count("*").alias("n")).orderBy("head").toLocalIterator():
        total, last = total + r["n"], r["head"]
        if total >= n:
            break
    possible = rows if last is None else rows.filter(head <= last)
    return possible.orderBy(*shuffled(key)).limit(n)


def rejected(rows: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among the selected; a null key is never selected."""
    return rows.join(selected.select(key).distinct(), key, "left_anti")


def first_of_each(rows: DataFrame, value: str, order: list[Column]) -> DataFrame:
    """Of rows with equal values, the first in order."""
    place = F.row_number().over(Window.partitionBy(value).orderBy(*order))
    return rows.withColumn("_place", place).filter("_place = 1").drop("_place")


def held_out_pool(rows: DataFrame, key: str, text: str, least: int = 50, most: int = 20_000) -> DataFrame:
    """``key`` and ``text`` of at most ``most`` distinct texts of ``least`` characters or more.

    They come from a sample of twice as many rows, in its order, with the first row of a text.
    """
    drawn = sample(rows, key, 2 * most).filter(F.length(text) >= least)
    return first_of_each(drawn, text, shuffled(key)).orderBy(*shuffled(key)).limit(most).select(key, text)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows; columns that a frame lacks are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, frames).distinct()


def distinct_sorted(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).distinct().orderBy(column)
