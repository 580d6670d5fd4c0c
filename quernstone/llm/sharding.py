"""Reproducible shuffle into shards by a Feistel permutation of global row numbers (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernstone.llm.common import cut_lineage

ROUNDS = 6
#: Odd multipliers of the round function (the 64-bit finaliser of SplitMix).
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class Feistel:
    """A permutation of 0 .. n - 1, chosen by ``seed``; both directions are computed from the number alone.

    A balanced network permutes the numbers of 2k bits, k the least with 4 ** k >= n; numbers beyond n - 1 are
    permuted again until they fall below n (cycle walking), fewer than four times on average.
    """

    def __init__(self, n: int, seed: int = 0):
        self.n = n
        self.half = max(1, -(-max(1, n - 1).bit_length() // 2))
        self.keys = [int(x) for x in np.random.default_rng(seed).integers(0, 1 << 63, ROUNDS)]

    def _round(self, x: np.ndarray, key: int) -> np.ndarray:
        x = (x + np.uint64(key)) * np.uint64(MIX[0])
        x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
        return (x ^ (x >> np.uint64(31))) & np.uint64((1 << self.half) - 1)

    def _once(self, x: np.ndarray, keys: list[int]) -> np.ndarray:
        k = np.uint64(self.half)
        left, right = x >> k, x & np.uint64((1 << self.half) - 1)
        for key in keys:
            left, right = right, left ^ self._round(right, key)
        return (right << k) | left  # halves swapped, so that reversed keys undo it

    def _walk(self, x: np.ndarray, keys: list[int]) -> np.ndarray:
        x = self._once(np.asarray(x, np.uint64), keys)
        while (out := x >= self.n).any():
            x[out] = self._once(x[out], keys)
        return x.astype(np.int64)

    def forward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.keys)

    def backward(self, x: np.ndarray) -> np.ndarray:
        return self._walk(x, self.keys[::-1])


def locate(row_number: int, n: int, n_shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of a global row number, without any table."""
    p = int(Feistel(n, seed).forward(np.array([row_number]))[0])
    return p % n_shards, p // n_shards


def row_at(shard: int, slot: int, n: int, n_shards: int, seed: int = 0) -> int:
    """The global row number that lies at a shard's slot."""
    return int(Feistel(n, seed).backward(np.array([slot * n_shards + shard]))[0])


def numbered(rows: DataFrame, per_bucket: int = 1 << 17, chunk: int = 1 << 16) -> DataFrame:
    """``rows`` with ``row_number``: 0 to the number of rows less one, each once, from the rows' content alone.

    Equal rows are counted first, so copies cost one row each way; they get neighbouring numbers. Distinct rows
    are dealt to buckets by hash, numbered in a bucket by their columns' order, and each bucket starts where the
    buckets before end. Only the buckets' sizes meet in one place, one row for ``per_bucket`` rows. Columns must
    be of types that Spark can group and sort by.
    """
    given = rows.select(F.struct("*").alias("row"))  # one column, so that no name can clash
    counted = cut_lineage(given.groupBy("row").agg(F.count("*").alias("copies")))
    n_buckets = max(1, -(-counted.count() // per_bucket)) * 8
    dealt = counted.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(n_buckets)).cast("int"))
    sizes = dealt.groupBy("bucket").agg(F.sum("copies").alias("size"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("bucket").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.withColumn("first", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(starts, "bucket")
    parts = first.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {chunk}"))))
    end = F.least(F.col("copies"), (F.col("part") + 1) * chunk) - 1
    spread = parts.withColumn("copy", F.explode(F.sequence(F.col("part") * chunk, end)))
    return spread.select("row.*", (F.col("start") + F.col("first") + F.col("copy")).alias("row_number"))


def feistel_shards(rows: DataFrame, n_shards: int = 8, seed: int = 0) -> DataFrame:
    """``rows`` with ``row_number``, ``shard`` and ``slot``.

    A Feistel permutation sends the row number to a place p: shard p mod ``n_shards``, slot p div ``n_shards``.
    So shards differ by one row at most, slots have no gap, and ``locate`` and ``row_at`` compute either way.
    Equal tables give equal results whatever their files and order. Null values are values like any other; equal
    rows lie in different places, interchangeably. Of an empty table nothing is returned. Columns that are called
    ``row_number``, ``shard`` or ``slot`` are replaced.
    """
    given = cut_lineage(numbered(rows.drop("row_number", "shard", "slot")))
    n = given.count()

    @F.pandas_udf("long")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        permutation = Feistel(n, seed)
        for x in batches:
            yield pd.Series(permutation.forward(x.to_numpy()))

    put = given.select(F.struct("*").alias("row"), place("row_number").alias("place"))
    return put.select("row.*", F.pmod("place", F.lit(n_shards)).cast("int").alias("shard"), F.expr(f"place div {n_shards}").alias("slot"))
