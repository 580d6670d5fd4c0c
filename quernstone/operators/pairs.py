"""Similarity of vectors within and across groups, and between groups' centroids."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.checkpoints import cut_lineage
from quernstone.functions.vectors import centroids, dot, l2_normalize

#: Decimals to which cosines are counted, so that their number is bounded however many pairs there are.
DECIMALS = 6
#: The units of a cosine of 1, and one for rounding; the rows of a tile; the components of a block.
EDGE, TILE, BLOCK = 10**DECIMALS + 1, 2048, 1 << 21


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """The vectors of a column, which must be equally long, as rows."""
    return np.concatenate([part.flatten().to_numpy() for part in vectors.chunks]).reshape(len(vectors), -1)


def _slices(groups: pa.ChunkedArray) -> dict[str, slice]:
    """Where the rows of each group are among sorted ones; null is no group."""
    found: dict[str, list[int]] = {}
    for k, g in enumerate(groups.to_pylist()):
        if g is not None:
            found.setdefault(g, [k, k])[1] = k + 1
    return {g: slice(*ends) for g, ends in found.items()}


class _Tally:
    """Counts cosines, given in units: those from -1 to 1 in an array."""

    def __init__(self):
        self.held, self.size, self.counts, self.others = [], 0, np.zeros(2 * EDGE + 1, np.int64), Counter()

    def add(self, units: np.ndarray) -> None:
        self.held.append(units.ravel())
        self.size += units.size
        if self.size >= TILE * TILE:
            self.count()

    def count(self) -> None:
        for units in [np.concatenate(self.held)] if self.held else []:
            if len(units) and (units.min() < -EDGE or units.max() > EDGE):
                out = (units < -EDGE) | (units > EDGE)
                self.others.update(units[out].tolist())
                units = units[~out]
            self.counts += np.bincount(units + EDGE, minlength=len(self.counts))
        self.held, self.size = [], 0


def cosine_counts(rows: DataFrame, key: str, group: str, vector: str, block: int | None = None) -> DataFrame:
    """``scope`` (``within`` or ``across`` groups), ``cos`` and ``n``: how many ordered pairs have that cosine.

    Rows are dealt to blocks of some ``block``; without it to as few as keep all cores busy, of 16 MB at most. Each
    pair of blocks is multiplied once, in one task and tile by tile, and the task counts the rounded cosines in arrays,
    so no pair leaves it. Its memory is bounded; the time is that of all pairs. Rows must differ in ``key``; a row
    isn't paired with itself. Null groups are like no other.
    """
    unit = rows.select(F.col(key).cast("string").alias("key"), F.col(group).cast("string").alias("grp"), l2_normalize(F.col(vector)).alias("v")).filter("key is not null and v is not null")
    total, width = unit.agg(F.count("*"), F.max(F.size("v"))).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    least, most = -(-total // max(1, BLOCK // max(1, width or 1))), -(-total // TILE)
    n = max(1, -(-total // block) if block else max(least, min(most, math.isqrt(8 * cores))))
    dealt = unit.withColumn("home", F.pmod(F.xxhash64("key"), F.lit(n)).cast("int"))
    left = dealt.select("key", "grp", "v", F.col("home").alias("a"), F.explode(F.sequence("home", F.lit(n - 1))).alias("b"))
    right = dealt.select("key", "grp", "v", F.col("home").alias("b"), F.explode(F.sequence(F.lit(0), "home")).alias("a")).filter("a < b")

    def run(at: tuple, x: pa.Table, y: pa.Table) -> pa.Table:
        alone, x = at[0].as_py() == at[1].as_py(), x.sort_by("grp")
        y = x if alone else y.sort_by("grp")
        # Pairs that are met in one order count twice, tiles met with themselves once; of either within groups and in all.
        tallies = {(times, scope): _Tally() for times in (1, 2) for scope in ("within", "all")}
        if x.num_rows and y.num_rows:
            p, q = (_matrix(t["v"]) for t in (x, y))
            names = x["key"].combine_chunks().dictionary_encode().indices.to_numpy()
            groups = [[_slices(t["grp"].slice(k, TILE)) for k in range(0, t.num_rows, TILE)] for t in (x, y)]
            for i in range(0, len(p), TILE):
                for j in range(i if alone else 0, len(q), TILE):
                    units = np.rint((p[i : i + TILE] @ q[j : j + TILE].T) * 10**DECIMALS).astype(np.int64)
                    # Equal keys are in one block.
                    pair = names[i : i + TILE, None] != names[None, j : j + TILE] if alone else None
                    times = 1 if alone and i == j else 2
                    tallies[times, "all"].add(units if pair is None else units[pair])
                    of, other = groups[0][i // TILE], groups[1][j // TILE]
                    for part in ((of[g], other[g]) for g in of.keys() & other.keys()):
                        tallies[times, "within"].add(units[part] if pair is None else units[part][pair[part]])
        total: dict[str, tuple[np.ndarray, Counter]] = {}
        for (times, scope), t in tallies.items():
            t.count()
            counts, others = total.setdefault(scope, (np.zeros(2 * EDGE + 1, np.int64), Counter()))
            counts += times * t.counts
            others.update({u: times * k for u, k in t.others.items()})
        (within, odd), (every, odd_too) = total["within"], total["all"]
        odd_too.subtract(odd)
        out = []
        for scope, counts, others in (("within", within, odd), ("across", every - within, odd_too)):
            seen = np.flatnonzero(counts)
            rest = np.array([(u, k) for u, k in others.items() if k], np.int64).reshape(-1, 2)
            units, k = np.concatenate((seen - EDGE, rest[:, 0])), np.concatenate((counts[seen], rest[:, 1]))
            out.append(pa.table({"scope": pa.repeat(scope, len(units)), "units": pa.array(units), "n": pa.array(k)}))
        return pa.concat_tables(out)

    parts = min(n * (n + 1) // 2, 4096)
    left, right = (side.repartition(parts, "a", "b").groupBy("a", "b") for side in (left, right))
    found = left.cogroup(right).applyInArrow(run, "scope string, units long, n long")
    return found.groupBy("scope", "units").agg(F.sum("n").alias("n")).select("scope", (F.col("units") / 10**DECIMALS).alias("cos"), "n")


def similarity_report(counts: DataFrame) -> DataFrame:
    """Pairs, mean, and the tenth and ninetieth percentile of each scope's cosines."""
    tails = F.percentile("cos", [0.1, 0.9], F.col("n"))
    found = counts.groupBy("scope").agg(F.sum("n").alias("n"), (F.sum(F.col("cos") * F.col("n")) / F.sum("n")).alias("mean"), tails.alias("t"))
    return found.select("scope", "n", "mean", F.col("t")[0].alias("p10"), F.col("t")[1].alias("p90"))


def centroid_pairs(rows: DataFrame, group: str, vector: str, block: int = 256) -> DataFrame:
    """``a``, ``b`` (a before b) and ``cos`` of all pairs of groups' centroids.

    Centroids are dealt to blocks of some ``block``, and each pair of blocks meets by its two numbers, so the pairs
    are spread evenly however many groups there are. They are as many as the result has; see ``speaker_verdict``
    for a figure of them that lists none.
    """
    unit = rows.select(group, l2_normalize(F.col(vector)).alias("v"))
    c = cut_lineage(centroids(unit, group, "v", eps=0.0))
    n = max(1, -(-c.count() // block))
    home, every = F.pmod(F.xxhash64(group), F.lit(n)), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    a = c.select(F.col(group).alias("a"), F.col("centroid").alias("x"), home.alias("p"), every.alias("q"))
    b = c.select(F.col(group).alias("b"), F.col("centroid").alias("y"), home.alias("s"), every.alias("r"))
    met = a.join(b, (F.col("p") == F.col("r")) & (F.col("q") == F.col("s")) & (F.col("a") < F.col("b")))
    return met.select("a", "b", dot(F.col("x"), F.col("y")).alias("cos"))


def speaker_verdict(rows: DataFrame, group: str, vector: str, threshold: float = 0.35) -> DataFrame:
    """How many pairs of groups' centroids there are, the share above a threshold, and what it says.

    The pairs are counted by their cosine (to six decimals) in the tasks that multiply two blocks; none is listed.
    """
    unit = rows.select(group, l2_normalize(F.col(vector)).alias("v"))
    counts = cosine_counts(centroids(unit, group, "v", eps=0.0), group, group, "centroid")
    n = F.coalesce(F.sum("n"), F.lit(0))
    share = counts.agg((n / 2).cast("long").alias("pairs"), (F.sum(F.when(F.col("cos") > threshold, F.col("n")).otherwise(0)) / F.sum("n")).alias("share"))
    return share.withColumn("verdict", F.when(F.col("share") > 0.9, "ONE").when(F.col("share") < 0.2, "MANY").otherwise("MIXED"))
