"""Exact percentiles of groups of any size: ranks are narrowed down to a range of values, round by round."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quernstone.checkpoints import cut_lineage

#: Values of a group that one task may hold, and rows that are broadcast at most.
BOUND, BROADCAST = 1 << 20, 1 << 17
#: Cells into which a round parts the values that are left.
GRID = 128


@dataclass(frozen=True)
class Percentiles:
    """Percentiles of ``value`` at ``fractions``, interpolated, or with ``discrete`` the value that reaches the share.

    Null and NaN aren't measured and count for nothing.
    """

    value: Column
    fractions: tuple[float, ...] = (0.5,)
    discrete: bool = False

    def measured(self) -> Column:
        value = self.value.cast("double")
        return F.when(~F.isnan(value), value)

    def plain(self) -> Column:
        """An array of the percentiles of a group that fits a task."""
        if self.discrete:
            found = F.array_sort(F.collect_list(self.measured()))
            return F.when(F.size(found) > 0, F.array(*(F.get(found, F.greatest(F.ceil(F.size(found) * f) - 1, F.lit(0)).cast("int")) for f in self.fractions)))
        return F.percentile(self.measured(), list(self.fractions))

    def ranks(self, n: Column) -> list[Column]:
        """Two ranks (from 0) for each fraction, the second after or at the first."""
        if self.discrete:
            at = [F.greatest(F.ceil(n * f) - 1, F.lit(0)) for f in self.fractions]
            return [x for k in at for x in (k, k)]
        return [x for f in self.fractions for x in (F.floor((n - 1) * F.lit(f)), F.ceil((n - 1) * F.lit(f)))]

    def joined(self, n: Column, values: Column) -> Column:
        """The array of percentiles, from the values at ``ranks``."""
        out = []
        for k, f in enumerate(self.fractions):
            low, high, at = F.get(values, F.lit(2 * k)), F.get(values, F.lit(2 * k + 1)), (n - 1) * F.lit(f)
            between = (F.ceil(at) - at) * low + (at - F.floor(at)) * high
            out.append(low if self.discrete else F.when(F.floor(at) == F.ceil(at), low).otherwise(between))
        return F.array(*out)


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST else rows


def _same(keys: Sequence[str]) -> Column:
    """Equal keys, those of the right side with an underscore; null equals null."""
    out = F.lit(True)
    for k in keys:
        out &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return out


def _narrowed(rows: DataFrame, state: DataFrame, keys: Sequence[str], bound: int) -> DataFrame:
    """``state`` with ranges that hold each rank and ``bound`` values, or one value, at most.

    ``rows`` has the keys and ``v``; ``state`` has the keys (with an underscore), ``j`` and ``rank``, and its rank is
    in the range from ``lo`` to ``hi``, in which ``inside`` values lie and before which ``below`` do.
    """
    of = [f"_{k}" for k in keys] + ["j"]
    v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
    while True:
        large = (F.col("inside") > bound) & (lo < hi)
        left = cut_lineage(state.filter(large))
        if left.isEmpty():
            return state
        done = state.filter(~large)
        met = lambda part: rows.join(_small(part), _same(keys) & (v >= lo) & (v <= hi))
        cuts = met(left).groupBy(*of).agg(F.percentile_approx("v", [k / GRID for k in range(GRID + 1)], 8 * GRID).alias("cuts"))
        cell = F.floor((F.col("rank") - F.col("below")) / F.col("inside") * GRID).cast("int")
        edges = {"a": F.get("cuts", F.greatest(cell - 1, F.lit(0))), "b": F.get("cuts", F.least(cell + 2, F.lit(GRID)))}
        left = cut_lineage(left.join(cuts.toDF(*(f"c_{c}" for c in of), "cuts"), _matching(of)).withColumns(edges).select(*of, "rank", "lo", "hi", "below", "inside", "a", "b"))
        a, b = F.col("a"), F.col("b")
        counted = met(left).groupBy(*of).agg(
            F.count_if(v < a).alias("n_before"), F.count_if(v == a).alias("n_a"), F.count_if((v > a) & (v < b)).alias("n_within"), F.count_if((v == b) & (a < b)).alias("n_b"),
            F.max(F.when(v < a, v)).alias("before"), F.min(F.when((v > a) & (v < b), v)).alias("low"), F.max(F.when((v > a) & (v < b), v)).alias("high"), F.min(F.when(v > b, v)).alias("after"),
        )
        both = left.join(counted.toDF(*(f"c_{c}" for c in of), *counted.columns[len(of) :]), _matching(of))
        at, start = F.col("rank") - F.col("below"), F.lit(0).cast("long")
        parts = []
        for n, low, high in (("n_before", lo, F.col("before")), ("n_a", a, a), ("n_within", F.col("low"), F.col("high")), ("n_b", b, b)):
            end = start + F.col(n)
            parts.append((at < end, low, high, start, F.col(n)))
            start = end
        parts.append((F.lit(True), F.col("after"), hi, start, F.col("inside") - start))
        chosen = F.coalesce(*(F.when(ok, F.struct(low.alias("lo"), high.alias("hi"), (F.col("below") + s).alias("below"), n.cast("long").alias("inside"))) for ok, low, high, s, n in parts))
        both = both.select(*of, "rank", chosen.alias("x")).select(*of, "rank", "x.lo", "x.hi", "x.below", "x.inside")
        state = cut_lineage(done.unionByName(both))


def _matching(of: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in of:
        out &= F.col(c).eqNullSafe(F.col(f"c_{c}"))
    return out


def _selected(rows: DataFrame, keys: Sequence[str], wanted: Percentiles, bound: int) -> DataFrame:
    """The keys (with an underscore) and ``q``, the array of percentiles, of groups that are too large for a task."""
    rows = rows.select(*keys, wanted.measured().alias("v")).filter("v is not null")
    sizes = rows.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    of = [f"_{k}" for k in keys]
    state = sizes.select(*of, "n", "lo", "hi", F.posexplode(F.array(*(r.cast("long") for r in wanted.ranks(F.col("n"))))).alias("j", "rank"))
    state = cut_lineage(state.select(*of, "j", "rank", "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside")))
    state = _narrowed(rows, state, keys, bound)
    met = rows.join(_small(state), _same(keys) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
    values = met.groupBy(*of, "j", (F.col("rank") - F.col("below")).alias("at"), "v").agg(F.count("*").alias("c"))
    upto = Window.partitionBy(*of, "j").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    values = values.withColumn("upto", F.sum("c").over(upto)).filter((F.col("upto") > F.col("at")) & (F.col("upto") - F.col("c") <= F.col("at")))
    found = values.groupBy(*of).agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "v"))), lambda x: x["v"]).alias("values"))
    found = found.toDF(*(f"c_{c}" for c in of), "values")
    return sizes.join(found, _matching(of)).select(*of, wanted.joined(F.col("n"), F.col("values")).alias("q"))


def percentiles_by(rows: DataFrame, keys: Sequence[str], wanted: dict[str, Percentiles], others: dict[str, Column] | None = None, bound: int = BOUND) -> DataFrame:
    """The keys, the aggregates ``others`` and, as arrays, the percentiles ``wanted``, of each group of rows.

    Groups of ``bound`` rows at most are aggregated as they are. Of larger ones no task holds more than ``bound``
    values: in each round a sketch of the values that are left gives a few cells around every rank, one more pass
    counts exactly what lies before, in and behind them, and the range that holds the rank is kept, its ends apart
    if they occur often. Only rows of the last ranges are shuffled, counted by value. The result is that of an exact
    percentile of the whole group, to the last bit; the sketch decides only how many rounds it takes.

    Null keys are a group like any other. A group without a measured value has a null array. No keys: one group,
    which has a row even if there are no rows. The number of rows in large groups decides eagerly.
    """
    keys, others = list(keys), others or {}
    plain = [c.alias(k) for k, c in others.items()]
    whole = lambda part: part.groupBy(*keys).agg(*plain, *(p.plain().alias(k) for k, p in wanted.items()))
    hot = cut_lineage(rows.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.count("*").alias("_n")).filter(F.col("_n") > bound).drop("_n") if keys else rows.agg(F.count("*").alias("_n")).filter(F.col("_n") > bound))
    if hot.isEmpty():
        return whole(rows)
    large = rows.join(_small(hot), _same(keys), "left_semi") if keys else rows
    found = large.groupBy(*keys).agg(*plain, F.count("*").alias("_rows")).drop("_rows")
    for name, p in wanted.items():
        values = _selected(large, keys, p, bound)
        found = found.join(values.withColumnRenamed("q", name), _same(keys), "left").drop(*(f"_{k}" for k in keys))
    return whole(rows.join(_small(hot), _same(keys), "left_anti")).unionByName(found) if keys else found
