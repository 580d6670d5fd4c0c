"""Edit distances of words and characters by bit vectors, Arrow-batched."""

from __future__ import annotations

from collections.abc import Hashable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def edits(a: Sequence[Hashable], b: Sequence[Hashable]) -> int:
    """Unit-cost Levenshtein distance of two sequences.

    Equal heads and tails are taken off. Then a column of the table of distances is kept as two numbers with a bit
    for each item of the longer sequence, set where the distance rises or falls by one from the item before
    (Myers 1999), and each item of the shorter sequence moves it on by a dozen operations on these numbers. So the
    time is that of the product of the lengths over the bits of a machine word.
    """
    head, least = 0, min(len(a), len(b))
    while head < least and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < least - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    places: dict[Hashable, int] = dict.fromkeys(b, 0)
    for i, x in enumerate(a):
        if x in places:
            places[x] |= 1 << i
    every, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    rises, falls, distance = every, 0, len(a)
    for x in b:
        same = places[x]
        diagonal = (((same & rises) + rises) ^ rises) | same | falls
        up = falls | (every & ~(diagonal | rises))
        down = rises & diagonal
        if up & last:
            distance += 1
        elif down & last:
            distance -= 1
        up = up << 1 | 1
        rises = (down << 1 | ~(diagonal | up)) & every
        falls = up & diagonal & every
    return distance


def edit_distance(a: Column, b: Column) -> Column:
    """``edits`` on two columns of arrays of strings; nulls are equal to nulls. Null for a null array."""

    @F.pandas_udf("long")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in parts:
            yield pd.Series([None if p is None or q is None else edits(p.tolist(), q.tolist()) for p, q in zip(x, y)], dtype="Int64")

    return run(a, b)


def text_distances(ref: Column, hyp: Column) -> Column:
    """A struct of ``words`` and ``chars``: the distances of two texts' words, between single spaces, and code points."""

    @F.pandas_udf("words long, chars long")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for x, y in parts:
            rows = [(edits([w for w in p.split(" ") if w], [w for w in q.split(" ") if w]), edits(p, q)) for p, q in zip(x, y)]
            yield pd.DataFrame(rows, columns=["words", "chars"])

    return run(ref, hyp)
