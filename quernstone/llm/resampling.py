"""Importance resampling towards a target distribution, with overlap chunks of long texts (operator 11)."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import cut_lineage
from quernstone.operators.scans import places

#: Bytes of a word: digits, letters (capitals lowered) and all beyond ASCII; other bytes part words.
FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())


def chunks(text: bytes | None, words: int, n: int) -> Iterator[tuple[int, bytes]]:
    """(owned words, chunk) of a text: cut between words, ``words`` of them own a chunk.

    A chunk carries the n - 1 words that follow its own, so that every run of n words is whole in the chunk that
    owns its first word. Words are folded and joined by one space. A text without a word is one empty chunk.
    """
    found = (text or b"").translate(FOLD).split()
    for k in range(0, max(1, len(found)), words):
        yield min(words, len(found) - k), b" ".join(found[k : k + words + n - 1])


def buckets_of(chunk: bytes, owned: int, n: int, buckets: int) -> np.ndarray:
    """The buckets of all runs of 1 to n words that start in the chunk's ``owned`` first words, repeats included."""
    words = chunk.split()
    crc, runs, out = zlib.crc32, words[:owned], []
    for length in range(1, n + 1):
        if length > 1:  # each run is the one before it, a space and a word more
            runs = [b"%b %b" % pair for pair in zip(runs, words[length - 1 :])]
        out.append(np.fromiter(map(crc, runs), np.int64, len(runs)) % buckets)
    return np.concatenate(out)


def _chunked(docs: DataFrame, n: int, words: int, long_bytes: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Short and long texts as ``id``, ``copy`` (a long text's digest, else null), ``part``, ``owned`` and ``chunk``.

    A text of ``long_bytes`` at most is one chunk and stays where it is read. Longer ones are cut, and their chunks
    are dealt to all tasks by the text's digest and their place.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    schema = f"id {given.schema['id'].dataType.simpleString()}, copy string, part long, owned long, chunk binary"

    def cut(size: int | None):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = 1 if size else 64
                for k in range(0, batch.num_rows, rows):
                    some = batch.slice(k, rows)
                    found = [(r, p, *c) for r, t in enumerate(some.column(1)) for p, c in enumerate(chunks(t.as_py(), size or 1 << 62, n))]
                    for a in range(0, len(found), 64):
                        row, part, owned, chunk = zip(*found[a : a + 64])
                        yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(row)), some.column(2).take(pa.array(row)), pa.array(part, pa.int64()), pa.array(owned, pa.int64()), pa.array(chunk, pa.binary())], names=["id", "copy", "part", "owned", "chunk"])

        return run

    long = F.coalesce(F.octet_length("text") > long_bytes, F.lit(False))
    short = given.filter(~long).withColumn("copy", F.lit(None).cast("string")).mapInArrow(cut(None), schema)
    return short, given.filter(long).withColumn("copy", F.md5("text")).mapInArrow(cut(words), schema).repartition("copy", "part")


def bucket_counts(docs: DataFrame, n: int = 2, buckets: int = 10_000, words: int = 1 << 15, long_bytes: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``bucket`` and ``n`` of all runs of 1 to ``n`` words of all texts, repeats included, for buckets that have any.

    Each task adds its chunks up and gives one row a bucket. Null and empty texts have no runs.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for owned, chunk in zip(batch.column(0), batch.column(1)):
                total += np.bincount(buckets_of(chunk.as_py(), owned.as_py(), n, buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    short, long = _chunked(docs, n, words, long_bytes, id_col, text_col)
    counted = short.unionByName(long).select("owned", "chunk").mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """By bucket, a thousand times the logarithm of the target's smoothed share over the source's, floored."""
    s, t = np.zeros((2, buckets), np.int64)
    for out, counts in ((s, source), (t, target)):
        for r in counts.collect():  # a row for each bucket at most
            out[r.bucket] = r.n
    many, some = float(s.sum() + buckets), float(t.sum() + buckets)
    return np.array([math.floor(1000 * math.log((x + 1) * many / ((y + 1) * some))) for x, y in zip(map(float, t), map(float, s))], np.int64)


def weights(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000, words: int = 1 << 15, long_bytes: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` (longs but for the id) of each document.

    Features are the runs of 1 to ``n`` words, by the CRC-32 of their bytes modulo ``buckets``. A bucket's gain
    compares its share among the target's features with that among all documents'; the weight is the floored mean
    of the gains over a document's features, 0 without any.

    A text longer than ``long_bytes`` is cut into chunks of ``words`` words that carry the n - 1 words after them;
    a chunk owns the runs that start in its own words. The chunks of such texts are dealt to all tasks, and their
    counts and sums of gains are summed by document. Shorter texts are measured where they are read, and no text of
    theirs is shuffled. ``buckets`` bounds what the driver sees and what is broadcast.

    Words are runs of ASCII letters (capitals lowered), digits and all beyond ASCII. Null and empty texts have no
    feature; null ids are kept. Each row counts and comes out, rows that repeat an id or a whole row too. An empty
    target or table counts no feature. Further columns are left out.
    """
    where = {"n": n, "buckets": buckets, "words": words, "long_bytes": long_bytes}
    known = target.select(F.lit(0).alias("id"), F.col(target_text_col).alias("text"))
    table = gains(bucket_counts(docs, id_col=id_col, text_col=text_col, **where), bucket_counts(known, id_col="id", text_col="text", **where), buckets)
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [buckets_of(c.as_py(), o.as_py(), n, buckets) for o, c in zip(batch.column(3), batch.column(4))]
            sums = pa.array([int(sent.value[x].sum()) for x in found], pa.int64()), pa.array([len(x) for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *sums], names=["id", "copy", "part", "owned", "gain", "n_features"])

    kind = docs.schema[id_col].dataType.simpleString()
    short, long = (part.mapInArrow(run, f"id {kind}, copy string, part long, owned long, gain long, n_features long") for part in _chunked(docs, n, words, long_bytes, id_col, text_col))
    # Of equal rows each chunk comes as often as its first one.
    sums = (F.expr(f"sum({c}) div count_if(part = 0)").alias(c) for c in ("owned", "gain", "n_features"))
    long = long.groupBy("id", "copy").agg(F.count_if(F.col("part") == 0).alias("copies"), *sums)
    long = long.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    columns = ["id", "owned", "gain", "n_features"]
    both = short.select(*columns).unionByName(long.select(*columns))
    mean = F.expr("(gain - pmod(gain, n_features)) div n_features")
    return both.select(F.col("id").alias(id_col), F.col("owned").alias("n_words"), "n_features", F.when(F.col("n_features") > 0, mean).otherwise(0).cast("long").alias("weight"))


def gumbel(id_col: str, seed: int = 7) -> Column:
    """A thousandfold standard Gumbel variate, floored, by a digest of the seed and the id; a null id counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7, id_col: str = "doc_id", **how) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank`` of each document.

    The score is the weight of ``weights`` (whose parameters ``how`` are) and a Gumbel variate of the id, so the
    highest scores are a draw without replacement in proportion to the exponential of the weights. Of the
    documents with ``least_words`` words at least, ``percent`` in a hundred (floored) are drawn; ``rank`` is their
    place from 1, and null for all others. At equal scores the smaller id comes first, null ids last; rows that
    repeat an id follow by weight and features.

    Places are numbered by ranges of the order, so no task sees more than a range of the scores.
    """
    found = weights(docs, target, id_col=id_col, **how)
    found = cut_lineage(found.withColumns({"score": F.col("weight") + gumbel(id_col, seed), "fit": F.col("n_words") >= least_words}))
    drawn = percent * found.filter("fit").count() // 100
    order = [F.desc("fit"), F.desc("score"), F.asc_nulls_last(id_col), F.asc("weight"), F.asc("n_features")]
    placed = places(found, order, "rank")
    rank = F.when(F.col("fit") & (F.col("rank") < drawn), F.col("rank") + 1)
    return placed.select(id_col, "n_features", "weight", "score", rank.cast("long").alias("rank"))
