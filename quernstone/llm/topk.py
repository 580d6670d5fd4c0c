"""Exact top-k inner-product search by term-at-a-time accumulation (operator 2)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries whose dense scores are kept at a time.
ROWS = 64
#: A posting list, or a term's queries, of more than this share of the block are taken as a full row.
FULL = 0.5


def integer_codes(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null if the vector is null or a component is null or not finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(F.col(vector).isNotNull() & good, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of codes, filled with zeros to the longest."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    ends = np.asarray(lists.offsets, np.int64)
    sizes = np.diff(ends)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None] < sizes[:, None]] = np.asarray(lists.flatten(), np.int64)
    return out


def search_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best vectors of a block for each query: query ids, vector ids, scores.

    Of each term, the postings (the block's vectors that have it, and their weights) are scattered into the dense
    scores of the queries that have it, term after term; then a partition selects the best, ties to the smaller id.
    Codes so large that a score might not fit 64 bits are an ``OverflowError``.
    """
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    terms = min(q.shape[1], c.shape[1])
    tops = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (q, c)]
    largest = tops[0] * tops[1] * max(1, terms)
    if max(tops) >= 1 << 62 or largest >= 1 << 63:
        raise OverflowError(f"codes up to {tops[0]} and {tops[1]} in {terms} terms may give scores beyond 64 bits")
    kind = np.int32 if largest < 1 << 31 else np.int64
    q, c = q.astype(kind), c.astype(kind)
    postings = []
    for t in range(terms):
        at = np.flatnonzero(c[:, t])
        postings.append((None, np.ascontiguousarray(c[:, t])) if len(at) > FULL * len(c) else (at, c[at, t]))
    out_q, out_c, out_s = [], [], []
    for a in range(0, len(q), ROWS):
        rows = q[a : a + ROWS]
        scores = np.zeros((len(rows), len(c)), kind)
        for t, (at, weights) in enumerate(postings):
            have = np.flatnonzero(rows[:, t])
            if not len(have) or (at is not None and not len(at)):
                continue
            weight = rows[have, t, None]
            if len(have) <= FULL * len(rows):
                scores[have if at is None else np.ix_(have, at)] += weight * weights
            elif at is None:
                scores += rows[:, t, None] * weights
            else:
                scores[:, at] += rows[:, t, None] * weights
        own = q_ids[a : a + ROWS, None] == c_ids[None]
        take = min(k, len(c))
        if largest < 1 << 40:  # the place in the block breaks ties
            rank = (scores.astype(np.int64) << 20) + (len(c) - 1 - np.arange(len(c)))
            rank[own] = -np.iinfo(np.int64).max
            best = np.argpartition(-rank, take - 1, axis=1)[:, :take]
        else:
            best = np.argsort(np.where(own, np.iinfo(np.int64).max, -scores.astype(np.int64)), axis=1, kind="stable")[:, :take]
        row = np.repeat(np.arange(len(rows)), best.shape[1])
        best = best.ravel()
        keep = ~own[row, best]
        out_q.append(q_ids[a : a + ROWS][row[keep]])
        out_c.append(c_ids[best[keep]])
        out_s.append(scores[row[keep], best[keep]].astype(np.int64))
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (out_q, out_c, out_s))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, query_block: int = 32_768, vector_block: int = 32_768, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's ``k`` best other vectors.

    Queries are the rows where ``is_query`` holds, candidates all rows; vectors become integer codes, and scores
    are their exact inner products. Queries and candidates are dealt to blocks by hash, and each pair of blocks
    is one task's work, so memory is bounded by the block sizes and nothing is broadcast. Only k rows of a query
    leave a pair of blocks, and the merge keeps k before it shuffles. Few vectors are dealt to smaller blocks, so
    that all cores have some.

    Rows with a null id or a vector that is null or holds a null or non-finite component take no part. Rows that
    repeat an id and its vector count once; if an id has several vectors, its query is the smallest of them and
    all are candidates of others, none of its own. Shorter vectors end in zeros. Fewer than ``k`` candidates:
    all; of an empty table nothing. Scores must fit 64 bits, else the job fails. Further columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), integer_codes(vector_col).alias("codes"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("codes").isNotNull()).dropDuplicates(["vec_id", "codes"])
    n, n_queries = rows.agg(F.count("*"), F.count_if("asks")).first()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    g, h = max(1, -(-n // vector_block), min(cores, n // 2048)), max(1, -(-n_queries // query_block))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    candidates = rows.select("vec_id", "codes", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(g)).cast("int").alias("g"), every(h).alias("h"))
    asked = rows.filter("asks").groupBy("vec_id").agg(F.min("codes").alias("codes"))
    asked = asked.select("vec_id", "codes", F.pmod(F.xxhash64("vec_id"), F.lit(h)).cast("int").alias("h"), every(g).alias("g"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = search_block(left["vec_id"].to_numpy(), _matrix(left["codes"]), right["vec_id"].to_numpy(), _matrix(right["codes"]), k) if left.num_rows and right.num_rows else [np.zeros(0, np.int64)] * 3
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    found = asked.groupBy("g", "h").cogroup(candidates.groupBy("g", "h")).applyInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
