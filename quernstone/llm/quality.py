"""Quality scores by nearest-neighbour voting in a latent-semantic space (operator 9)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import compress
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quernstone.llm.common import cut_lineage

#: Words: runs of letters and digits, and runs of other signs but white space. Capitals are letters of their own.
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\x00-\x20\x7f0-9A-Za-z\x80-\xff]+")
#: Terms are words and pairs of neighbours, by hash, from 2 on; terms 0 and 1 count repeats.
BITS = 20
#: Odd multipliers that make a pair's hash of its words' hashes.
PAIR = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)

def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def terms_of(text: bytes | None) -> np.ndarray:
    """The terms of the whole text, as often as they occur.

    What stands between white space and equals what stands before it is no word: it counts for term 0 instead.
    What equals what stands two places before counts for term 1 too.
    """
    between = (text or b"").split()
    once, twice = np.zeros((2, len(between)), bool)
    once[1:] = np.fromiter(map(eq, between[1:], between), bool, max(0, len(between) - 1))
    twice[2:] = np.fromiter(map(eq, between[2:], between), bool, max(0, len(between) - 2))
    if once.any():
        text = b" ".join(compress(between, ~once))
    h = _hashes(WORD.findall(text or b""))
    pair = (h[:-1] * np.uint64(PAIR[0]) + h[1:]) * np.uint64(PAIR[1])
    repeated = np.repeat(np.arange(2, dtype=np.uint64), (once.sum(), (twice & ~once).sum()))
    return np.concatenate((np.maximum(np.concatenate((h, pair)) >> np.uint64(64 - BITS), np.uint64(2)), repeated)).astype(np.int32)


def term_counts(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """The different terms of the whole text, in order, and how often each occurs."""
    terms, counts = np.unique(terms_of(text), return_counts=True)
    return terms, counts.astype(np.int32)


def _times(starts: np.ndarray, columns: np.ndarray, values: np.ndarray, dense: np.ndarray, rows: int = 512) -> np.ndarray:
    """A sparse matrix, by rows, times a dense one."""
    out = np.zeros((len(starts) - 1, dense.shape[1]), np.float32)
    for k in range(0, len(out), rows):
        at = starts[k : k + rows + 1]
        full = np.flatnonzero(np.diff(at))
        if len(full):
            part = dense[columns[at[0] : at[-1]]] * values[at[0] : at[-1], None]
            out[k + full] = np.add.reduceat(part, at[full] - at[0], axis=0)
    return out


@dataclass
class Voters:
    """Labelled latent vectors and the projection that makes a document's."""

    place: np.ndarray  # (2 ** BITS,): a term's row of ``project``, -1 if it isn't learnt
    idf: np.ndarray  # (terms,)
    project: np.ndarray  # (terms, dims): singular vectors
    vectors: np.ndarray  # (labelled, dims), in order of label and content
    labels: np.ndarray  # (labelled,), 0 or 1
    prior: float

    def latent(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The text's terms, weighted and of length 1, seen in the latent space; zero if none is known.

        Terms weigh 1 + log of their count, times their inverse document frequency. The more of that the latent
        space can't express, the shorter the vector is and the smaller are its cosines.
        """
        return self._latent(np.repeat(self.place[terms], counts))

    def latent_of(self, text: bytes | None) -> np.ndarray:
        """``latent`` of a text: its terms are looked up first, so that only those which were learnt are counted."""
        return self._latent(self.place[terms_of(text)])

    def _latent(self, places: np.ndarray) -> np.ndarray:
        counts = np.bincount(places[places >= 0], minlength=1)
        place = np.flatnonzero(counts)
        w = (1 + np.log(counts[place])) * self.idf[place] if len(place) else np.zeros(0, np.float32)
        return (w @ self.project[place] / max(np.linalg.norm(w), 1e-12)).astype(np.float32)

    def score(self, latent: np.ndarray, neighbours: int = 15, sharpness: float = 8.0, doubt: float = 1e-6) -> np.ndarray:
        """The labels of the nearest rows, weighted by a power of the cosine, and the prior weighted by ``doubt``.

        Cosines count to six decimals; of equally near rows those with label 0 come first, and then the first in
        the order of their content.
        """
        length = np.maximum(np.linalg.norm(self.vectors, axis=1), 1e-12)
        cosines = np.round(latent @ (self.vectors / length[:, None]).T, 6)
        k = min(neighbours, len(self.labels))
        near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
        weight = np.take_along_axis(cosines, near, axis=1)
        edge = weight.min(axis=1)
        for r in np.flatnonzero((cosines >= edge[:, None]).sum(axis=1) > k):
            near[r] = np.lexsort((np.arange(len(self.labels)), -cosines[r]))[:k]
            weight[r] = cosines[r, near[r]]
        weight = np.maximum(weight, 0).astype(np.float64) ** sharpness
        return (doubt * self.prior + (weight * self.labels[near]).sum(axis=1)) / (doubt + weight.sum(axis=1))


def learn(rows: list[tuple[int, np.ndarray, np.ndarray]], vocabulary: np.ndarray, dims: int = 32, seed: int = 3) -> Voters:
    """Voters of labelled rows: a truncated SVD of the weighted terms, by power iteration.

    ``rows``: label, those terms of the text that are in the vocabulary, and their counts.
    """
    n, place = len(rows), np.full(1 << BITS, -1, np.int32)
    place[vocabulary] = np.arange(len(vocabulary))
    starts = np.cumsum([0, *(len(r[1]) for r in rows)])
    columns = place[np.concatenate([r[1] for r in rows])]
    in_rows = np.bincount(columns, minlength=len(vocabulary))
    idf = np.log((1 + n) / (1 + in_rows)) + 0.05
    row = np.repeat(np.arange(n), np.diff(starts))
    values = (1 + np.log(np.concatenate([r[2] for r in rows]))) * idf[columns]
    values = (values / np.sqrt(np.bincount(row, np.square(values), n))[row]).astype(np.float32)
    by_term = np.argsort(columns, kind="stable")
    turned = np.cumsum([0, *in_rows]), row[by_term], values[by_term]
    q = np.random.default_rng(seed).normal(size=(len(vocabulary), min(dims, len(vocabulary)))).astype(np.float32)
    for _ in range(6):
        q = np.linalg.qr(_times(*turned, _times(starts, columns, values, q)))[0]
    labels = np.array([r[0] for r in rows], np.float64)
    return Voters(place, idf.astype(np.float32), q, _times(starts, columns, values, q), labels, float(labels.mean()))


def learnable(id_col: str = "doc_id") -> Column:
    """Rows whose label may be learnt from: the CRC-32 of the id as text isn't 0 modulo 5."""
    return F.crc32(F.col(id_col).cast("string")) % 5 != 0


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 4096, max_terms: int = 4096, least_rows: int = 3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Voters | None:
    """Voters from ``max_labelled`` labelled rows at most, the first by a hash of the id.

    Of their terms those in ``least_rows`` rows or more are learnt, the ``max_terms`` most frequent at most. Both
    bounds size the model that is broadcast: a vector of 32 numbers for each term and each row.

    Only ``learnable`` ids with label 0 or 1 count; an id with several labels takes its largest, and one with
    several texts the first by hash. The chosen ids are few, so they are broadcast to the documents. None if no
    labelled document is found. The model is of the tables' content alone, whatever their files and order.
    """
    given = labels.select(F.col(id_col).alias("_of"), F.col(label_col).cast("int").alias("_label")).filter(learnable("_of") & F.col("_label").isin(0, 1))
    chosen = given.groupBy("_of").agg(F.max("_label").alias("_label")).orderBy(F.xxhash64("_of", F.lit("quality sample")), "_of").limit(max_labelled)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), F.col("_id") == F.col("_of"))
    texts = texts.groupBy("_of").agg(F.min(F.struct(F.xxhash64("_text"), "_text"))["_text"].alias("_text"), F.first("_label").alias("_label"))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [term_counts(t.as_py()) for t in batch.column(0).cast(pa.binary())]
            lists = [pa.array([x[k] for x in found], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(1), *lists], names=["label", "terms", "counts"])

    sample = cut_lineage(texts.select("_text", "_label").mapInArrow(count, "label int, terms array<int>, counts array<int>"))
    seen = sample.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).filter(F.col("n") >= least_rows)
    vocabulary = np.array([r.term for r in seen.orderBy(F.desc("n"), "term").limit(max_terms).collect()], np.int32)
    known = np.zeros(1 << BITS, bool)
    known[vocabulary] = True

    def prune(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(np.asarray(t.values), np.asarray(c.values)) for t, c in zip(batch.column(1), batch.column(2))]
            lists = [pa.array([r[k][known[r[0]]] for r in rows], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["label", "terms", "counts"])

    found = sample.mapInArrow(prune, sample.schema).toArrow()
    rows = [(label, np.asarray(t.values, np.int32), np.asarray(c.values, np.int32)) for label, t, c in zip(found["label"].to_pylist(), found["terms"], found["counts"])]
    rows.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))
    return learn(rows, vocabulary) if rows else None


def score(docs: DataFrame, voters: Voters | None, threshold: float = 0.3, block: int = 512, text_col: str = "text") -> DataFrame:
    """All of ``docs``' columns, with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on, else 0).

    Each block of documents is compared with every labelled vector. Null and empty texts have no term and take
    the share of label 1 among the labelled rows, to which the score of a text that is near to no labelled one
    tends too; all rows have 0.5 if there are no voters. Ties are settled as ``Voters.score`` says. Rows are
    independent: repeated ones have equal results, an empty table none. Columns that are called ``score`` or
    ``predicted`` are replaced.
    """
    docs = docs.drop("score", "predicted")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary())
            scores = np.full(len(texts), 0.5)
            for k in range(0, len(texts) if voters else 0, block):
                part = [voters.latent_of(t.as_py()) for t in texts[k : k + block]]
                scores[k : k + block] = np.clip(voters.score(np.stack(part)), 0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=[*batch.schema.names, "score", "predicted"])

    schema = StructType([*docs.schema.fields]).add("score", "double").add("predicted", "integer")
    return docs.mapInArrow(run, schema)
