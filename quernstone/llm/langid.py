"""Language identification by a byte convolutional network trained in numpy (operator 5)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of a window; shorter windows are filled with zeros.
WINDOW = 256
#: Filter widths, filters of each width, and numbers that stand for a byte.
WIDTHS, FILTERS, EMBED = (2, 3, 4), 16, 8
#: Windows that are convolved at a time, so that they stay in a core's cache.
BLOCK = 64
#: Letters, and some numbers that are neither digits nor letters.
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def windows(text: bytes) -> np.ndarray:
    """The whole text as rows of ``WINDOW`` bytes, one row at least."""
    rows = max(1, -(-len(text) // WINDOW))
    out = np.zeros(rows * WINDOW, np.uint8)
    out[: len(text)] = np.frombuffer(text, np.uint8)
    return out.reshape(rows, WINDOW)


@dataclass
class ByteNet:
    """Byte embedding, filters of several widths, max pooling over the window, softmax over languages."""

    languages: list[str]
    embed: np.ndarray  # (256, EMBED)
    filters: list[np.ndarray]  # for each width: (width, EMBED, FILTERS)
    bias: np.ndarray  # (len(WIDTHS) * FILTERS,)
    dense: np.ndarray  # (len(WIDTHS) * FILTERS, languages)
    offset: np.ndarray  # (languages,)

    @classmethod
    def fresh(cls, languages: list[str], seed: int) -> ByteNet:
        rng, n = np.random.default_rng(seed), len(WIDTHS) * FILTERS
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        return cls(languages, draw(256, EMBED, scale=0.5), [draw(w, EMBED, FILTERS, scale=(w * EMBED) ** -0.5) for w in WIDTHS], np.zeros(n, np.float32), draw(n, len(languages), scale=n**-0.5), np.zeros(len(languages), np.float32))

    def pairs(self) -> list[list[np.ndarray]]:
        """For each width the filters' values by byte pair, then, for an odd width, by the last byte.

        A filter is linear in the bytes' embeddings, so two neighbouring bytes need one look-up.
        """
        out = []
        for f in self.filters:
            by_byte = [self.embed @ f[j] for j in range(len(f))]
            out.append([(by_byte[j][:, None] + by_byte[j + 1][None]).reshape(-1, FILTERS) for j in range(0, len(f) - 1, 2)] + ([by_byte[-1]] if len(f) % 2 else []))
        return out

    def probabilities(self, rows: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """(windows, languages) for (windows, WINDOW) bytes."""
        out = np.empty((len(rows), len(self.languages)), np.float32)
        for k in range(0, len(rows), BLOCK):
            part = rows[k : k + BLOCK].astype(np.int32)
            pair = part[:, :-1] * 256 + part[:, 1:]
            best = []
            for width, table in zip(WIDTHS, tables):
                n = WINDOW - width + 1
                total = table[0].take(pair[:, :n], axis=0)
                for j, t in zip(range(2, width, 2), table[1:]):
                    total += t.take((pair if len(t) > 256 else part)[:, j : j + n], axis=0)
                best.append(total.max(axis=1))
            out[k : k + BLOCK] = self.softmax(np.maximum(np.concatenate(best, axis=1) + self.bias, 0))
        return out

    def softmax(self, hidden: np.ndarray) -> np.ndarray:
        z = hidden @ self.dense + self.offset
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def step(self, rows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy, in the order of ``weights``."""
        n, part = len(rows), rows.astype(np.int32)
        best, where = [], []
        for f, width in zip(self.filters, WIDTHS):
            count = WINDOW - width + 1
            total = sum((self.embed @ f[j]).take(part[:, j : j + count], axis=0) for j in range(width))
            at = total.argmax(axis=1)
            best.append(np.take_along_axis(total, at[:, None], axis=1)[:, 0])
            where.append(at)
        pre = np.concatenate(best, axis=1) + self.bias
        hidden = np.maximum(pre, 0)
        grad = self.softmax(hidden)
        grad[np.arange(n), target] -= 1
        grad /= n
        d_hidden = (grad @ self.dense.T) * (pre > 0)
        d_embed, d_filters = np.zeros_like(self.embed), []
        for i, (f, width) in enumerate(zip(self.filters, WIDTHS)):
            d = d_hidden[:, i * FILTERS : (i + 1) * FILTERS]
            d_f = np.empty_like(f)
            for j in range(width):
                seen = np.take_along_axis(part, where[i] + j, axis=1)
                d_f[j] = np.einsum("nf,nfe->ef", d, self.embed[seen])
                np.add.at(d_embed, seen, d[:, :, None] * f[j].T[None])
            d_filters.append(d_f)
        return [d_embed, *d_filters, d_hidden.sum(axis=0), hidden.T @ grad, grad.sum(axis=0)]

    def weights(self) -> list[np.ndarray]:
        return [self.embed, *self.filters, self.bias, self.dense, self.offset]


def train(rows: np.ndarray, target: np.ndarray, languages: list[str], steps: int = 500, batch: int = 96, rate: float = 4e-3, seed: int = 7) -> ByteNet:
    """Adam on random windows, each cut to a random length so that short texts are learnt as well."""
    net, rng = ByteNet.fresh(languages, seed), np.random.default_rng(seed)
    first, second = ([np.zeros_like(w) for w in net.weights()] for _ in range(2))
    for t in range(1, steps + 1):
        at = rng.integers(0, len(rows), batch)
        part = rows[at].copy()
        part[np.arange(WINDOW)[None] >= np.where(rng.random(batch) < 0.5, WINDOW, rng.integers(16, WINDOW, batch))[:, None]] = 0
        for w, g, m, v in zip(net.weights(), net.step(part, target[at]), first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return net


def learnable(id_col: str = "doc_id") -> Column:
    """Rows that may be learnt from: the CRC-32 of the id as text isn't 2 modulo 4."""
    return F.crc32(F.col(id_col).cast("string")) % 4 != 2


def fit(docs: DataFrame, max_docs: int = 6000, per_doc: int = 4, max_languages: int = 1000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteNet | None:
    """A network learnt from a sample of ``max_docs`` rows at most, an equal share of each language.

    Only rows that are ``learnable`` and have a text and a language are used, and every language is learnt, from
    one row at least. The sample is the first rows of each language by a hash of the id, and at ties of the text,
    so it depends on the table's content alone; the driver receives ``per_doc`` windows of each sampled row. None
    if there is nothing to learn; an error if there are more than ``max_languages`` values to learn.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(learnable("id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().limit(max_languages + 1).collect()}
    if not counts:
        return None
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages to learn; clean {lang_col!r} or raise max_languages")
    languages = sorted(counts)
    share = max(1, max_docs // len(languages))
    # Half as many rows again as are wanted, and some, pass by their hash, so that few move; of those the first stay.
    passing = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, (1.5 * share + 64) / n))))
    by_id = F.xxhash64("id", F.lit("language sample"))
    chosen = rows.filter(F.pmod(by_id, F.lit(1 << 30)) < passing[F.col("lang")] * (1 << 30))
    order = F.struct(F.pmod(by_id, F.lit(1 << 30)).alias("h"), by_id.alias("of"), F.xxhash64("text").alias("text"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                rng = np.random.default_rng(len(text))
                starts = [int(rng.integers(0, max(1, len(text) - WINDOW + 1))) for _ in range(per_doc)]
                found.append([text[a : a + WINDOW] for a in starts])
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(found, pa.list_(pa.binary()))], names=["lang", "at", "parts"])

    windowed = chosen.select("text", "lang", order.alias("at")).mapInArrow(cut, "lang string, at struct<h: long, of: long, text: long>, parts array<binary>")
    first = Window.partitionBy("lang").orderBy("at", "parts")
    sample = windowed.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= share).select("lang", F.explode("parts").alias("part")).toArrow()
    parts, langs = sample["part"].to_pylist(), sample["lang"].to_pylist()
    order = sorted(range(len(parts)), key=lambda k: (langs[k], parts[k]))  # rows arrive in any order
    place = {x: k for k, x in enumerate(languages)}
    target = np.array([place[langs[k]] for k in order])
    return train(np.concatenate([windows(parts[k])[:1] for k in order]), target, languages)


def predict(docs: DataFrame, net: ByteNet | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All of ``docs``' columns, with ``lang_pred`` and ``score``.

    Every window of the whole text is classified; the text's probabilities are the windows', weighted by their
    bytes. ``score`` is the predicted language's probability; of equally likely languages the first by name is
    predicted. Null texts, texts without a letter, and all texts if there is no network: ``und``, score 0. Bytes
    that aren't UTF-8 are bytes like any other, and no letters. Rows are independent: repeated ones have equal
    results, an empty table none. Columns that are called ``lang_pred`` or ``score`` are replaced.
    """
    docs = docs.drop("lang_pred", "score")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.pairs() if net else None
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            langs, scores = [], []
            for text in batch.column(at).cast(pa.binary()):
                raw = text.as_py()
                if not (net and raw and has_letter(raw.decode(errors="ignore"))):
                    langs.append("und")
                    scores.append(0.0)
                    continue
                rows = windows(raw)
                share = np.full(len(rows), WINDOW, np.float64)
                share[-1] = len(raw) - WINDOW * (len(rows) - 1)
                p = share @ net.probabilities(rows, tables) / share.sum()
                langs.append(net.languages[int(p.argmax())])
                scores.append(min(1.0, float(p.max())))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    schema = StructType([*docs.schema.fields]).add("lang_pred", "string").add("score", "double")
    return docs.mapInArrow(run, schema)
