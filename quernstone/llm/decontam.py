"""Benchmark decontamination by SimHash windows and multi-index Hamming blocks (operator 8)."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DataType, StructType

from quernstone.llm.common import cut_lineage, free_name

#: Bytes of a word: digits, letters (capitals lowered) and all beyond ASCII; other bytes part words.
FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower())
#: Odd multiplier that sets a shingle's words apart by place.
SPREAD = 0x9E3779B97F4A7C15
#: Blocks of a fingerprint, of eight bits each.
BLOCKS = 8
#: Slots (a power of two) of the table that says whether any benchmark shingle has these low hash bits.
SLOTS = 1 << 22


def shingle_hashes(text: bytes | None, shingle: int) -> tuple[np.ndarray, int]:
    """64-bit hashes of the runs of ``shingle`` words, repeats included, and the number of words.

    Fewer words: the whole sequence is the one shingle; none: no shingle.
    """
    words = (text or b"").translate(FOLD).split()
    if not words:
        return np.zeros(0, np.uint64), 0
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(shingle, len(words))
    n = len(words) - width + 1
    h = np.full(n, width, np.uint64)
    for j in range(width):
        h = h * np.uint64(SPREAD) + ids[j : j + n]
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32)), len(words)


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _near_bytes(value: int, radius: int) -> np.ndarray:
    """Of the 256 bytes, those within ``radius`` bits of a value."""
    return np.array([(x ^ value).bit_count() <= radius for x in range(256)])


class Items:
    """Benchmark items: shingles with their counts, fingerprints, and the blocks' tables."""

    def __init__(self, rows: list[tuple[object, bytes]], shingle: int, radius: int):
        self.shingle, self.radius = shingle, radius
        found = [(i, *shingle_hashes(t, shingle)) for i, t in rows]
        found = [(i, h, n) for i, h, n in found if n]
        self.ids = [i for i, _, _ in found]
        self.words = np.array([n for _, _, n in found], np.int64)
        self.shingles = [Counter(h.tolist()) for _, h, _ in found]
        self.prints = np.stack([self.fingerprint(_bits(h).sum(axis=0), len(h)) for _, h, _ in found]) if found else np.zeros((0, BLOCKS), np.uint8)
        self.known = np.unique(np.concatenate([h for _, h, _ in found])) if found else np.zeros(0, np.uint64)
        self.slots = np.zeros(SLOTS, bool)
        self.slots[(self.known & np.uint64(SLOTS - 1)).astype(np.int64)] = True
        self.lengths = np.unique(self.words)
        #: By number of words, the items that have it, and for each block and byte those of them whose block is
        #: within floor(radius / BLOCKS) bits.
        near = np.stack([_near_bytes(v, radius // BLOCKS) for v in range(256)])
        self.of_length = {int(n): np.flatnonzero(self.words == n) for n in self.lengths}
        self.blocks = {n: [near[:, self.prints[at, b]] for b in range(BLOCKS)] for n, at in self.of_length.items()}

    @staticmethod
    def fingerprint(ones: np.ndarray, n: int) -> np.ndarray:
        """SimHash of shingles weighted by their counts, as eight bytes."""
        return np.packbits(ones * 2 > n, axis=-1, bitorder="little")

    def matches(self, text: bytes | None, similarity: float, uneven: bool = False) -> list[tuple[int, float, int, int]]:
        """(item, similarity, first word, words) for each item that some window of the text repeats.

        ``uneven``: a text shorter than an item is a window as it is, and items shorter than a shingle are met by
        runs of their own number of words.
        """
        h, n_words = shingle_hashes(text, self.shingle)
        best: dict[int, tuple[float, int]] = {}
        if uneven and n_words:
            self._short_items(text, best)
        if uneven and n_words >= self.shingle:
            self._whole_text(h, n_words, similarity, best)
        self._even(h, n_words, similarity, best)
        return [(self.ids[k], s, -a, int(min(self.words[k], n_words))) for k, (s, a) in sorted(best.items())]

    def _short_items(self, text: bytes, best: dict) -> None:
        for words in self.lengths[self.lengths < self.shingle]:
            runs = shingle_hashes(text, int(words))[0]
            for k in np.flatnonzero(self.words == words):
                at = np.flatnonzero(runs == np.uint64(next(iter(self.shingles[k]))))
                if len(at):
                    best[int(k)] = (1.0, -int(at[0]))

    def _whole_text(self, h: np.ndarray, n_words: int, similarity: float, best: dict) -> None:
        # An item of more shingles than this has too many for the text to be similar.
        longer = np.flatnonzero((self.words > n_words) & ((self.words - self.shingle + 1) * similarity <= len(h)))
        if not len(longer) or np.isin(h, self.known).sum() < similarity * len(h):
            return
        have = Counter(h.tolist())
        for k in longer.tolist():
            s = weighted_similarity(have, self.shingles[k])
            if s >= similarity:
                best[k] = (s, 0)

    def _even(self, h: np.ndarray, n_words: int, similarity: float, best: dict) -> None:
        at = np.flatnonzero(self.slots[(h & np.uint64(SLOTS - 1)).view(np.int64)])
        if len(at):
            at = at[self.known[np.minimum(np.searchsorted(self.known, h[at]), len(self.known) - 1)] == h[at]]
        if not len(at):
            return
        hit = np.zeros(len(h), np.int64)
        hit[at] = 1
        shared = np.concatenate(([0], np.cumsum(hit)))
        for words in self.lengths:
            width = min(self.shingle, int(words))
            span = int(words) - width + 1  # shingles of a window
            if words > n_words or (words < self.shingle <= n_words):
                continue
            # A window is similar only if so many of its shingles are of some item: all others have too low a similarity.
            starts = np.flatnonzero(shared[span:] - shared[:-span] >= similarity * span)
            for a in range(0, len(starts), 4096):
                self._windows(h, starts[a : a + 4096], span, int(words), similarity, best)

    def _windows(self, h: np.ndarray, starts: np.ndarray, span: int, words: int, similarity: float, best: dict) -> None:
        # Fingerprints of all windows from running sums of the shingles' bits, stretch by stretch.
        cuts = np.flatnonzero(np.diff(starts) > span) + 1
        prints = []
        for part in np.split(starts, cuts):
            low, high = int(part[0]), int(part[-1]) + span
            sums = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(_bits(h[low:high]), axis=0, dtype=np.int32)))
            prints.append(self.fingerprint(sums[part - low + span] - sums[part - low], span))
        prints = np.concatenate(prints)
        for a in range(0, len(starts), 256):
            block = prints[a : a + 256]
            met = np.zeros((len(block), len(self.of_length[words])), bool)
            for table, byte in zip(self.blocks[words], block.T):
                met |= table[byte]
            row, item = np.nonzero(met)
            item = self.of_length[words][item]
            apart = np.bitwise_count(block[row] ^ self.prints[item]).sum(axis=1)
            for r, k in zip(row[apart <= self.radius].tolist(), item[apart <= self.radius].tolist()):
                start = int(starts[a + r])
                s = weighted_similarity(Counter(h[start : start + span].tolist()), self.shingles[k])
                if s >= similarity:
                    best[k] = max(best.get(k, (0.0, 0)), (s, -start))


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Shingles in common over shingles in either, each weighted by its count: sum of minima over sum of maxima."""
    return (a & b).total() / (a | b).total()


def contaminations(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, similarity: float = 0.8, radius: int = 23, max_items: int = 20_000, max_bytes: int = 1 << 25, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", uneven: bool = False) -> DataFrame:
    """``id_col``, ``item_col``, ``similarity``, ``first_word`` and ``words`` for each item that a document repeats.

    For each item, every window of the document with as many words as the item has is a candidate if its SimHash
    is within ``radius`` bits of the item's. Both fingerprints are cut into eight blocks: if they differ in
    ``radius`` bits at most, some block differs in floor(radius / 8) at most, so looking the items of the window's
    length up by each block finds all of them. Candidates stay if the similarity of their word shingles, weighted by count, reaches
    ``similarity``; the best window of an item is returned, the first at ties. Windows with too few of the
    benchmark's shingles to reach ``similarity`` with any item are left out before they are fingerprinted.

    Words are lower-cased runs of ASCII letters, digits and other scripts, so case, punctuation and line ends
    don't matter. Documents are read once and not shuffled. The benchmark is broadcast by some ``max_items`` items
    and ``max_bytes`` of text at a time; a larger one is compared part by part, by hash of the item. Null and empty
    texts, on either side, match nothing; so does an item longer than the document, and one with fewer words than a
    shingle unless it is the whole document. With ``uneven`` these two do: a document shorter than the item, but of
    a shingle at least, is one window as it is, and an item below a shingle is met by runs of its own number of
    words, in documents of any length. A document below a shingle is no window of a longer item: its one short
    shingle is none of that item's. Repeated documents each get their rows, an empty table has none, and further
    columns are left out (``uncontaminated`` keeps them, whatever their names); items with a null id are left out, and of an id with several texts each text counts.
    """
    kind = benchmark.schema[item_col].dataType
    parts = [_search(docs.select(id_col, text_col), "_matches", items, similarity, text_col, kind, uneven) for items in _parts(benchmark, shingle, radius, max_items, max_bytes, item_col, item_text_col)]
    found = reduce(DataFrame.unionByName, parts).select(id_col, F.inline("_matches")).withColumnRenamed("_item", item_col)
    if len(parts) == 1:
        return found
    best = F.max_by(F.struct("similarity", "first_word", "words"), F.struct("similarity", -F.col("first_word")))
    return found.groupBy(id_col, item_col).agg(best.alias("b")).select(id_col, item_col, "b.*")


def uncontaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, similarity: float = 0.8, radius: int = 23, max_items: int = 20_000, max_bytes: int = 1 << 25, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", uneven: bool = False) -> DataFrame:
    """The documents, whole, for which ``contaminations`` finds nothing; in place, without a join.

    A benchmark of several parts takes a pass for each, with the documents that are left written between.
    """
    parts = _parts(benchmark, shingle, radius, max_items, max_bytes, item_col, item_text_col)
    matches = free_name(docs, "_matches")
    for k, items in enumerate(parts):
        docs = cut_lineage(docs) if k else docs
        docs = _search(docs, matches, items, similarity, text_col, benchmark.schema[item_col].dataType, uneven).filter(F.size(matches) == 0).drop(matches)
    return docs


def _parts(benchmark: DataFrame, shingle: int, radius: int, max_items: int, max_bytes: int, item_col: str, item_text_col: str) -> Iterable[Items]:
    """The benchmark by parts of some ``max_items`` and ``max_bytes`` of text at most; one part at least."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).filter("item is not null and text is not null").distinct()
    count, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = max(1, -(-count // max_items) * 2 - 1, -(-size // max_bytes) * 2 - 1)
    for part in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == part).select("item", F.col("text").cast("binary")).orderBy("item", "text").collect()
        yield Items([(r.item, bytes(r.text)) for r in rows], shingle, radius)


def _search(docs: DataFrame, matches: str, items: Items, similarity: float, text_col: str, item_type: DataType, uneven: bool) -> DataFrame:
    """``docs`` with the array ``matches``."""
    sent = docs.sparkSession.sparkContext.broadcast(items)
    match = pa.struct([("_item", to_arrow_type(item_type)), ("similarity", pa.float64()), ("first_word", pa.int64()), ("words", pa.int64())])
    names = [f.name for f in match]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.binary())
            found = [[dict(zip(names, m)) for m in sent.value.matches(t.as_py(), similarity, uneven)] for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(match))], names=[*batch.schema.names, matches])

    one = StructType().add("_item", item_type).add("similarity", "double").add("first_word", "long").add("words", "long")
    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(matches, ArrayType(one)))
