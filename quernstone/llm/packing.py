"""Sum-of-squares online packing of tokenised documents into fixed windows (operator 7)."""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Words whose ids a worker remembers in each of two generations, and the longest word that it does.
MEMO_WORDS, MEMO_BYTES = 1 << 18, 48
#: ASCII punctuation that a word of letters may end with; an apostrophe may be part of a contraction.
TAIL = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) != "'")


def _byte_chars() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is visible Latin-1."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return {b: chr(b if b in shown else next(rest)) for b in range(256)}


class WordTokens:
    """Token ids of whole texts, by way of the words between ASCII white space.

    The tokenizer lowers case and never joins what white space separates, so a word's ids don't depend on its
    neighbours and a word that was seen before needs no second encoding. It parts letters from punctuation too;
    so a word of letters alone goes straight to the tokenizer's model, and the punctuation after it is a word of
    its own. All other words take the tokenizer's whole way. When the memory of words is full it becomes the old
    generation, of which only what is met again is kept.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        #: Marks of the vocabulary that stand for an id of their own, as written, inside words too.
        self.marks = {t.content.encode(): np.array([k], "<u4") for k, t in self.encoder.get_added_tokens_decoder().items()}
        self.mark = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.marks, key=len, reverse=True))) + b")") if self.marks else None
        self.encoder.encode_special_tokens = True  # what is between marks has none, though lower case may make it look so
        self.model, self.chars = self.encoder.model, _byte_chars()
        self.memo: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, text: bytes, end: int) -> np.ndarray:
        """The ids of the text, and ``end``. Bytes that aren't UTF-8 count as U+FFFD."""
        try:
            parts = self.mark.split(text) if self.mark and b"<" in text else [text]
            found = [self.marks[p] if k % 2 else self._words(p) for k, p in enumerate(parts)]
        except UnicodeDecodeError:
            return self.ids(text.decode(errors="replace").encode(), end)
        return np.concatenate([*found, np.array([end], "<u4")])

    def _words(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if len(self.memo) > MEMO_WORDS:
            self.memo, self.old = {}, self.memo
        found = list(map(self.memo.get, words))
        if None in found:
            long: dict[bytes, bytes] = {}
            for k, w in enumerate(words):
                if found[k] is None:
                    found[k] = self.memo.get(w) or long.get(w) or self._learn(w, self.memo if len(w) <= MEMO_BYTES else long)
        return np.frombuffer(b"".join(found), "<u4")

    def _learn(self, word: bytes, memo: dict[bytes, bytes]) -> bytes:
        got = self.old.get(word)
        if got is None:
            core = word.rstrip(TAIL)
            got = self._letters(core) if core else None
            if got is None:
                got = self._whole(word)
            elif len(core) < len(word):
                tail = word[len(core) :]
                got += self.memo.get(tail) or self._learn(tail, self.memo if len(tail) <= MEMO_BYTES else memo)
        memo[word] = got
        return got

    def _letters(self, word: bytes) -> bytes | None:
        """The ids of a word of letters; None for other words."""
        text = word.decode()
        if not word.isascii():
            text = unicodedata.normalize("NFC", text)
            text = text.lower() if "\u03a3" not in text else "".join(map(str.lower, text))  # no final sigma
        if not text.isalpha():
            return None
        shown = text if word.isascii() else text.encode().decode("latin-1").translate(self.chars)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _whole(self, word: bytes) -> bytes:
        return array("I", self.encoder.encode(word.decode(), add_special_tokens=False).ids).tobytes()


class Piece(NamedTuple):
    """A run of a document's ids."""

    doc: object
    start: int
    ids: np.ndarray
    doc_tokens: int


class SumOfSquares:
    """Windows being filled, by fill level.

    ``level[h]`` counts the open windows that hold h ids. A piece goes to the level, or to a new window, that
    leaves the smallest sum of ``level[h] ** 2`` over the unfilled levels; at ties to the fullest window.
    """

    def __init__(self, capacity: int, max_open: int):
        self.capacity, self.max_open = capacity, max_open
        self.level = np.zeros(capacity + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = {}
        self.n_open = 0

    def place(self, piece: Piece) -> list[list[Piece]]:
        """Puts the piece (shorter than a window) somewhere; returns the windows that this fills."""
        size, n = len(piece.ids), self.level
        room = self.capacity - size
        grow = 2 * (n[size + 1 :] - n[1 : room + 1]) + 2  # for h = 1 .. room
        grow[-1] -= 1  # a full window is at no level
        grow[n[1 : room + 1] == 0] = np.iinfo(np.int64).max
        best = room - int(grow[::-1].argmin())
        if grow[best - 1] > 2 * n[size] + 1:
            best = 0
        window = self._take(best) if best else []
        window.append(piece)
        if best + size == self.capacity:
            return [window]
        self._put(best + size, window)
        return self.settle(keep=True) if self.n_open > self.max_open else []

    def _take(self, h: int) -> list[Piece]:
        self.level[h] -= 1
        self.n_open -= 1
        return self.open[h].pop()

    def _put(self, h: int, window: list[Piece]) -> None:
        self.level[h] += 1
        self.n_open += 1
        self.open.setdefault(h, []).append(window)

    def settle(self, keep: bool) -> list[list[Piece]]:
        """Fills the fullest open windows with the pieces of the emptiest, cut to fit.

        Of all open windows one is left unfilled at most; it stays open if ``keep``, else it is returned too.
        """
        windows = [w for h in sorted(self.open, reverse=True) for w in self.open[h]]
        self.level[:], self.open, self.n_open = 0, {}, 0
        done, last = [], len(windows) - 1
        for k, window in enumerate(windows):
            if k > last:
                break
            gap = self.capacity - sum(len(p.ids) for p in window)
            while gap and last > k:
                donor = windows[last]
                if not donor:
                    last -= 1
                    continue
                piece = donor.pop()
                window.append(piece._replace(ids=piece.ids[:gap]))
                if len(piece.ids) > gap:
                    donor.append(piece._replace(start=piece.start + gap, ids=piece.ids[gap:]))
                gap -= min(gap, len(piece.ids))
            if gap and keep and window:
                self._put(self.capacity - gap, window)
            elif window:
                done.append(window)
        return done


SCHEMA = "start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 4096, end: int = 2, max_open: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents, placed in sequences of at most ``capacity`` ids.

    A document is its token ids and then ``end``. Documents longer than a window are cut into full windows and a
    rest; rests are placed online, partition by partition and without a shuffle, by the sum-of-squares rule.
    When a partition ends, or has more than ``max_open`` open windows, the emptiest windows' pieces fill up the
    fullest, so that a partition leaves one window unfilled at most. One row a piece: its document, ``start`` and
    ``length`` there, ``doc_tokens``, ``sequence_id`` (partition and number), ``offset`` in the sequence and
    ``ids`` (little-endian unsigned 32-bit). A worker holds ``max_open`` windows at a time.

    Ids are those of ``encode(text, add_special_tokens=False)``; so a mark of the vocabulary, such as
    ``<|endoftext|>``, in a text is its one id. Null and empty texts are the end id alone; bytes that aren't UTF-8
    count as U+FFFD. Rows with null or repeated ids are documents like any other, an empty table has no pieces, and
    further columns are left out. ``tokenizer`` is the path of a tokenizer file on the executors, by default that of ``word_bpe_49k.json``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        tokens = WordTokens(tokenizer or public_tokenizers.path("word_bpe_49k.json"))
        packer, base, made = SumOfSquares(capacity, max_open), TaskContext.get().partitionId() << 33, 0
        rows: list[tuple] = []

        def close(windows: list[list[Piece]]) -> None:
            nonlocal made
            for window in windows:
                at = 0
                for p in window:
                    rows.append((p.doc, p.start, len(p.ids), p.doc_tokens, base + made, at, p.ids.tobytes()))
                    at += len(p.ids)
                made += 1

        def flush() -> pa.RecordBatch:
            cols = [pa.array(c, f.type) for c, f in zip(zip(*rows), fields)]
            rows.clear()
            return pa.RecordBatch.from_arrays(cols, schema=pa.schema(fields))

        fields: list[pa.Field] = []
        for batch in batches:
            fields = fields or [pa.field(id_col, batch.schema.field(0).type), *(pa.field(n, pa.int64()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")), pa.field("ids", pa.binary())]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                ids = tokens.ids(text.as_py() or b"", end)
                whole = len(ids) - len(ids) % capacity
                close([[Piece(doc, a, ids[a : a + capacity], len(ids))] for a in range(0, whole, capacity)])
                if whole < len(ids):
                    close(packer.place(Piece(doc, whole, ids[whole:], len(ids))))
                if len(rows) >= 1024:
                    yield flush()
        close(packer.settle(keep=False))
        if rows:
            yield flush()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {SCHEMA}")
