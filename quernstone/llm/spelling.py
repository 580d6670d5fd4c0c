"""Spelling variants: words one edit apart meet by rolling-hash deletion keys (operator 12)."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import cut_lineage

#: Runs of ASCII letters (lowered before) and of U+00C0 to U+00FF, in UTF-8.
RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
#: Odd base of the polynomial hash modulo 2 ** 64 and its inverse; multipliers of the finaliser (of SplitMix).
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def words_of(doc_id: object, text: bytes | None, every: int = 97) -> Iterator[bytes]:
    """The runs of letters of a text, ASCII capitals lowered; about one in ``every`` loses a code point.

    Which runs and which code points follows from the CRC-32 of id, colon and run. A null id counts as empty.
    """
    start, crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), zlib.crc32
    for run in RUN.findall((text or b"").lower()):
        h = crc(run, start)
        if h % every == 0:
            letters = run.decode()
            at = h % len(letters)
            run = (letters[:at] + letters[at + 1 :]).encode()
        yield run


def vocabulary(docs: DataFrame, least_letters: int = 5, least_count: int = 3, every: int = 97, most_words: int = 1 << 18, most_bytes: int = 1 << 27, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n`` of the words of ``least_letters`` code points that occur ``least_count`` times in all texts.

    Each task counts what it reads and gives its counts on whenever it holds ``most_words`` words or has read
    ``most_bytes`` of text.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, read = Counter(), 0

        def given() -> Iterator[pa.RecordBatch]:
            rows = [(w, n) for w, n in counts.items() if len(w) - w.count(b"\xc3") >= least_letters]
            for k in range(0, len(rows), 8192):
                some = rows[k : k + 8192]
                yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w, _ in some]), pa.array([n for _, n in some], pa.int64())], names=["word", "n"])
            counts.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                counts.update(words_of(doc_id.as_py(), text, every))
                read += len(text or b"")
                if len(counts) >= most_words or read >= most_bytes:
                    yield from given()
                    read = 0
        yield from given()

    found = docs.select(id_col, F.col(text_col).cast("binary")).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(31))


def deletion_keys(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the words and of what is left of them without one code point: (word's place, position, key, first).

    A word's polynomial hash is the sum of its code points' values times powers of ``BASE``. Over all words in a
    row the terms are summed up once; a word without the code point at a position is the prefix before it and the
    suffix behind it, moved by one power, so each key takes a few operations whatever the word's length. Position
    -1 is the whole word. ``first``: the code point isn't that of the position before, so that of the positions
    which leave the same string just one is first.
    """
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths

    def powers(base: int) -> np.ndarray:
        out = np.full(len(points) + 1, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    up, down = powers(BASE), powers(INVERSE)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mixed(points.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64)))
    whole = (sums[starts + lengths] - sums[starts]) * down[starts]
    of = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(points))
    prefix, suffix = sums[at] - sums[starts[of]], sums[(starts + lengths)[of]] - sums[at + 1]
    without = (prefix + suffix * np.uint64(INVERSE)) * down[starts[of]]
    first = np.ones(len(points), bool)
    first[1:] = (points[1:] != points[:-1]) | (of[1:] != of[:-1])
    place = np.concatenate((np.arange(len(words)), of))
    position = np.concatenate((np.full(len(words), -1), at - starts[of])).astype(np.int32)
    return place, position, _mixed(np.concatenate((whole, without))).view(np.int64), np.concatenate((np.ones(len(words), bool), first))


def _keys(words: DataFrame, most_letters: int = 1 << 20) -> DataFrame:
    """``id`` (hash of the word), ``position``, ``first`` and ``key`` of each word's keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(1).to_pylist()
            cuts = np.flatnonzero(np.diff(np.cumsum([0, *map(len, found)]) // most_letters)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(found)]):
                if a < b:
                    place, position, key, first = deletion_keys(found[a:b])
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).take(pa.array(place)), pa.array(position), pa.array(first), pa.array(key)], names=["id", "position", "first", "key"])

    return words.select("id", "word").mapInArrow(run, "id long, position int, first boolean, key long")


def _parted(rows: DataFrame, load: int, most: int):
    """``rows`` grouped by the first bits of ``key``: groups of some ``most`` of ``load`` units, and more than tasks."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = min(40, max(-(-load // most), 4 * tasks).bit_length())
    return rows.withColumn("radix", F.shiftrightunsigned("key", 64 - bits)).groupBy("radix")


def _met(part: pa.Table) -> pa.Table:
    """The rows of a part whose key some other word has too, found by sorting the keys."""
    key, ids = part["key"].to_numpy(), part["id"].to_numpy()
    order = np.lexsort((ids, key))
    key, ids = key[order], ids[order]
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    ends = np.append(starts[1:], len(key))
    shared = np.repeat(ids[starts] != ids[ends - 1], ends - starts)
    return part.select(["id", "position", "first", "key"]).take(pa.array(order[shared]))


def _neighbours(part: pa.Table) -> pa.Table:
    """What the words of a part learn of each other: ``word``, ``n_near``, ``best_n`` and ``best``.

    Rows of one key are told apart by the strings themselves. Of those that leave one string, a word that is that
    string is near to all words that leave it; and words that leave it at one position are near to each other.
    Each pair of near words meets once, and is counted without being listed.
    """
    strings: dict[tuple[int, str], list[tuple[int, bool, str, int]]] = defaultdict(list)
    for key, position, first, word, n in zip(*(part[c].to_pylist() for c in ("key", "position", "first", "word", "n"))):
        strings[key, word if position < 0 else word[:position] + word[position + 1 :]].append((position, first, word, n))
    near: dict[str, list] = {}

    def told(word: str, count: int, best: tuple[int, str]) -> None:
        known = near.setdefault(word, [0, best])
        known[0] += count
        known[1] = min(known[1], best)

    for rows in strings.values():
        at: dict[int, list[tuple[int, str]]] = defaultdict(list)
        for position, _, word, n in rows:
            at[position].append((-n, word))
        longer = [(-n, word) for position, first, word, n in rows if position >= 0 and first]
        for whole in at.pop(-1, []):
            if longer:
                told(whole[1], len(longer), min(longer))
            for _, word in longer:
                told(word, 1, whole)
        for some in at.values():
            if len(some) > 1:
                best, second = sorted(some)[:2]
                for x in some:
                    told(x[1], len(some) - 1, second if x == best else best)
    names = ["word", "n_near", "best_n", "best"]
    return pa.table([pa.array(list(near), pa.string()), pa.array([c for c, _ in near.values()], pa.int64()), pa.array([-b[0] for _, b in near.values()], pa.int64()), pa.array([b[1] for _, b in near.values()], pa.string())], names=names)


def near_words(words: DataFrame, most_keys: int = 1 << 20, most_bytes: int = 1 << 26) -> DataFrame:
    """``word``, ``n_near``, ``best_n`` and ``best`` of the words that have a near one.

    ``words`` has distinct ``word`` and ``n``. Two words are near if they differ by one inserted, deleted or
    replaced code point; ``best`` is the near word of largest ``n``, at ties the smallest. Each word gives a key of
    itself and of what each deletion leaves; keys are parted by their first bits into parts of some ``most_keys``
    and sorted there, without the strings, and only rows whose key another word has too meet their strings again,
    by parts of some ``most_bytes``, where equal keys of different strings are told apart.
    """
    words = words.select("word", "n", F.xxhash64("word").alias("id"))
    keys = words.agg(F.coalesce(F.sum(F.char_length("word") + 1), F.lit(0))).first()[0]
    met = _parted(_keys(words), keys, most_keys).applyInArrow(lambda part: _met(part), "id long, position int, first boolean, key long")
    found = cut_lineage(met.join(words, "id"))
    size = found.agg(F.coalesce(F.sum(F.octet_length("word") + 64), F.lit(0))).first()[0]
    near = _parted(found, size, most_bytes).applyInArrow(lambda part: _neighbours(part), "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``: the last of the forms that follow from each word that has one.

    A form is at least twice as frequent as its word, so chains have some 60 words at most; each round doubles
    the steps that a word has made, and is checkpointed.
    """
    roots = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        far = roots.select(F.col("word").alias("via"), F.col("root").alias("far"))
        jumped = cut_lineage(roots.join(far, F.col("root") == F.col("via"), "left").select("word", F.coalesce("far", "root").alias("root"), F.col("via").isNotNull().alias("on")))
        roots = jumped.select("word", "root")
        if jumped.filter("on").isEmpty():
            return roots


def variants(docs: DataFrame, least_letters: int = 5, least_count: int = 3, factor: int = 2, every: int = 97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of the words of all texts.

    Words are runs of ASCII letters, lowered, and U+00C0 to U+00FF; about one run in ``every`` loses a code point,
    by ``words_of``. Those of ``least_letters`` code points or more that occur ``least_count`` times or more are
    kept, with their number ``n``. A word's ``form`` is its near word of largest ``n`` (at ties the first in
    order of code points), if that is ``factor`` times its own or more (from 2 on, so that forms never run in a
    circle), else null; ``root`` is where the forms lead, the word itself without one; ``n_near`` counts near words.

    Null and empty texts have no word. Each row counts, repeated ones as often as they come; further columns are
    ignored; an empty table gives none. Runs may be of any length: keys carry no strings.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more")
    words = cut_lineage(vocabulary(docs, least_letters, least_count, every, id_col=id_col, text_col=text_col))
    near = words.join(near_words(words), "word", "left")
    fits = F.col("best_n") >= factor * F.col("n")
    near = cut_lineage(near.select("word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best_n")).alias("form_n")))
    roots = _roots(near.filter("form is not null"))
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
