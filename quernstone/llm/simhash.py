"""Near-duplicate components: SimHash fingerprints by pigeonring filtering, and exact similarity (operator 3)."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import connected_components, cut_lineage

#: Seed of the shingle hash, and the names of a set's fingerprints.
SEED, PRINTS = 42, ("a", "b", "c", "d")
#: So many shingles are counted in a task before their counts are handed on, and ranges of hashes are as many as make
#: so many bytes of text for each.
COUNTED, RANGE = 1 << 21, 1 << 22


def shingle_hashes(text: bytes | None, shingle: int = 3) -> np.ndarray:
    """XXH64 values of the word shingles of a UTF-8 text, repeats included.

    ASCII capitals are lowered and words are split at ASCII white space. Fewer words than ``shingle``: the whole
    sequence is the one shingle. Null or no word: none.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - shingle + 1)
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: n - 1].tolist()]
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, SEED)], np.uint64)
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as a signed long; 0 for none."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 8192):
        part = np.ascontiguousarray(hashes[k : k + 8192])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def simhash(text: bytes | None, shingle: int = 3) -> int:
    """64-bit fingerprint of the word shingles of a UTF-8 text, as a signed long.

    Every shingle counts as often as it occurs. A bit is set if it is set in over half of the shingles' hashes.
    Null or no word: 0.
    """
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and the long ``fingerprint`` of every row's whole text; one row out for each row in."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.fromiter((simhash(t.as_py(), shingle) for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=[id_col, "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, fingerprint long")


def _segments(radius: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the radius + 1 segments of 64 bits, in ring order."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _ring_mask(ring: list[tuple[int, int]], start: int, length: int) -> int:
    """The bits of ``length`` segments from ``start`` on, as a signed long."""
    mask = sum(((1 << width) - 1) << low for low, width in (ring[(start + k) % len(ring)] for k in range(length)))
    return mask - (1 << 64) if mask >> 63 else mask


def pigeonring_links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs ``src``, ``dst`` of distinct fingerprints at ``radius`` or fewer differing bits.

    The bits form a ring of m = radius + 1 segments. If all segments together differ in at most ``radius`` bits,
    some start exists from which every chain of l segments differs in at most floor(l * radius / m) bits: 0 in
    the first segment, 1 in the first two. So the rows meet on (start, first segment, second segment) with at
    most one bit set more on the probing side, and the longer chains' budgets prune what meets before the full
    Hamming check; all of it is part of the join's condition, so only true links leave the join. A fingerprint
    has at most a constant number of links, however many rows there are.
    """
    ring = _segments(radius)
    m = len(ring)

    def segment(k: int) -> Column:
        low, width = ring[k % m]
        return F.shiftrightunsigned("fingerprint", low).bitwiseAND(F.lit((1 << width) - 1))

    def key(k: int, second: Column) -> Column:
        return F.xxhash64(F.lit(k), segment(k), second)

    def flips(k: int) -> Column:
        """The second segment, and it with each of its zero bits set."""
        masks = F.array(*(F.lit(x).cast("long") for x in [0, *(1 << b for b in range(ring[(k + 1) % m][1]))]))
        return F.transform(F.filter(masks, lambda x: segment(k + 1).bitwiseAND(x) == 0), lambda x: key(k, segment(k + 1).bitwiseOR(x)))

    fps = fps.select("fingerprint")
    index = fps.select(F.col("fingerprint").alias("dst"), F.posexplode(F.array(*(key(k, segment(k + 1)) for k in range(m)))).alias("start", "key"))
    probe = fps.select(F.col("fingerprint").alias("src"), F.posexplode(F.array(*(flips(k) for k in range(m)))).alias("start", "keys"))
    probe = probe.select("src", F.col("start").alias("from"), F.explode("keys").alias("key"))
    diff = F.col("src").bitwiseXOR(F.col("dst"))
    chains = F.lit(True)
    for length in range(1, m):
        mask = F.element_at(F.array(*(F.lit(_ring_mask(ring, k, length)).cast("long") for k in range(m))), F.col("start") + 1)
        chains &= F.bit_count(diff.bitwiseAND(mask)) <= length * radius // m
    close = chains & (F.bit_count(diff) <= radius) & (diff != 0)
    return probe.join(index, (probe["key"] == index["key"]) & (F.col("from") == F.col("start")) & close).select("src", "dst")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint`` (long) and ``component_id`` of every row.

    ``component_id`` is the smallest id that can be reached over links of ``radius`` or fewer differing bits;
    equal fingerprints are one node of the graph, so groups of copies cost one row. Null and empty texts have
    fingerprint 0 and are linked like any other. Rows with a null id take the component of their fingerprint's
    other rows and join nothing themselves (null if there is none). Repeated rows come out as often as they
    come in; further columns are ignored; an empty table gives no rows.
    """
    fps = cut_lineage(fingerprints(docs, shingle, id_col, text_col))
    nodes = cut_lineage(fps.filter(F.col(id_col).isNotNull()).groupBy("fingerprint").agg(F.min(id_col).alias("first_id")))
    return _labelled(fps, nodes, pigeonring_links(nodes, radius), id_col)


def _labelled(fps: DataFrame, nodes: DataFrame, links: DataFrame, id_col: str) -> DataFrame:
    """``id_col``, ``fingerprint`` and ``component_id`` of ``fps``, from links of the nodes' fingerprints."""
    labels = connected_components(links)
    named = nodes.select("fingerprint", "first_id").join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = cut_lineage(named.select("fingerprint", "first_id", F.coalesce("label", "fingerprint").alias("label")))
    # Written first: a join of two exchanges can be split where one label has very many rows.
    first = cut_lineage(named.groupBy("label").agg(F.min("first_id").alias("component_id")))
    component = cut_lineage(named.join(first, "label").select("fingerprint", "component_id"))
    return fps.join(component, "fingerprint", "left").select(id_col, "fingerprint", "component_id")


def _mapped(docs: DataFrame, of: Callable[[bytes | None], tuple], schema: str, id_col: str, text_col: str) -> DataFrame:
    """``id_col`` and what ``of`` makes of each text: longs, and an array of longs as the last column."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                *longs, lists = zip(*(of(t.as_py()) for t in some.column(1).cast(pa.binary())))
                ends = np.cumsum([0, *map(len, lists)], dtype=np.int32)
                arrays = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists).view(np.int64)))
                yield pa.RecordBatch.from_arrays([some.column(0), *(pa.array(x, pa.int64()) for x in longs), arrays], names=[id_col, *names])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {schema}")


def _set_of(text: bytes | None, shingle: int) -> tuple[int, np.ndarray]:
    """The sorted hashes of a text's different shingles, and a name for them: one set, one name."""
    found = np.unique(shingle_hashes(text, shingle))
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED) if len(found) else 0).view(np.int64)), found


def prints(found: np.ndarray, n: int) -> list[int]:
    """SimHashes of a set of hashes, and of hashes of them."""
    out = []
    for _ in range(n):
        out.append(majority(found))
        found = (found ^ (found >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        found = found ^ (found >> np.uint64(32))
    return out


def second_keys(found: np.ndarray, common: np.ndarray, similarity: float, probes: int) -> tuple[int, np.ndarray]:
    """The shingles by which a set of ``found`` meets all sets that may be similar enough, and how many were rare.

    All shingles have one order: those that aren't in ``common`` by hash, then those of ``common`` from its end.
    Two sets of at least ``similarity`` have a shingle in common among their first n - ceil(similarity * n) + 1 of
    n. Of these the first ``probes`` of either kind are taken. So sets of up to some probes / (1 - similarity)
    shingles, 160 as it is, meet for certain. Larger ones meet with high probability: by hash their rare shingles
    are a random choice, so if a share s of them is in both, none of them meets with a probability below
    (1 - s) ** probes. With ``probes`` as large as the largest set all meet for certain.
    """
    n = len(found)
    rank = np.zeros(n, np.int64)
    if len(common) and n:
        order = np.argsort(common)
        at = np.minimum(np.searchsorted(common, found, sorter=order), len(common) - 1)
        hit = common[order[at]] == found
        rank[hit] = len(common) - order[at[hit]]
    first = np.lexsort((found, rank))[: n - math.ceil(similarity * n - 1e-9) + 1] if n else np.zeros(0, np.int64)
    rare = int((rank[first] == 0).sum())
    return rare, found[np.concatenate((first[:rare][:probes], first[rare:][:probes]))]


def packed(found: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Sorted different hashes and their counts, by ranges of equal first ``bits``: range, bytes of a gap, gaps, counts.

    Of each hash only the gap to the one before it, or to the range's start, is kept, in as many bytes as the range's
    widest gap needs: 6 instead of 8 where two million hashes are packed together.
    """
    shift = np.uint64(64 - bits)
    parts, starts = np.unique(found >> shift, return_index=True)
    for part, a, b in zip(parts, starts, [*starts[1:], len(found)]):
        gaps = np.diff(found[a:b], prepend=part << shift)
        wide = max(1, (int(gaps.max()).bit_length() + 7) // 8)
        yield int(part), wide, gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide].tobytes(), counts[a:b].astype("<u4").tobytes()


def unpacked(part: int, wide: int, gaps: bytes, counts: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of one row of ``packed``."""
    whole = np.zeros((len(gaps) // wide, 8), np.uint8)
    whole[:, :wide] = np.frombuffer(gaps, np.uint8).reshape(-1, wide)
    found = np.cumsum(whole.view("<u8").ravel(), dtype=np.uint64) + (np.uint64(part) << np.uint64(64 - bits))
    return found, np.frombuffer(counts, "<u4").astype(np.int64)


def _common_shingles(docs: DataFrame, shingle: int, id_col: str, text_col: str, broadcast_ids: int = 1 << 20, most: int = 100_000) -> np.ndarray:
    """The ``most`` shingles that are in most texts, in three at least, most frequent first. They order, and decide nothing.

    Each text of the table is counted, copies of one text once, and rows without an id not at all. A task's counts are
    moved packed, by ranges of the hashes; there are more ranges in larger tables, so what is held of one is bounded.
    """
    docs = docs.filter(F.col(id_col).isNotNull())
    named = docs.select(F.xxhash64(text_col).alias("of"), F.col(id_col).alias("id"))
    first = cut_lineage(named.groupBy("of").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    copies = cut_lineage(named.join(first, "of").filter("id <> first").select(F.col("id").alias(id_col)).distinct())
    few = copies.count() <= broadcast_ids
    once = docs.select(id_col, text_col).join(F.broadcast(copies) if few else copies, id_col, "left_anti")
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    bits = max(8, (size // RANGE).bit_length())

    def handed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = packed(*np.unique(np.concatenate(held), return_counts=True), bits)
        while some := list(itertools.islice(rows, 64)):
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*some), kinds)], names=["part", "wide", "gaps", "counts"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for t in batch.column(0).cast(pa.binary()):
                held.append(_set_of(t.as_py(), shingle)[1])
                size += len(held[-1])
                if size >= COUNTED:
                    yield from handed(held)
                    held, size = [], 0
        if held:
            yield from handed(held)

    def summed(rows: pa.Table) -> pa.Table:
        found, n = (np.concatenate(x) for x in zip(*(unpacked(*(v.as_py() for v in row), bits) for row in zip(*(rows[c] for c in ("part", "wide", "gaps", "counts"))))))
        order = np.argsort(found)
        found, n = found[order], n[order]
        at = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        n = np.add.reduceat(n, at)
        return pa.table({"s": found[at[n > 2]].view(np.int64), "n": n[n > 2]})

    ranges = once.select(text_col).mapInArrow(run, "part int, wide int, gaps binary, counts binary")
    counts = cut_lineage(ranges.groupBy("part").applyInArrow(summed, "s long, n long"))
    # Rows below the least count that can be wanted don't go to the driver.
    least, above = 0, 0
    for r in sorted(counts.groupBy("n").agg(F.count("*").alias("rows")).collect(), reverse=True):
        least, above = r.n, above + r.rows
        if above >= most:
            break
    rows = counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "s").limit(most).select("s").collect()
    return np.array([r.s for r in rows], np.int64).view(np.uint64)


def near_copies(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, radius: int = 3, wide: int = 60, probes: int = 32, broadcast_ids: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint`` (of the set of shingles) and ``component_id``, over links of similar texts.

    Two texts are linked if the shingles in both are at least ``similarity`` of those in either, each counted once;
    every link is counted exactly. Texts are proposed in two ways. One is SimHash: fingerprints at ``radius`` or
    fewer differing bits, by ``pigeonring_links``. Pairs that just reach 0.8 differ in 10 of 64 bits on average, a
    radius at which no segment prunes, so the other is a second key, ``second_keys``. Pairs that meet by a second
    key are counted only if four fingerprints of 64 bits differ in ``wide`` bits at most, some four standard
    deviations more than pairs of 0.8 do (and in more for very small sets), and if their sizes, and what follows the
    key in the order, allow the similarity. As they are, ``probes`` and ``wide`` lose a similar pair with a very
    small probability; ``wide`` of 256 and ``probes`` as large as the largest set lose none, at the cost of more
    keys and pairs.
    Copies of one text have the shingles that were changed in them before those that many copies have, so of a
    large group only those meet that have few changes.

    First each text is counted against one text of each way, which joins most of a large group: of the second, the
    nearest of those that have a key earliest in the order, which are the least changed. Then the texts are that
    meet and are not yet in one component; in a key they meet by size too, since sizes of similar texts are within
    the similarity of each other. Ids, nulls and repeated rows are treated as by ``near_duplicates``; null and empty
    texts are equal to each other, further columns are ignored, and an empty table gives none.
    """
    if not 0 < similarity <= 1:
        raise ValueError("similarity must be above 0 and at most 1")
    common = _common_shingles(docs, shingle, id_col, text_col, broadcast_ids)

    def described(text: bytes | None) -> tuple:
        name, found = _set_of(text, shingle)
        return name, len(found), *prints(found, len(PRINTS)), *second_keys(found, common, similarity, probes)

    columns = ", ".join(f"{c} long" for c in ("fingerprint", "size", *PRINTS, "rare"))
    rows = cut_lineage(_mapped(docs, described, f"{columns}, keys array<long>", id_col, text_col))
    firsts = (F.first(c).alias(c) for c in ("size", *PRINTS, "rare", "keys"))
    nodes = cut_lineage(rows.filter(F.col(id_col).isNotNull()).groupBy("fingerprint").agg(F.min(id_col).alias("first_id"), *firsts))

    def apart(x: str, y: str) -> Column:
        return sum(F.bit_count(F.col(f"{x}.{c}").bitwiseXOR(F.col(f"{y}.{c}"))) for c in PRINTS)

    def close(x: str, y: str) -> Column:
        rest = F.least(F.col(f"{x}.size") - F.col(f"{x}.place"), F.col(f"{y}.size") - F.col(f"{y}.place"))
        possible = rest * (1 + similarity) >= (F.col(f"{x}.size") + F.col(f"{y}.size")) * similarity - 1e-6
        return (F.col(f"{x}.fingerprint") != F.col(f"{y}.fingerprint")) & possible & (apart(x, y) <= wide + F.floor(120 / F.greatest(F.least(f"{x}.size", f"{y}.size"), F.lit(1))))

    def counted(pairs: DataFrame) -> DataFrame:
        pairs = cut_lineage(pairs.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct())
        wanted = pairs.select(F.explode(F.array("src", "dst")).alias("fingerprint")).distinct()
        ids = cut_lineage(nodes.join(wanted, "fingerprint", "left_semi").select(F.col("first_id").alias(id_col)).distinct())
        few = ids.count() <= broadcast_ids
        texts = docs.select(id_col, text_col).join(F.broadcast(ids) if few else ids, id_col, "left_semi")
        sets = _mapped(texts, lambda t: _set_of(t, shingle), "fingerprint long, shingles array<long>", id_col, text_col)
        sets = sets.groupBy("fingerprint").agg(F.first("shingles").alias("shingles"))
        both = pairs.join(sets.toDF("src", "a"), "src").join(sets.toDF("dst", "b"), "dst")
        shared = F.size(F.array_intersect("a", "b"))
        return cut_lineage(both.filter(shared >= (F.size("a") + F.size("b") - shared) * similarity - 1e-9).select("src", "dst"))

    named = nodes.groupBy("a").agg(F.min("fingerprint").alias("named"))
    same = nodes.join(named, "a").select(F.col("named").alias("src"), F.col("fingerprint").alias("dst")).filter("src <> dst")
    ring = pigeonring_links(named.select(F.col("a").alias("fingerprint")), radius)
    ring = ring.join(named.toDF("src", "x"), "src").join(named.toDF("dst", "y"), "dst").select(F.col("x").alias("src"), F.col("y").alias("dst"))

    # Moved once: both the heads and the rows that meet them are of this exchange.
    place = F.when(F.col("at") < probes, F.col("at")).otherwise(F.col("at") + F.greatest(F.col("rare") - probes, F.lit(0))).cast("long")
    text = F.struct(place.alias("place"), "fingerprint", "size", *PRINTS)
    keyed = nodes.select(F.posexplode("keys").alias("at", "key"), "fingerprint", "size", *PRINTS, "rare").select("key", text.alias("x")).repartition("key")
    heads = keyed.groupBy("key").agg(F.min("x").alias("head"), F.count("*").alias("n")).filter("n > 1").drop("n")
    met = cut_lineage(keyed.join(heads, "key"))
    nearest = F.min_by("head.fingerprint", F.struct(apart("x", "head"), "head.fingerprint"))
    star = met.filter(close("x", "head")).groupBy(F.col("x.fingerprint").alias("dst")).agg(nearest.alias("src"))
    links = counted(same.unionByName(ring).unionByName(star))

    labels = connected_components(links).select(F.col("node").alias("of"), "label")
    named = met.drop("head").join(labels, F.col("x.fingerprint") == F.col("of"), "left").select("key", "x", F.coalesce("label", "x.fingerprint").alias("label"))
    mixed = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("key")
    # Sizes of similar texts are in one band of sizes or in neighbouring ones.
    band = F.floor(F.log(F.greatest(F.col("x.size"), F.lit(1))) / -math.log(similarity) + 1e-9) if similarity < 1 else F.col("x.size")
    named = cut_lineage(named.join(mixed, "key", "left_semi").withColumn("band", band.cast("long")))
    other = named.select(F.col("key").alias("of"), F.col("x").alias("y"), F.col("label").alias("label_y"), F.col("band").alias("band_y"))
    near = named.withColumn("at", F.explode(F.array(F.col("band"), F.col("band") + 1)))
    once = (F.col("band") < F.col("band_y")) | (F.col("x.fingerprint") < F.col("y.fingerprint"))
    rest = near.join(other, (F.col("key") == F.col("of")) & (F.col("at") == F.col("band_y")) & once & (F.col("label") != F.col("label_y")) & close("x", "y"))
    links = links.unionByName(counted(rest.select(F.col("x.fingerprint").alias("src"), F.col("y.fingerprint").alias("dst"))))
    return _labelled(rows, nodes, links, id_col)
