import random

import pytest

from quernstone.llm import simhash
from quernstone.llm.common import connected_components, table


def brute(rows, radius=3):
    """Components by comparing every pair."""
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, f) in enumerate(rows):
        for j, g in rows[:k]:
            if bin((f ^ g) & (1 << 64) - 1).count("1") <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i, _ in rows}


def plain(text, shingle=3):
    import re

    import xxhash

    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t\n", "a", "A b", "É a B\x0bc", "a b c", "a b c d e f a b c", "x " * 9000 + "y", " x y z w"])
def test_fingerprint(text):
    assert simhash.simhash(None if text is None else text.encode()) % (1 << 64) == plain(text)


def test_components_match_brute_force(spark, sf_dir):
    got = simhash.near_duplicates(table(spark, sf_dir, "documents")).collect()
    assert len(got) == 200
    want = brute([(r.doc_id, r.fingerprint) for r in got])
    assert {r.doc_id: r.component_id for r in got} == want


def test_links_of_planted_fingerprints(spark):
    rng = random.Random(5)
    fps = set()
    for _ in range(60):
        f = rng.getrandbits(64)
        fps.add(f)
        for bits in (1, 2, 3, 3, 4, 5):
            g = f
            for b in rng.sample(range(64), bits):
                g ^= 1 << b
            fps.add(g)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {tuple(sorted((r.src, r.dst))) for r in simhash.pigeonring_links(spark.createDataFrame([(f,) for f in signed], "fingerprint long")).collect()}
    want = {tuple(sorted((a, b))) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}
    assert got == want


def test_edge_rows(spark):
    rows = [(1, None, 0), (2, "", 1), (None, "one two three four", 2), (3, "one two three four", 3), (3, "one two three four", 3), (None, "alone", 4)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, 3), (1, 1), (2, 1), (3, 3), (3, 3)]
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_chain_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "src long, dst long")
    got = {r.node: r.label for r in connected_components(edges).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 101: 100}


def similar(rows, similarity=0.8, shingle=5):
    """Components over all pairs of texts whose sets of shingles reach the similarity."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in sets}


def edited_copies():
    """Texts, and copies of them with more and more words changed, on both sides of the similarity."""
    rng = random.Random(8)
    texts = []
    for _ in range(12):
        w = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(30, 200))] + "one line that very many of the texts have at the end".split() * 2
        texts.append(" ".join(w))
        for changes in (1, 1, 2, 3, 4, 6):
            v = list(w)
            for k in rng.sample(range(len(v)), changes):
                v[k] = f"new{rng.randrange(10**6)}"
            texts.append(" ".join(v))
    return list(enumerate(texts))


def test_near_copies_match_brute_force(spark, sf_dir):
    from pyspark.sql import functions as F

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    added = spark.createDataFrame([(10**6 + k, t) for k, t in edited_copies()], "doc_id long, text string")
    rows = docs.unionByName(added).withColumn("doc_id", F.col("doc_id").cast("long"))
    want = similar([(r.doc_id, r.text) for r in rows.collect()])
    assert {r.doc_id: r.component_id for r in simhash.near_copies(rows).collect()} == want


def test_near_copies_are_exact_with_all_keys(spark):
    """Long texts whose changes lie in one half, and neighbours in size: with all keys and no pruning none is lost."""
    rng = random.Random(21)
    texts = []
    for n in (40, 600):
        w = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        texts.append(w)
        for share in (0.02, 0.1, 0.17, 0.2, 0.23):
            k = int(n * share)
            texts += [w[k:], w[: n - k] + [f"x{rng.randrange(10**6)}" for _ in range(k // 2)], [f"y{rng.randrange(10**6)}" for _ in range(k // 4)] + w]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for similarity in (0.8, 1.0):
        got = {r.doc_id: r.component_id for r in simhash.near_copies(df, similarity=similarity, wide=256, probes=10**6).collect()}
        assert got == similar(rows, similarity)


def test_near_copies_edge_rows(spark):
    rows = [(1, None), (2, ""), (None, "one two three four"), (3, "one two three four"), (3, "one two three four"), (None, "alone")]
    got = simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, 3), (1, 1), (2, 1), (3, 3), (3, 3)]
    assert simhash.near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []
