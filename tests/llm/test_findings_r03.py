"""What the review of round 3 found in the operators, each at small size."""

import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from quernstone.llm import simhash


def test_common_shingles_are_counted_over_all_texts(spark):
    """of more texts than were sampled before, those that share a shingle with few others count too."""
    texts = [f"a{k // 4} b{k // 4} c{k // 4}" + (f" d{k}" if k % 4 else "") for k in range(20_000)] + ["a0 b0 c0"] * 5 + [None, ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    want = Counter(int(h) for t in set(texts) for h in np.unique(simhash.shingle_hashes(t.encode() if t else None, 3)))
    want = {h: n for h, n in want.items() if n > 2}
    got = simhash._common_shingles(df, 3, "doc_id", "text")
    assert len(want) == 5000 and sorted(got.tolist()) == sorted(want)


@pytest.mark.parametrize("bits", [8, 13])
@pytest.mark.parametrize("found", [[0], [2**64 - 1], [0, 1, 2**56 - 1, 2**56, 2**63, 2**64 - 1], list(range(5, 3000))])
def test_packed_hashes_come_back(found, bits):
    """Finding 1, pipeline: what the counts are moved as; gaps of none to eight bytes, and ranges' borders."""
    found = np.array(found, np.uint64)
    counts = np.arange(1, len(found) + 1) * 1000
    back = [simhash.unpacked(*row, bits) for row in simhash.packed(found, counts, bits)]
    assert np.concatenate([s for s, _ in back]).tolist() == found.tolist()
    assert np.concatenate([n for _, n in back]).tolist() == counts.tolist()


def test_common_shingles_move_few_bytes(spark):
    """Finding 1, pipeline: the counts of shingles that one text has, which are nearly all, were 11 bytes each on disk."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(250)) for _ in range(2000)]
    df = spark.createDataFrame([(k, t + (" a line of some texts" if k % 2 else "")) for k, t in enumerate(texts)], "doc_id long, text string")

    def files():
        folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {p: p.stat().st_size for d in folders for p in Path(d.getPath()).rglob("shuffle_*.data")}

    before = files()
    got = simhash._common_shingles(df, 3, "doc_id", "text")
    moved = sum(n for p, n in files().items() if p not in before)
    assert set(got.tolist()) == set(simhash.shingle_hashes(b"a line of some texts", 3).tolist())
    assert 0 < moved < 8.5 * 2000 * 250


def test_most_common_shingles_are_cut_by_count_and_hash(spark):
    """Finding 1, pipeline: of shingles with the last count that is taken, the smallest as signed numbers."""
    texts = [f"all of it x{k % 7} y{k % 40} z{k % 40} {k}" for k in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    n = Counter(h for t in texts for h in np.unique(simhash.shingle_hashes(t.encode(), 2)).view(np.int64).tolist())
    want = sorted((h for h in n if n[h] > 2), key=lambda h: (-n[h], h))
    for most in (1, 5, 30, len(want), 10**5):
        assert simhash._common_shingles(df, 2, "doc_id", "text", most=most).view(np.int64).tolist() == want[:most]
