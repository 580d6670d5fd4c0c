import re
from collections import Counter

import numpy as np
import pytest

from oracle import assert_matches
from quernstone.llm import decontam, queries
from quernstone.llm.common import table


def words_of(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def shingles(w, n=5):
    return [tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []


def brute(docs, items, similarity=0.8):
    """Every window of every document against every item, by the shingles themselves."""
    found = {}
    for d, text in docs:
        w = words_of(text)
        for i, item in items:
            v = words_of(item)
            if not v or len(v) > len(w) or (len(v) < 5 <= len(w)):
                continue
            target = Counter(shingles(v))
            for a in range(len(w) - len(v) + 1):
                if len(w) < 5 and len(v) != len(w):
                    continue
                have = Counter(shingles(w[a : a + len(v)]))
                s = (have & target).total() / (have | target).total()
                if s >= similarity and s > found.get((d, i), (0,))[0]:
                    found[d, i] = (s, a, len(v))
    return found


def test_matches_brute_force_on_the_tables(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").filter("n_chars < 1500")
    bench = table(spark, sf_dir, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    for max_items in (20_000, 7):
        got = {(r.doc_id, r.item_id): (r.similarity, r.first_word, r.words) for r in decontam.contaminations(docs, bench, max_items=max_items).collect()}
        assert got == want and want


def test_whole_query(spark, sf_dir):
    docs = {r.doc_id: f" {' '.join(words_of(r.text))} " for r in table(spark, sf_dir, "documents").collect()}
    bench = {r.item_id: f" {' '.join(words_of(r.text))} " for r in table(spark, sf_dir, "benchmark").collect()}
    got = {(r.doc_id, r.item_id) for r in queries.op8_decontamination(spark, sf_dir).collect()}
    assert {(d, i) for d, t in docs.items() for i, b in bench.items() if b in t} <= got


def test_oracle(spark, sf_dir):
    assert_matches(spark, "op8_decontamination", sf_dir)


def test_edited_passages_and_edges(spark):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([40, 55, 30, 12, 5, 3])]
    items += [(6, None), (7, ""), (None, "some words of an item without an id"), (8, "same same same same same same same other")]
    texts = [items[0][1].upper().replace(" ", ", "), " ".join(word() for _ in range(300)) + "\n" + items[1][1] + " " + word()]
    w = items[1][1].split()
    w[2] = "changed"
    texts.append(" ".join([*(word() for _ in range(20)), *w]))
    w = items[0][1].split()
    texts.append(" ".join(w[:20] + ["x", "y", "z"] + w[20:]))
    texts += [" ".join(w[:33]), " ".join(w[:38]), items[3][1], items[4][1], items[5][1], items[5][1] + " and four more words", None, "", "!!", items[8 + 1][1] + " same same", "long " * 50_000 + items[2][1]]
    docs = list(enumerate(texts)) + [(None, items[0][1]), (0, texts[0])]
    df = spark.createDataFrame([(d, t, 0.1, 5) for d, t in docs], "doc_id long, text string, similarity double, item_id int")
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    rows = decontam.contaminations(df, bench).collect()
    want = brute([x for x in docs if x[1] != texts[-1]], [x for x in items if x[0] is not None])
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word, r.words) for r in rows}
    assert got.pop((len(texts) - 1, 2)) == (1.0, 50_000, 30)
    assert got == want and sum((r.doc_id, r.item_id) == (0, 0) for r in rows) == 2
    for max_items in (20_000, 3):
        left = decontam.uncontaminated(df, bench, max_items=max_items)
        assert left.columns == df.columns and sorted((r.doc_id for r in left.collect())) == sorted(d for d in range(len(texts)) if d not in {r.doc_id for r in rows})
    assert decontam.contaminations(df.limit(0), bench).collect() == [] == decontam.contaminations(df, bench.limit(0)).collect()


@pytest.mark.parametrize("radius", [7, 15, 23])
def test_blocks_find_all_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    items = decontam.Items([(k, " ".join(map(str, rng.integers(0, 99, 20))).encode()) for k in range(50)], 5, radius)
    prints = rng.integers(0, 256, (4000, 8)).astype(np.uint8)
    prints[:2000] = items.prints[rng.integers(0, 50, 2000)]
    for p in prints[:2000]:
        for b in rng.choice(64, rng.integers(0, radius + 1), replace=False):
            p[b // 8] ^= 1 << (b % 8)
    met = np.any([items.blocks[20][b][prints[:, b]] for b in range(8)], axis=0)
    close = np.bitwise_count(prints[:, None] ^ items.prints[None]).sum(axis=2) <= radius
    assert (close <= met).all() and close[:2000].any(axis=1).all()


def test_windows_that_just_reach_the_similarity_are_candidates():
    rng = np.random.default_rng(6)
    tried = 0
    for _ in range(600):
        w = rng.integers(0, 5000, int(rng.integers(40, 120)))
        edited = w.copy()
        edited[rng.integers(0, len(w), int(rng.integers(1, 3)))] = -1
        item, text = (" ".join(f"w{x}" for x in v) for v in (w, edited))
        if want := brute([(0, text)], [(0, item)]):
            tried += want[0, 0][0] < 0.86
            assert decontam.Items([(0, item.encode())], 5, 23).matches(text.encode(), 0.8)
    assert tried > 20


def test_clashing_names_broken_text_and_parts_by_bytes(spark):
    docs = spark.sql("select 1L doc_id, 'a b c d e f g' text, 5 _matches, 6 __matches union all select 2L, 'x y z', 1, 2 union all select 3L, cast(x'61ff62' as string), 1, 2")
    bench = spark.createDataFrame([(k, f"{k} " * 9) for k in range(6)] + [(9, "a b c d e f g")], "item_id long, text string")
    for max_bytes in (1 << 25, 30):
        left = decontam.uncontaminated(docs, bench, max_bytes=max_bytes)
        assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3]
        assert [(r.doc_id, r.item_id) for r in decontam.contaminations(docs, bench, max_bytes=max_bytes).collect()] == [(1, 9)]


def test_items_longer_than_the_document_and_shorter_than_a_shingle(spark):
    rng = np.random.default_rng(9)
    w = [f"w{x}" for x in rng.permutation(500)]
    items = [(1, " ".join(w[:40])), (2, " ".join(w[100:103])), (3, " ".join(w[200:230])), (4, w[300]), (5, " ".join(w[400:406])), (6, " ".join(w[410:414]))]
    texts = [w[:38], w[1:36], w[:33], w[:32], w[2:40] + ["x"], w[50:90] + w[100:103] + w[91:95], w[100:102] + w[300:310], w[100:103], w[200:202], w[205:230] + w[300:301], [], w[99:103], w[300:304], w[100:104], [w[300]], w[400:404], w[400:405], w[410:413], w[409:414]]
    docs = [(k, " ".join(t)) for k, t in enumerate(texts)]
    want = {}
    for d, text in docs:
        for i, item in items:
            v, t = words_of(item), words_of(text)
            n = min(len(v), len(t))
            width = min(5, len(v))
            target = Counter(shingles(v, width))
            for a in range(len(t) - n + 1 if n else 0):
                have = Counter(shingles(t[a : a + n], width))
                s = (have & target).total() / (have | target).total()
                if s >= 0.8 and s > want.get((d, i), (0,))[0]:
                    want[d, i] = (s, a, n)
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id): (r.similarity, r.first_word, r.words) for r in decontam.contaminations(df, bench, uneven=True).collect()} == want
    assert {(0, 1), (5, 2), (6, 4), (11, 2), (12, 4), (13, 2), (14, 4), (18, 6)} <= want.keys()
    left = {r.doc_id for r in decontam.uncontaminated(df, bench, uneven=True).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in want}
