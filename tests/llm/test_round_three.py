"""Lines, resampling and spelling variants: against DuckDB, brute force and odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from oracle import assert_matches
from quernstone.llm import linededup, resampling, spelling

ODD = "doc_id long, text string, n_lines string, rank string, _row int"


@pytest.mark.parametrize("name", ["op11_resampling", "op12_spelling", "op13_lines"])
def test_oracles(spark, sf_dir, name):
    assert_matches(spark, name, sf_dir)


# Lines -----------------------------------------------------------------------------------------------------------


def test_lines_by_brute_force(spark):
    rng = random.Random(7)
    pool = ["", " ", "Menu", "menu\t", " MENU \r", "É", "é", "x" * 50, "a b", "a  b", "\x1c", " menu"]
    texts = [None, "", "\n", "\n\n\n"] + ["\n".join(rng.choice(pool + [f"own {rng.random()}"]) for _ in range(rng.randrange(9))) for _ in range(80)]
    rows = [(rng.choice([None, 1, 2, k]), t, "x", None, 5) for k, t in enumerate(texts)]
    rows += rows[10:16] + [(9, "Menu\n" * 3000 + "end", "x", None, 5)]
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    for least, chars in ((10, 1), (3, 2), (2, 0), (10**6, 1)):
        counts = Counter(k for r in rows for k in {key(line) for line in (r[1] or "").split("\n")})
        want = []
        for doc_id, text, *_ in rows:
            lines = (text or "").split("\n")
            kept = [x for x in lines if not (len(key(x)) >= chars and counts[key(x)] >= least)]
            want.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
        df = spark.createDataFrame(rows, ODD)
        for few in (0, 1 << 20):
            out = linededup.drop_frequent_lines(df, least, chars, broadcast_lines=few)
            assert out.columns == ["doc_id", "text", "rank", "_row", "n_lines", "n_dropped"]
            assert sorted(((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in out.collect()), key=repr) == sorted(want, key=repr)
    assert linededup.drop_frequent_lines(df.limit(0)).collect() == []


# Resampling ------------------------------------------------------------------------------------------------------


def features(text, n=2):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [zlib.crc32(" ".join(words[k : k + m]).encode()) for m in range(1, n + 1) for k in range(len(words) - m + 1)]


def brute_resample(rows, target, buckets, n=2):
    of_docs, of_target = Counter(), Counter()
    for out, texts in ((of_docs, [t for _, t in rows]), (of_target, target)):
        for t in texts:
            out.update(x % buckets for x in features(t, n)[1])
    many, some = float(of_docs.total() + buckets), float(of_target.total() + buckets)
    gain = lambda b: math.floor(1000 * math.log((of_target[b] + 1.0) * many / ((of_docs[b] + 1.0) * some)))
    found = []
    for doc_id, text in rows:
        words, got = features(text, n)
        weight = sum(gain(x % buckets) for x in got) // len(got) if got else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        found.append((doc_id, len(got), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= 20))
    order = sorted((r for r in found if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    drawn = order[: 25 * len(order) // 100]
    out = [(*r[:4], k + 1) for k, r in enumerate(drawn)]
    rest = Counter(found)
    rest.subtract(drawn)
    return out + [(*r[:4], None) for r in rest.elements()]


def test_resampling_by_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["a", "B", "été", "x1", "42", "Über", "naïve", "\U0001f600", "İ"] + [f"w{k}" for k in range(40)]
    texts = [None, "", "...", "one"] + [rng.choice([" ", ", ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    texts.append(" ".join(rng.choice(vocabulary) for _ in range(3000)))
    rows = [(rng.choice([None, k, k, k]), t) for k, t in enumerate(texts)]
    rows += [rows[-1], rows[-1], rows[20], (10**6, rows[-1][1])]
    target = [None, "a b w1 w2 été", "w3 w4 w1 w2 " * 9]
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], ODD)
    known = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id int, text string")
    for n, words, long_bytes in ((2, 1 << 15, 1 << 20), (2, 7, 100), (2, 1, 0), (3, 2, 50)):
        got = resampling.resample(df, known, n=n, buckets=97, words=words, long_bytes=long_bytes).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(brute_resample(rows, target, 97, n), key=repr)
    assert resampling.resample(df.limit(0), known).collect() == []
    assert len(resampling.resample(df, known.limit(0)).collect()) == len(rows)


def test_chunks_own_each_run_once():
    rng = random.Random(5)
    text = " ".join(rng.choice("abc") for _ in range(200)).encode()
    for n in (1, 2, 3):
        for words in (1, 2, 5, 199, 200, 1000):
            parts = list(resampling.chunks(text, words, n))
            assert sum(owned for owned, _ in parts) == 200
            got = np.concatenate([resampling.buckets_of(c, owned, n, 1 << 32) for owned, c in parts])
            assert Counter(got.tolist()) == Counter(features(text.decode(), n)[1])


# Spelling --------------------------------------------------------------------------------------------------------


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_variants(counts):
    out = {}
    for w, n in counts.items():
        others = [(-m, x) for x, m in counts.items() if near(w, x)]
        best = min(others, default=(0, None))
        form = best[1] if others and -best[0] >= 2 * n else None
        out[w] = [form, None, n, len(others), -best[0] if form else None]
    for w, x in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        x[1] = root
    return {(w, *x) for w, x in out.items()}


def test_variants_by_brute_force(spark):
    rng = random.Random(11)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(5, 9))) for _ in range(400)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "z" * 3000, "z" * 2999 + "y", "z" * 3001}
    counts = {w: rng.choice([3, 4, 6, 7, 15, 15, 40]) for w in sorted(words)}
    known = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    got = {r.word: r for r in spelling.near_words(known, most_keys=500, most_bytes=1000).collect()}
    want = brute_variants(counts)
    assert {(w, g.n_near) for w, g in got.items()} == {(x[0], x[4]) for x in want if x[4]}
    for w, g in got.items():
        assert (-g.best_n, g.best) == min((-m, x) for x, m in counts.items() if near(w, x))
    forms = [(x[0], x[1]) for x in want if x[1]]
    roots = {r.word: r.root for r in spelling._roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert roots == {x[0]: x[2] for x in want if x[1]}


def test_whole_query_by_brute_force(spark):
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdÀÿ×÷") for _ in range(rng.randrange(3, 8))) for _ in range(60)]
    texts = [None, "", "1 2"] + [rng.choice([" ", "-", "1"]).join(rng.choice([w, w.upper() if w.isascii() else w]) for w in rng.choices(words, k=rng.randrange(1, 60))) for _ in range(120)]
    rows = [(rng.choice([None, k, k, k]), t) for k, t in enumerate(texts)]
    rows += rows[5:9] + rows[5:7]
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], ODD)
    assert {tuple(r) for r in spelling.variants(df).collect()} == brute_variants(counts) and len(counts) > 30
    assert spelling.variants(df.limit(0)).collect() == []


def test_keys_are_those_of_the_strings_that_are_left():
    rng = random.Random(13)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    place, position, key, first = spelling.deletion_keys(words)
    left = [words[w] if p < 0 else words[w][:p] + words[w][p + 1 :] for w, p in zip(place, position)]
    of = defaultdict(set)
    for s, k in zip(left, key.tolist()):
        of[s].add(k)
    assert all(len(x) == 1 for x in of.values()) and len({k for x in of.values() for k in x}) == len(of)
    seen = Counter((w, s) for w, s, f, p in zip(place.tolist(), left, first, position) if f and p >= 0)
    assert set(seen.values()) == {1} and len(seen) == len({(w, s) for w, s, p in zip(place.tolist(), left, position) if p >= 0})
    colliding = [spelling.pa.table({"key": [1] * 4, "position": [0, 0, 0, -1], "first": [True] * 4, "word": ["xabcd", "yabcd", "zefgh", "efgh"], "n": [5, 6, 7, 8]})]
    out = {(r["word"], r["n_near"], r["best_n"], r["best"]) for r in spelling._neighbours(colliding[0]).to_pylist()}
    assert out == {("xabcd", 1, 6, "yabcd"), ("yabcd", 1, 5, "xabcd"), ("zefgh", 1, 8, "efgh"), ("efgh", 1, 7, "zefgh")}
