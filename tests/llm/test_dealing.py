import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from oracle import assert_matches
from quernstone.llm import packing, queries, sharding, topk
from quernstone.llm.common import table


def test_topk_oracle(spark, sf_dir):
    assert_matches(spark, "op2_topk", sf_dir)


@pytest.mark.parametrize("scale", [3, 1 << 22])
def test_topk_blocks_and_ties(spark, scale):
    rng = random.Random(1)
    rows = [(i, [float(rng.randint(-2, 2) * scale) / 256 for _ in range(5)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 5), (303, [float("inf")] * 5), (None, [1.0] * 5), (7, rows[7][1]), (304, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = topk.top_k(df, df["vec_id"] % 10 == 0, 4, query_block=9, vector_block=37).collect()
    codes = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in codes:
        if q % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(codes[q], codes[c])), c) for c in codes if c != q)[:4]
            want |= {(q, r, c, -s) for r, (s, c) in enumerate(best, 1)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk.top_k(df.limit(0), df["vec_id"] % 10 == 0).collect() == []
    assert topk.top_k(df.filter("vec_id = 0"), df["vec_id"] % 10 == 0).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    f = sharding.Feistel(n, 5)
    p = f.forward(np.arange(n))
    assert sorted(p) == list(range(n)) and np.array_equal(f.backward(p), np.arange(n))
    shard, slot = sharding.locate(n // 2, n, 8)
    assert sharding.row_at(shard, slot, n, 8) == n // 2


def test_sharding_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    rows = queries.op6_sharding(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.size == len(docs[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode()) for r in rows)
    sizes = Counter(r.shard for r in rows)
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_sharding_copies_nulls_and_order(spark):
    rows = [(1, "a")] * 500 + [(None, None)] * 3 + [(k, "b") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 as slot")
    numbers = [r.row_number for r in sharding.numbered(df.drop("slot"), per_bucket=64, chunk=7).collect()]
    assert sorted(numbers) == list(range(703))
    one = sorted(map(tuple, sharding.feistel_shards(df).collect()), key=repr)
    other = sorted(map(tuple, sharding.feistel_shards(df.orderBy("text", "doc_id").repartition(3)).collect()), key=repr)
    assert one == other and len(one) == 703
    assert sharding.feistel_shards(df.limit(0)).collect() == []
    clashing = df.selectExpr("doc_id as copies", "text as _copies", "doc_id as row", "doc_id as place")
    assert sharding.feistel_shards(clashing).columns == [*clashing.columns, "row_number", "shard", "slot"]
    assert sharding.feistel_shards(clashing).count() == 703


def tokens(texts):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [np.array([*e.ids, 2], "<u4") for e in t.encode_batch(texts, add_special_tokens=False)]


def check_pieces(rows, texts, capacity=4096):
    """Every id lies in one piece, and sequences have no gap."""
    ids = dict(zip(texts, tokens([t or "" for t in texts.values()])))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == ids.keys()
    for runs, total in [(v, len(ids[d])) for d, v in by_doc.items()] + [(v, None) for v in by_sequence.values()]:
        at = 0
        for start, length in sorted(runs):
            assert start == at and length > 0
            at += length
        assert at == total if total else at <= capacity
    return len(by_sequence), sum(map(len, ids.values()))


def test_packing_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    n, total = check_pieces(queries.op7_packing(spark, sf_dir).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert n <= -(-total // 4096) + docs.rdd.getNumPartitions()


def test_ids_of_texts_with_marks():
    from random import Random

    rng, words = Random(3), packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    bits = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "<", "endoftext", "It's", "don't", " ", "\n", "\u03a3", "\u00c9", "e\u0301", "12", "..", "<|endoftext", "\u0130x"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(12))) for _ in range(3000)]
    assert [list(words.ids(t.encode(), 2)) for t in texts] == [list(x) for x in tokens(texts)]
    broken = b"fine \xff\xfe words \xc3"
    assert list(words.ids(broken, 2)) == list(tokens([broken.decode(errors="replace")])[0])


def test_packing_edges(spark):
    from pyspark.sql import functions as F

    texts = {1: None, 2: "", 3: "word " * 20_000, 4: "x" * 30_000, 5: "<|endoftext|> It's a b\x1cc I'LL é É", 6: " \t\n ", 7: "Ünï 12 ..!! don't"}
    texts |= {k: "some words here " * (k % 50) for k in range(10, 200)}
    df = spark.createDataFrame([(k, t, 0) for k, t in texts.items()], "doc_id long, text string, start int")
    rows = packing.pack(df, capacity=64, max_open=5).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(rows, texts, 64)
    assert packing.pack(df.limit(0)).collect() == []


def test_tokens_do_not_depend_on_memory(spark, sf_dir):
    texts = [r.text for r in table(spark, sf_dir, "documents").collect()]
    texts += ["Ünïcode, ÉCOLE; straße!? İstanbul ΣΑΣ ﬁne क़ e\u0301cole cafe\u0301. \u0301x a\u0300, x\u00a0y z\u2003w \x1c\x85 v", "don't I'LL it's, 'tis ''s s' 12th 3.14, 2nd. a1b2 (foo), foo), ...", "日本語 テスト。 ½ Ⅷ ª ʰa 𝒳 😀!! a😀", ",", "?! .", "<|endoftext|>. <|startoftext|>x"]
    w = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    assert all(np.array_equal(w.ids(t.encode(), 2), want) for t, want in zip(texts, tokens(texts)))


def test_sum_of_squares_choice():
    p = packing.SumOfSquares(10, 100)
    put = lambda size: p.place(packing.Piece(0, 0, np.zeros(size, "<u4"), size))
    assert put(6) == [] and list(np.flatnonzero(p.level)) == [6]
    assert len(put(4)) == 1 and p.n_open == 0
    for size in (3, 3):  # 3 and 3 would square to 4; 6 alone to 1
        put(size)
    assert list(np.flatnonzero(p.level)) == [6] and p.level[6] == 1


@pytest.mark.parametrize("share", [0.05, 0.4, 0.7, 1.0])
def test_topk_scatter_of_sparse_and_dense_rows(share):
    rng = np.random.default_rng(2)
    c = rng.integers(-9, 9, (500, 40)) * (rng.random((500, 40)) < share)
    q = rng.integers(-9, 9, (150, 40)) * (rng.random((150, 40)) < share)
    q_ids, c_ids = np.arange(1000, 1150), rng.permutation(500)
    got = topk.search_block(q_ids, q, c_ids, c, 7)
    scores = q @ c.T
    want = [(q_ids[r], c_ids[k], scores[r, k]) for r in range(150) for k in np.lexsort((c_ids, -scores[r]))[:7]]
    assert sorted(zip(*got)) == sorted(want)


def test_topk_beyond_64_bits():
    one, codes = np.array([1]), np.array([[np.iinfo(np.int64).max, 256]])
    with pytest.raises(OverflowError):
        topk.search_block(one, codes, one + 1, codes, 1)


@given(st.lists(st.integers(1, 31), max_size=120), st.integers(1, 12))
@settings(max_examples=60, deadline=None)
def test_placed_pieces_fill_windows(sizes, max_open):
    packer, done = packing.SumOfSquares(32, max_open), []
    for doc, size in enumerate(sizes):
        done += packer.place(packing.Piece(doc, 0, np.arange(size, dtype="<u4"), size))
        assert packer.n_open == packer.level.sum() == sum(map(len, packer.open.values())) <= max_open
    full = len(done)
    assert all(sum(len(p.ids) for p in w) == 32 for w in done)
    done += packer.settle(keep=False)
    assert sum(sum(len(p.ids) for p in w) < 32 for w in done[full:]) <= 1
    ids = defaultdict(list)
    for p in (p for w in done for p in w):
        ids[p.doc] += list(range(p.start, p.start + len(p.ids)))
        assert p.ids.tolist() == list(range(p.start, p.start + len(p.ids)))
    assert {d: sorted(x) for d, x in ids.items()} == {d: list(range(s)) for d, s in enumerate(sizes)}
