"""Alignment, chunking and text functions against plain restatements and properties."""

import difflib
import random
import re
import time
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quernstone.functions import alignment, text
from quernstone.operators import frontend

MARKED = st.text(st.sampled_from("ابق" + text.SHORT_MARKS + text.SHADDA + " "), max_size=14)
PLAIN = st.text(st.sampled_from("ab .,؟!x"), max_size=40)


def bare(s):
    return "".join(c for c in s if unicodedata.category(c) != "Mn")


@given(MARKED, MARKED, MARKED)
@settings(max_examples=200, deadline=None)
def test_recovery_keeps_the_letters(a, b, c):
    got, share = alignment.recover(a, b, c)
    assert 0 <= share <= 1
    if a.split() and b.split():
        assert bare(got) == " ".join(bare(w) for w in a.split()) or got == a


def blocks(a, b):
    found = difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()
    return [(m.a + k, m.b + k) for m in found for k in range(m.size)]


@given(st.lists(st.sampled_from("abc"), max_size=60), st.lists(st.sampled_from("abc"), max_size=60))
@settings(max_examples=600, deadline=None)
def test_matching_pairs_are_those_of_difflib(a, b):
    assert alignment.matching_pairs(a, b) == blocks(a, b)


@given(st.lists(st.integers(0, 30), max_size=120), st.lists(st.integers(0, 5), max_size=12))
@settings(max_examples=300, deadline=None)
def test_matching_pairs_of_edited_lists(a, cuts):
    b = list(a)
    for c in cuts:
        b[c * 7 : c * 7 + c] = [c] * (3 - c if c < 3 else 0)
    assert alignment.matching_pairs(a, b) == blocks(a, b) and alignment.matching_pairs(b, a) == blocks(b, a)


def test_matching_pairs_of_long_lists_take_little_time():
    rng = random.Random(6)
    a = [rng.randrange(800) for _ in range(20_000)]
    b = [w for k, w in enumerate(a) if k % 5 != 4]
    began = time.perf_counter()
    pairs = alignment.matching_pairs(a, b)
    assert time.perf_counter() - began < 30 and len(pairs) >= 15_000
    assert alignment.matching_pairs(a[:1500], b[:1200]) == blocks(a[:1500], b[:1200])


@given(st.text("ab\u064e\u0651\u0670", max_size=9), st.text("xy\u064e\u0651\u0670", max_size=9))
@settings(max_examples=300, deadline=None)
def test_seated_marks_by_plain_code(bare_word, marked):
    queue, out = [c for c in bare_word if c in "ab"], []
    if len(queue) != sum(c in "xy" for c in marked):
        assert alignment.seat_marks(bare_word, marked) is None
        return
    for c in marked:
        if c in "xy":
            out.append(queue.pop(0))
        elif out:
            out.append(c)
    assert alignment.seat_marks(bare_word, marked) == "".join(out)


def test_recovery_rules():
    assert alignment.recover("ذهب", "", "ذَهب") == ("ذهب", 0.0)
    assert alignment.recover("", "x", "y") == ("", 0.0) == alignment.recover(None, None, None)
    assert alignment.recover("ذهب قلم", "ذَهبَ جَلم", None) == ("ذَهب قَلم", 1.0)
    assert alignment.recover("ذهب قلم", "ذَهبَ", "ذهب قُلم") == ("ذَهب قُلم", 1.0)
    assert alignment.recover("ذهب قلم", "ذَهبَ", "قُلم") == ("ذَهب قُلم", 1.0)
    assert alignment.seat_marks("قلم", "َجَلم") == "قَلم" and alignment.seat_marks("قل", "جَلم") is None


@given(PLAIN, st.integers(1, 12))
@settings(max_examples=200, deadline=None)
def test_chunks(s, limit):
    out = alignment.chunk(s, limit, frozenset("abx "))
    assert " ".join(t for t, _ in out).split() == re.sub("[.,؟!]", " ", s).split()
    for t, kind in out:
        assert kind in ("ellipsis", "stop", "comma", "forced") and (len(t) <= limit or " " not in t)
    assert not out or out[-1][1] != "forced"


def test_chunk_kinds():
    assert alignment.chunk("aa.. bb, cc. dd", 2, frozenset("abcd")) == [("aa", "ellipsis"), ("bb", "comma"), ("cc", "stop"), ("dd", "stop")]
    assert alignment.chunk("aa, bb. cc", 4, frozenset("abc")) == [("aa bb", "stop"), ("cc", "stop")]
    assert alignment.chunk("a b c d,", 2, frozenset("abcd")) == [("a b", "forced"), ("c d", "comma")]
    assert alignment.chunk(None, 3, frozenset()) == []


def test_expressions_match_restatements(spark):
    import random

    rng = random.Random(0)
    texts = ["".join(rng.choice("ابق" + text.SHORT_MARKS + text.SHADDA + "  ") for _ in range(rng.randint(0, 14))) for _ in range(800)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", text.normalize_marks(F.col("t")).alias("n"), text.strip_final(F.col("t")).alias("s"), text.undiacritize(F.col("t")).alias("u")).collect()

    def canonical(t):
        while True:
            new = "".join(_swap(list(t)))
            if new == t:
                break
            t = new
        return re.sub(f"([{text.SHORT_MARKS}{text.SHADDA}])\\1+", r"\1", t)

    def _swap(c):
        for i in range(len(c) - 1):
            if c[i] in text.SHORT_MARKS and c[i + 1] == text.SHADDA:
                c[i], c[i + 1] = c[i + 1], c[i]
        return c

    for r in rows:
        assert r.n == canonical(r.t)
        marks = text.SHORT_MARKS + text.SHADDA
        assert r.s == " ".join(w.rstrip(marks) + "".join(c for c in w[len(w.rstrip(marks)) :] if c == text.SHADDA) for w in r.t.split(" "))
        assert r.u == bare(r.t)


def test_recovery_and_chunks_on_columns(spark):
    df = spark.createDataFrame([("ذهب", "ذَهبَ", None, "aa, bb. cc"), (None, "x", "y", None)], "b string, r string, e string, c string")
    got = df.select(alignment.recover_marks(F.col("b"), F.col("r"), F.col("e")).alias("m"), alignment.transfer_marks(F.col("b"), F.col("r")).alias("t"), alignment.chunk_text(F.col("c"), 4, "abc").alias("c")).collect()
    assert got[0].m.text == "ذَهب" and got[0].m.coverage == 1.0 and got[0].t == "ذَهبَ"
    assert [(c.text, c.kind) for c in got[0].c] == [("aa bb", "stop"), ("cc", "stop")]
    assert got[1].m.text == "" and got[1].t is None and got[1].c == []


def test_front_end(spark):
    rows = spark.createDataFrame([("سورة البقرة", "suurat albaqarat", ["suurat", "albaqarat"]), ("قال له", "qaal.lahu", ["qaal", "lahu"]), ("", "", []), ("القران ab", "alquran x", ["alquran", "x"])], "text string, phonemes string, by_word array<string>")
    out = frontend.phonemized(rows, F.array(F.lit("القران")), word_sounds="by_word")
    got = out.collect()
    assert [r.spoken for r in got] == ["suurat albaqarat", "ɡaal lahu", "", "alquran x"]
    assert [r.misaligned for r in got] == [False, True, False, False]
    c = frontend.counters(out).first()
    assert (c.words, c.q_words, c.q_kept, c.q_rewritten, c.misaligned_sentences, c.latin_dropped) == (6, 3, 2, 1, 1, 1)
    assert frontend.phonemized(rows, F.array(F.lit("x")), dialect=False).collect()[1].spoken == "qaallahu"


def test_reports(spark):
    rows = spark.createDataFrame([("قلم قال", "قَلم قال", "قلم", 0.1), ("", "x", "y", 0.5), ("كتاب", None, "", 0.2)], "text string, text_tashkeel_raw string, text_tashkeel string, coverage double")
    r = frontend.coverage_report(rows).first()
    assert (r.n, r.q_words, r.old_q_marked, r.new_q_marked, r.new_coverage) == (1, 1, 0.0, 1.0, 0.5)
    oov = frontend.oov_count(rows, "text", spark.createDataFrame([(c,) for c in "قلم ا"], "symbol string"))
    assert {x.symbol: x.n for x in oov.collect()} == {"ك": 1, "ت": 1, "ب": 1}
    counted = lambda misaligned, n: spark.createDataFrame([(misaligned, n)], "misaligned_sentences long, sentences long")
    assert frontend.gate(oov, counted(0, 3)).first().verdict == "FAIL"
    assert [frontend.gate(oov.limit(0), counted(k, 100)).first().verdict for k in (0, 5, 6)] == ["PASS", "PASS", "WARN"]
    assert frontend.final_forms(spark.createDataFrame([("كتابك كتابك لك",)], "t string"), "t").collect()[0].n == 2
