"""Edit distances by bit vectors, against the table of distances."""

import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quernstone.functions.distance import edit_distance, edits
from quernstone.operators import scoring


def table(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            diagonal, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, diagonal + (x != y))
    return line[-1]


@given(st.text("abق\U0001f600", max_size=150), st.text("abق\U0001f600", max_size=150))
@settings(max_examples=300, deadline=None)
def test_characters(a, b):
    assert edits(a, b) == table(a, b) == edits(b, a)


@given(st.lists(st.sampled_from(["a", "b", "ab", None]), max_size=90), st.lists(st.sampled_from(["a", "b", "ab", None]), max_size=90))
@settings(max_examples=200, deadline=None)
def test_words(a, b):
    assert edits(a, b) == table(a, b)


def test_a_hundred_thousand_characters():
    rng = random.Random(2)
    a = "".join(rng.choice("abcdefgh ") for _ in range(100_000))
    b = list(a)
    places = sorted(rng.sample(range(0, 100_000, 50), 300), reverse=True)
    for k in places[:100]:
        b[k] = "#"
    for k in places[100:200]:
        del b[k]
    for k in places[200:]:
        b.insert(k, "%")
    began = time.perf_counter()
    assert edits(a, "".join(b)) == 300  # each change is fifty places from the next and brings its own sign or length
    assert time.perf_counter() - began < 60


def test_long_texts_equal_the_table():
    rng = random.Random(3)
    a = [rng.choice("abcd") for _ in range(2500)]
    b = [rng.choice("abcd") for _ in range(1900)]
    assert edits(a, b) == table(a, b)


def test_columns_and_missing_sides(spark):
    df = spark.createDataFrame([(1, ["a", None], ["a", "b"]), (2, [], ["x"]), (3, None, ["x"])], "k int, a array<string>, b array<string>")
    assert {r.k: r.d for r in df.select("k", edit_distance(F.col("a"), F.col("b")).alias("d")).collect()} == {1: 1, 2: 1, 3: None}
    pairs = spark.createDataFrame([(1, "a b c", "a x c"), (2, "a b", None), (3, None, "a"), (4, "", "a b"), (5, "", "")], "idx int, ref string, hyp string")
    got = {r.idx: (r.word_edits, r.words, r.char_edits, r.chars, r.wer) for r in scoring.scored(pairs).collect()}
    assert got == {1: (1, 3, 1, 5, 1 / 3), 4: (2, 0, 3, 0, 2.0), 5: (0, 0, 0, 0, 0.0)}
