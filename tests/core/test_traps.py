"""Literal rows for the rules that silently change answers when they are missed."""

import pytest
from pyspark.sql import functions as F

from quernstone.functions import distance, text
from quernstone.operators import cohort, pools, quality, scoring, verdicts
from quernstone.sources.corpus import measured

NAN = float("nan")


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'array<string>'}" for k, v in values.items()))
    return df.select(column).first()[0]


def test_nan_is_not_measured(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", NAN), ("a", 3.0), ("b", NAN), ("c", None)], "speaker string, f0_median double")
    got = {r.speaker: (r.f0_speaker, r.n_f0) for r in cohort.speaker_f0(rows).collect()}
    assert got == {"a": (2.0, 2), "b": (None, 0), "c": (None, 0)}
    assert rows.select(F.count(measured("f0_median"))).first()[0] == 2


def test_pitch_gate(spark):
    rows = spark.createDataFrame([(1, NAN), (2, None), (3, 165.0), (4, 164.9)], "k int, f0_speaker double")
    assert [r.k for r in quality.pitch_gate(rows).collect()] == [3]


BASE = {"duration": 5.0, "snr_db": 30.0, "squim_mos": 4.5, "music_score": 0.0, "cer_yt_vs_cohere": 0.0, "coverage": 1.0, "boundary_clipped": False}


@pytest.mark.parametrize(
    "change, kept",
    [({"snr_db": None}, True), ({"snr_db": NAN}, True), ({"snr_db": 19.9}, False), ({"snr_db": 20.0}, True), ({"boundary_clipped": None}, True), ({"boundary_clipped": True}, False), ({"duration": None}, False), ({"duration": 1.5}, True), ({"duration": 12.1}, False), ({"coverage": 0.7}, False), ({"music_score": 0.06}, False), ({"squim_mos": 4.1}, False), ({"cer_yt_vs_cohere": 0.2}, False)],
)
def test_row_quality(spark, change, kept):
    row = BASE | change
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {'boolean' if k == 'boundary_clipped' else 'double'}" for k in row))
    assert quality.row_quality(df).count() == kept
    assert [r.hours for r in quality.retention_report(df).collect()][-1] == pytest.approx(kept * (row["duration"] or 0) / 3600)


@pytest.mark.parametrize("hours, taken", [([10, 10, 10, 1], 3), ([25, 1], 1), ([24.9, 1, 1], 2), ([], 0)])
def test_greedy_prefix(spark, hours, taken):
    df = spark.createDataFrame([(f"s{k}", 1 - k / 10, float(h)) for k, h in enumerate(hours)], "speaker string, cos double, hours double")
    assert sorted(r.speaker for r in cohort.greedy_prefix(df, 25.0).collect()) == [f"s{k}" for k in range(taken)]


def test_buckets(spark):
    rows = spark.createDataFrame([("a", 130.0, 3600.0), ("b", 155.0, 3600.0), ("b", 155.0, 3600.0), ("c", 400.0, 3600.0), ("d", None, 1.0)], "speaker string, f0_speaker double, duration double")
    got = {(r.lo, r.hi): (r.speakers, r.hours) for r in cohort.f0_buckets(rows).collect()}
    assert got[130, 145] == (1, 1.0) and got[155, 170] == (1, 2.0) and sum(s for s, _ in got.values()) == 2 and len(got) == 6


def test_medians(spark):
    rows = spark.createDataFrame([("s", x) for x in (1.0, 2.0, 3.0, 10.0, NAN)], "speaker string, f0_median double")
    assert cohort.lower_median(rows, "speaker", "f0_median").first().lower_median == 2.0
    assert cohort.speaker_f0(rows).first().f0_speaker == 2.5


def test_voiced_minimum(spark):
    df = spark.createDataFrame([([100.0 + k for k in range(10)] + [65.0, 350.0],), ([100.0] * 9,)], "f array<double>")
    assert [r[0] for r in df.select(quality.voiced_median("f")).collect()] == [104.0, None]
    assert [r[0] for r in df.select(quality.voiced_median("f", 60, 400, 11)).collect()] == [104.0, None]


def test_ids(spark):
    train, val = (spark.createDataFrame([(x,) for x in xs], "speaker string") for xs in (["b", "a", "a"], ["c", "a", None]))
    ids = cohort.dense_ids(train)
    assert {r.speaker: r.speaker_id for r in cohort.append_ids(ids, val.filter("speaker is not null")).collect()} == {"a": 0, "b": 1, "c": 2}


def test_argmax_ties_and_nulls(spark):
    rows = spark.createDataFrame([("b", 2.0, 4.0), ("a", 2.0, 4.0), ("c", 99.0, None)], "speaker string, hours double, squim double")
    assert cohort.argmax_seed(rows).first().speaker == "a"


def pairs(spark, rows):
    return spark.createDataFrame([(k, r, h, c) for k, (r, h, c) in enumerate(rows)], "idx int, ref string, hyp string, category string")


def test_micro_rates(spark):
    rows = scoring.scored(pairs(spark, [("a b c d", "a x c y", "k"), ("a", "a", "l"), ("left out", None, "m")]))
    assert scoring.error_rates(rows).first().wer == pytest.approx(0.4)
    assert scoring.error_rates(scoring.scored(pairs(spark, [("a", "x y z", "k")]))).first().wer == 3.0
    assert scoring.error_rates(scoring.scored(pairs(spark, [("", "", "k")]))).first().wer == 0.0
    assert scoring.error_rates(rows.limit(0)).first().wer == 0.0
    assert [r.category for r in scoring.by_category(rows).collect()] == ["k", "l"]
    assert scoring.by_category(rows.filter("category = 'k'")).collect() == []


def test_wer_gate(spark, monkeypatch):
    rows = scoring.scored(pairs(spark, [("a b", "a x", "k")]))
    assert scoring.wer_gate(rows).first().abort is True
    monkeypatch.setenv("WER_ABORT", "0.6")
    assert scoring.wer_gate(rows).first().abort is False


@pytest.mark.parametrize("a, b, d", [("abc", "axcd", 2), ("abc", "", 3), ("", "qr", 2), ("", "", 0), ("قج", "جق", 2)])
def test_edit_distance(spark, a, b, d):
    assert one(spark, distance.edit_distance(F.col("a"), F.col("b")), a=list(a), b=list(b)) == d


@pytest.mark.parametrize(
    "f, given, want",
    [
        (text.strip_final, "رَجُلٌ", "رَجُل"),
        (text.strip_final, "حَقٌّ", "حَقّ"),
        (text.strip_final, "حَقٌّ رَ", "حَقّ ر"),
        (text.normalize_marks, "\u0634\u064e\u0651", "\u0634\u0651\u064e"),
        (text.normalize_marks, "\u0634\u064e\u064e\u0651\u0651", "\u0634\u0651\u064e"),
        (text.count_misordered, "\u0634\u064e\u0651", 1),
        (text.normalize_text, "a [x] bé", "é"),
        (text.latin_runs, "a [x] bé", 2),
        (text.normalize_text, "ـ  x ", ""),
        (text.clean_phonemes, "a.b c. .d [e]", "ab c. .d e"),
        (text.wer_norm, "أهلاً، (نعم)", "اهلا نعم"),
        (text.norm_key, "قَلم", "جلم"),
        (text.undiacritize, "القُرآن", "القران"),
        (text.stem, "a/b/c.d.wav", "c.d"),
        (text.stem, "plain", "plain"),
        (text.pausal_ok, "رَجُلٌ", False),
    ],
)
def test_text_functions(spark, f, given, want):
    assert one(spark, f(F.col("t")), t=given) == want


def test_dialect(spark):
    df = spark.createDataFrame([(["سورة", "البقرة"], ["surat", "albaqara"]), (["ذبحنا", "البقرة"], ["x", "albaqara"]), (["القُرآن"], ["alquran"]), (["a"], ["b", "c"])], "w array<string>, p array<string>")
    got = [r[0] for r in df.select(text.dialect_rewrite(F.col("w"), F.col("p"), F.array(F.lit("القران")))).collect()]
    assert got == [["surat", "albaqara"], ["x", "albaɡara"], ["alquran"], None]


def test_previous_words(spark):
    assert one(spark, text.previous_words(F.col("w")), w=["a", "b", "c"]) == [None, "a", "b"]


def test_pool_takes_the_first_of_equal_texts(spark):
    rows = spark.createDataFrame([(str(k), ("x" * 50) + str(k % 3)) for k in range(30)] + [("s", "short"), ("n", None)], "k string, t string")
    got = pools.held_out_pool(rows, "k", "t").collect()
    assert len(got) == 3 and {r.t[-1] for r in got} == {"0", "1", "2"}
    order = {r.k: i for i, r in enumerate(rows.orderBy(*pools.shuffled("k")).collect())}
    for r in got:
        assert order[r.k] == min(order[str(k)] for k in range(30) if str(k % 3) == r.t[-1])


def test_cap_counts_valid_rows(spark):
    rows = spark.createDataFrame([("s", k, k % 2 == 0) for k in range(20)], "s string, k int, ok boolean")
    assert [r.k for r in pools.cap_per_key(rows, "s", "k", 3, F.col("ok")).collect()] == [0, 2, 4]


METRICS = {"dead_frac": 0.0, "high_low_db": -20.0, "flatness": 0.3, **dict.fromkeys(verdicts.TONAL, 3.0)}


@pytest.mark.parametrize(
    "change, want",
    [({}, "STRUCTURED"), ({"dead_frac": 0.6, "pkmean_8_9k": 99.0}, "ZEROED"), ({"high_low_db": -46.0}, "ZEROED"), ({"pkmean_9_10k": 9.1}, "TONAL"), ({"flatness": 0.7, "high_low_db": -13.0}, "HISSING"), ({"pkmean_9_10k": 9.1, "ref_pkmean_9_10k": 0.0}, "STRUCTURED"), ({"pkmean_9_10k": 9.1, "ref_pkmean_9_10k": None}, "STRUCTURED")],
)
def test_band_verdict(spark, change, want):
    row = METRICS | {f"ref_{k}": v for k, v in METRICS.items()} | change
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} double" for k in row))
    assert df.select(verdicts.band_verdict()).first()[0] == want


@pytest.mark.parametrize("pk, db, want", [(3.0, -14.0, "OK"), (6.1, -14.0, "BUZZ"), (3.0, -35.0, "DEAD")])
def test_bandwidth_verdict(spark, pk, db, want):
    df = spark.createDataFrame([(pk, 1.0, db, 3.0, 1.0, -14.0)], "pkmean_8_10k double, pkmean_10_12k double, db_8_10k double, ref_pkmean_8_10k double, ref_pkmean_10_12k double, ref_db_8_10k double")
    assert df.select(verdicts.bandwidth_verdict()).first()[0] == want


def test_reference_join_and_preflight(spark):
    run, ref = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "metric string, value double"), spark.createDataFrame([("a", 3.0)], "metric string, value double")
    got = {r.metric: r.ref for r in verdicts.against_reference(run, ref).collect()}
    assert got["a"] == 3.0 and got["b"] != got["b"]
    assert verdicts.preflight(spark.createDataFrame([(True,), (None,)], "ok boolean")).first().passed is False


def test_small_helpers(spark):
    rows = spark.createDataFrame([("a", None, 508, 2.0, 1.0), ("b", "", 509, 9.0, 3.0)], "audio_file string, text string, tokens int, seconds double, dur double")
    assert [r[0] for r in rows.select(quality.within_budget("tokens")).collect()] == [True, False]
    assert [r[0] for r in rows.select(quality.has_text("text")).collect()] == [False, False]
    assert [r.text for r in quality.filled(rows, "text").collect()] == ["", ""]
    assert tuple(scoring.synthesis_report(rows).first()) == (2, 2.5, 3.0)
    chosen = spark.createDataFrame([("b", "s")], "audio_file string, speaker string")
    assert [(r.audio_file, r.speaker) for r in cohort.keep_selected(rows, chosen).collect()] == [("b", "s")]
