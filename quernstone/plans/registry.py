"""Registered queries of the corpus operators, each over whole tables, with their DuckDB oracles."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.checkpoints import shared_folder
from quernstone.functions import alignment, audio, models, text, vectors
from quernstone.functions.text import FOLD_FROM, FOLD_TO, JEEM, PHONEME_NOISE, QAF, SHADDA, SHORT_MARKS, TATWEEL, WER_PUNCTUATION
from quernstone.operators import cohort, frontend, pairs, pools, quality, scans, scoring, verdicts
from quernstone.plans import views
from quernstone.plans.views import WITH, rounded
from quernstone.sources import corpus, sinks
from quernstone.sources.corpus import measured

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable:
    """Registers a query under its function's name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return add


# Filters ---------------------------------------------------------------------------------------------------------

#: The row filter's checks in SQL.
CHECKS = {
    "duration": "coalesce(duration BETWEEN 1.5 AND 12.0, false)",
    "snr_db": "(snr_db IS NULL OR snr_db >= 20)",
    "squim_mos": "(squim_mos IS NULL OR squim_mos >= 4.2)",
    "music_score": "(music_score IS NULL OR music_score <= CAST(0.05 AS DOUBLE))",
    "cer": "(cer_yt_vs_cohere IS NULL OR cer_yt_vs_cohere <= CAST(0.10 AS DOUBLE))",
    "coverage": "(coverage IS NULL OR coverage >= CAST(0.75 AS DOUBLE))",
    "boundary": "(boundary_clipped IS DISTINCT FROM true)",
}
PASSES = " AND ".join(CHECKS.values())
GOOD = WITH + f", good AS (SELECT * FROM clips WHERE {PASSES})"
SPEAKER_F0 = "speaker_f0 AS (SELECT speaker, median(nullif(f0_median, CAST('NaN' AS DOUBLE))) AS f0_speaker, count(nullif(f0_median, CAST('NaN' AS DOUBLE))) AS n_f0 FROM features GROUP BY speaker)"
JOINED = GOOD + f", {SPEAKER_F0}, joined AS (SELECT * FROM good LEFT JOIN speaker_f0 USING (speaker))"


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.with_speaker_f0(quality.row_quality(views.clips(spark, sf_dir)), views.features(spark, sf_dir))


@query(WITH + f"SELECT speaker, round(sum(CASE WHEN {PASSES} THEN duration END) / 3600, 6) AS hours, count(*) FILTER ({PASSES}) AS kept, count(*) AS n_rows, round(avg(CASE WHEN {PASSES} THEN 1.0 ELSE 0.0 END), 6) AS share FROM clips GROUP BY speaker")
def quality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = quality.passes()
    found = views.clips(spark, sf_dir).groupBy("speaker").agg((F.sum(F.when(ok, F.col("duration"))) / 3600).alias("hours"), F.count_if(ok).alias("kept"), F.count("*").alias("n_rows"), F.avg(ok.cast("double")).alias("share"))
    return rounded(found)


@query(GOOD + " SELECT audio_file, speaker, duration FROM good")
def row_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_quality(views.clips(spark, sf_dir)).select("audio_file", "speaker", "duration")


@query(WITH + " UNION ALL ".join(f"SELECT '{k}' AS \"check\", round(coalesce(sum(CASE WHEN {c} THEN duration END), 0) / 3600, 6) AS hours, round(avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END), 6) AS share FROM clips" for k, c in (CHECKS | {"all": PASSES}).items()))
def retention_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.retention_report(views.clips(spark, sf_dir)))


@query(WITH + f", {SPEAKER_F0} SELECT speaker, round(f0_speaker, 6) AS f0_speaker, n_f0 FROM speaker_f0")
def speaker_f0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.speaker_f0(views.features(spark, sf_dir)))


@query(JOINED + " SELECT audio_file, speaker, round(f0_speaker, 6) AS f0_speaker FROM joined WHERE f0_speaker >= 165 AND NOT isnan(f0_speaker)")
def pitch_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(quality.pitch_gate(_joined(spark, sf_dir)).select("audio_file", "speaker", "f0_speaker"))


# Aggregates ------------------------------------------------------------------------------------------------------


@query(
    WITH
    + """SELECT video_id, n, round(q[2], 6) AS median_f0, round(q[1], 6) AS p25, round(q[3], 6) AS p75, CASE WHEN q[2] < 155 THEN 'low' ELSE 'high' END AS band
FROM (SELECT video_id, count(*) AS n, quantile_cont(f0_median, [0.25, 0.5, 0.75]) AS q FROM features WHERE NOT isnan(f0_median) GROUP BY video_id)"""
)
def video_f0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.video_f0(views.features(spark, sf_dir)))


@query(
    WITH
    + """, v AS (SELECT video_id, median(f0_median) AS m FROM features WHERE NOT isnan(f0_median) GROUP BY video_id)
SELECT count(*) AS videos, count(*) FILTER (m < 155) AS low, count(*) FILTER (m >= 155) AS high, round(min(m), 6) AS min_f0, round(max(m), 6) AS max_f0,
  CASE WHEN count(*) FILTER (m < 155) > 0 AND count(*) FILTER (m >= 155) > 0 THEN 'MULTI' WHEN max(m) - min(m) > 50 THEN 'SUSPICIOUS' ELSE 'SINGLE' END AS verdict FROM v"""
)
def f0_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.f0_spread(cohort.video_f0(views.features(spark, sf_dir))).withColumn("verdict", verdicts.f0_verdict()))


@query(
    WITH
    + f""", {SPEAKER_F0}, per AS (SELECT speaker, any_value(f0_speaker) AS f0, sum(duration) / 3600 AS hours FROM clips LEFT JOIN speaker_f0 USING (speaker) GROUP BY speaker),
b(lo, hi) AS (VALUES {", ".join(map(str, cohort.BUCKETS))})
SELECT CAST(lo AS INTEGER) AS lo, CAST(hi AS INTEGER) AS hi, count(speaker) AS speakers, round(coalesce(sum(hours), 0), 6) AS hours FROM b LEFT JOIN per ON f0 >= lo AND f0 < hi GROUP BY lo, hi"""
)
def f0_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.f0_buckets(cohort.with_speaker_f0(views.clips(spark, sf_dir), views.features(spark, sf_dir))))


@query(WITH + "SELECT count(*) AS n_rows, round(sum(duration) / 3600, 6) AS hours, count(DISTINCT speaker) AS speakers, count(DISTINCT video_id) AS videos FROM clips")
def corpus_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.corpus_totals(views.clips(spark, sf_dir)))


@query(WITH + "SELECT speaker, round(quantile_disc(f0_median, 0.5), 6) AS lower_median FROM features WHERE NOT isnan(f0_median) GROUP BY speaker")
def lower_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.lower_median(views.features(spark, sf_dir), "speaker", "f0_median"))


PROFILE = JOINED + ", profile AS (SELECT speaker, sum(duration) / 3600 AS hours, median(squim_mos) AS squim, median(snr_db) AS snr, any_value(f0_speaker) AS f0 FROM joined GROUP BY speaker)"


@query(PROFILE + " SELECT speaker, round(hours, 6) AS hours, round(squim, 6) AS squim, round(snr, 6) AS snr, round(f0, 6) AS f0 FROM profile")
def speaker_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.speaker_profile(_joined(spark, sf_dir)))


# Joins, ids, sets ------------------------------------------------------------------------------------------------


@query(GOOD + " SELECT audio_file, speaker FROM clips WHERE NOT EXISTS (SELECT 1 FROM good WHERE good.audio_file = clips.audio_file)")
def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = views.clips(spark, sf_dir)
    return pools.rejected(clips.select("audio_file", "speaker"), quality.row_quality(clips), "audio_file")


@query(GOOD + " SELECT speaker, CAST(row_number() OVER (ORDER BY speaker) - 1 AS INTEGER) AS speaker_id FROM (SELECT DISTINCT speaker FROM good)")
def dense_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort.dense_ids(quality.row_quality(views.clips(spark, sf_dir)))


@query(
    WITH
    + """, train AS (SELECT DISTINCT video_id AS speaker FROM features WHERE f0_median < 100), val AS (SELECT DISTINCT video_id AS speaker FROM features WHERE f0_median > 200 OR audio_file LIKE '%7'),
ids AS (SELECT speaker, row_number() OVER (ORDER BY speaker) - 1 AS id FROM train)
SELECT speaker, CAST(id AS INTEGER) AS speaker_id FROM ids UNION ALL
SELECT speaker, CAST((SELECT count(*) FROM ids) + row_number() OVER (ORDER BY speaker) - 1 AS INTEGER) FROM (SELECT speaker FROM val EXCEPT SELECT speaker FROM train)"""
)
def append_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.features(spark, sf_dir).select(F.col("video_id").alias("speaker"), "f0_median", "audio_file")
    ids = cohort.dense_ids(rows.filter(~F.isnan("f0_median") & (F.col("f0_median") < 100)))
    return cohort.append_ids(ids, rows.filter((F.col("f0_median") > 200) | F.col("audio_file").like("%7")))


@query(WITH + "SELECT audio_file, speaker, f0_median FROM features WHERE NOT isnan(f0_median) QUALIFY row_number() OVER (PARTITION BY speaker ORDER BY audio_file) <= 40")
def cap_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.features(spark, sf_dir).select("audio_file", "speaker", "f0_median")
    return pools.cap_per_key(rows, "speaker", "audio_file", 40, ~F.isnan("f0_median"))


@query(WITH + "SELECT audio_file, speaker FROM clips ORDER BY md5(audio_file), audio_file LIMIT 500")
def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pools.sample(views.clips(spark, sf_dir).select("audio_file", "speaker"), "audio_file", 500)


@query(
    GOOD
    + """, drawn AS (SELECT audio_file, text FROM clips WHERE NOT EXISTS (SELECT 1 FROM good WHERE good.audio_file = clips.audio_file) ORDER BY md5(audio_file), audio_file LIMIT 40000),
firsts AS (SELECT * FROM drawn WHERE length(text) >= 50 QUALIFY row_number() OVER (PARTITION BY text ORDER BY md5(audio_file), audio_file) = 1)
SELECT audio_file, text FROM firsts ORDER BY md5(audio_file), audio_file LIMIT 20000"""
)
def ood_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    clips = views.clips(spark, sf_dir)
    return pools.held_out_pool(pools.rejected(clips, quality.row_quality(clips), "audio_file"), "audio_file", "text")


@query(
    WITH
    + """SELECT audio_file, speaker, duration, CAST(NULL AS DOUBLE) AS f0_median FROM clips
UNION ALL SELECT audio_file, speaker, NULL, CASE WHEN isnan(f0_median) THEN NULL ELSE f0_median END FROM features"""
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pools.union_by_name(views.clips(spark, sf_dir).select("audio_file", "speaker", "duration"), views.features(spark, sf_dir).select("audio_file", "speaker", measured("f0_median").alias("f0_median")))


@query(WITH + "SELECT speaker FROM clips UNION SELECT speaker FROM features UNION SELECT video_id FROM features")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = views.features(spark, sf_dir)
    return pools.union_distinct(views.clips(spark, sf_dir).select("speaker"), f.select("speaker"), f.select("video_id"))


@query(WITH + "SELECT DISTINCT video_id FROM clips")
def distinct_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pools.distinct_sorted(views.clips(spark, sf_dir), "video_id")


# Vectors ---------------------------------------------------------------------------------------------------------

LONG_VECTORS = ", parts AS (SELECT vec_id, speaker, label, unnest(list_transform(ecapa, lambda x: CAST(x AS DOUBLE))) AS x, unnest(range(len(ecapa))) AS pos FROM vectors)"


def _centroids(group: str, source: str, eps: str) -> str:
    return f"(SELECT {group}, list_transform(m, lambda x: x / (sqrt(list_sum(list_transform(m, lambda y: y * y))) + {eps})) AS c FROM (SELECT {group}, list(x ORDER BY pos) AS m FROM (SELECT {group}, pos, avg(x) AS x FROM {source} GROUP BY {group}, pos) GROUP BY {group}))"


UNIT = ", unit AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS u FROM (SELECT vec_id, label, list_transform(ecapa, lambda x: CAST(x AS DOUBLE)) AS v FROM vectors))"
DOT = "list_sum(list_transform(list_zip({a}, {b}), lambda p: p[1] * p[2]))"


@query(WITH + LONG_VECTORS + f" SELECT speaker, CAST(pos AS INTEGER) AS pos, round(x, 6) AS x FROM (SELECT speaker, unnest(c) AS x, unnest(range(len(c))) AS pos FROM {_centroids('speaker', 'parts', '1e-9')})")
def centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vectors.centroids(views.vectors(spark, sf_dir), "speaker", "ecapa")
    return rounded(found.select("speaker", F.posexplode("centroid").alias("pos", "x")))


@query(
    WITH
    + UNIT
    + f""", cosines AS (SELECT CASE WHEN a.label = b.label THEN 'within' ELSE 'across' END AS scope, round({DOT.format(a="a.u", b="b.u")}, 6) AS cos FROM unit a JOIN unit b ON a.vec_id <> b.vec_id)
SELECT scope, count(*) AS n, round(avg(cos), 5) AS mean, round(quantile_cont(cos, 0.1), 5) AS p10, round(quantile_cont(cos, 0.9), 5) AS p90 FROM cosines GROUP BY scope"""
)
def pair_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pairs.similarity_report(pairs.cosine_counts(views.vectors(spark, sf_dir), "vec_id", "label", "ecapa")), 5)


CENTROID_PAIRS = UNIT + f", unit_parts AS (SELECT label, unnest(u) AS x, unnest(range(len(u))) AS pos FROM unit), cents AS {_centroids('label', 'unit_parts', '0')}, label_pairs AS (SELECT a.label AS a, b.label AS b, {DOT.format(a='a.c', b='b.c')} AS cos FROM cents a JOIN cents b ON a.label < b.label)"


@query(WITH + CENTROID_PAIRS + " SELECT a, b, round(cos, 6) AS cos FROM label_pairs")
def centroid_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pairs.centroid_pairs(views.vectors(spark, sf_dir), "label", "ecapa"))


@query(WITH + CENTROID_PAIRS + " SELECT count(*) AS pairs, round(avg(CASE WHEN cos > 0.35 THEN 1.0 ELSE 0.0 END), 6) AS share, CASE WHEN avg(CASE WHEN cos > 0.35 THEN 1.0 ELSE 0.0 END) > 0.9 THEN 'ONE' WHEN avg(CASE WHEN cos > 0.35 THEN 1.0 ELSE 0.0 END) < 0.2 THEN 'MANY' ELSE 'MIXED' END AS verdict FROM label_pairs")
def speaker_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pairs.speaker_verdict(views.vectors(spark, sf_dir), "label", "ecapa"))


NORMS = ", norms AS (SELECT vec_id, sqrt(list_sum(list_transform(ecapa, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS norm FROM vectors)"


@query(WITH + NORMS + " SELECT vec_id, round(norm, 6) AS norm, round(norm / (SELECT quantile_disc(norm, 0.5) FROM norms), 6) AS ratio, norm / (SELECT quantile_disc(norm, 0.5) FROM norms) > 0.5 AS trained FROM norms")
def row_norm_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.row_norm_ratio(views.vectors(spark, sf_dir), "vec_id", "ecapa"))


# Cohort ----------------------------------------------------------------------------------------------------------

CORE = (
    PROFILE
    + LONG_VECTORS
    + f""", cents AS {_centroids("speaker", "parts", "1e-9")}, both_ AS (SELECT * FROM profile JOIN cents USING (speaker)),
seed AS (SELECT * FROM both_ ORDER BY hours * coalesce(squim, 0) DESC NULLS LAST, speaker LIMIT 1),
cand AS (SELECT b.speaker, b.hours, b.f0, {DOT.format(a="b.c", b="s.c")} AS cos FROM both_ b JOIN seed s ON abs(b.f0 - s.f0) <= 15),
core AS (SELECT *, coalesce(sum(hours) OVER (ORDER BY cos DESC, speaker ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS hours_before FROM cand QUALIFY hours_before < 0.2)"""
)


@query(CORE + " SELECT speaker, round(hours, 6) AS hours, round(squim, 6) AS squim, round(f0, 6) AS f0 FROM seed")
def argmax_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = views.vectors(spark, sf_dir).select("speaker").distinct()
    return rounded(cohort.argmax_seed(cohort.speaker_profile(_joined(spark, sf_dir)).join(known, "speaker", "left_semi")).select("speaker", "hours", "squim", "f0"))


@query(CORE + " SELECT speaker, round(hours, 6) AS hours, round(f0, 6) AS f0, round(cos, 6) AS cos, round(hours_before, 6) AS hours_before FROM core")
def greedy_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cohort.voice_core(_joined(spark, sf_dir), views.vectors(spark, sf_dir), budget=0.2).select("speaker", "hours", "f0", "cos", "hours_before"))


@query(
    CORE
    + """ SELECT audio_file, g.speaker, CAST(dense_rank() OVER (ORDER BY g.speaker) - 1 AS INTEGER) AS speaker_id, video_id, duration, core.speaker IS NOT NULL AS in_voice_core
FROM good g LEFT JOIN core ON g.speaker = core.speaker"""
)
def selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cohort.selection(_joined(spark, sf_dir), views.vectors(spark, sf_dir), budget=0.2)
    return found.select("audio_file", "speaker", "speaker_id", "video_id", "duration", "in_voice_core")


@query(
    GOOD
    + """, ids AS (SELECT speaker, row_number() OVER (ORDER BY speaker) - 1 AS id FROM (SELECT DISTINCT speaker FROM good))
SELECT g.speaker || '/' || audio_file || '.wav|' || text || '|' || id AS line FROM good g JOIN ids USING (speaker) WHERE length(text) >= 20"""
)
def train_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = quality.row_quality(views.clips(spark, sf_dir))
    return sinks.train_lines(good.join(cohort.dense_ids(good), "speaker").withColumnRenamed("text", "phonemes"))


# Text ------------------------------------------------------------------------------------------------------------

#: Words in Arabic script with marks in many orders, written as literals since the tables have none.
ARABIC = [
    "رَجُلٌ حَقٌّ",
    "الشَّمْس [1] abc بكثر الـ..",
    "سورة البقرة، قال؟",
    "أإآٱةى مَِِّّ",
    "a [x] bé    c",
    "",
]


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' texts, and the literals under negative ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return docs.unionByName(spark.createDataFrame([(-1 - k, t) for k, t in enumerate(ARABIC)], "doc_id long, text string"))


TEXTS = "WITH texts AS (SELECT doc_id, text FROM documents UNION ALL VALUES " + ", ".join(f"({-1 - k}, '{t}')" for k, t in enumerate(ARABIC)) + ")"
MARKS = SHORT_MARKS + SHADDA
SPACE = "[\t-\r \x85\xa0  -     　]+"


def _squeeze(sql: str) -> str:
    return f"trim(regexp_replace({sql}, '{SPACE}', ' ', 'g'))"


def _fold(sql: str, frm: str = FOLD_FROM, to: str = FOLD_TO) -> str:
    return f"translate({sql}, '{frm}', '{to}')"


def _no_marks(sql: str) -> str:
    return f"regexp_replace({sql}, '\\p{{Mn}}', '', 'g')"


def _text_query(name: str, column: Callable[[], Column], sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _texts(spark, sf_dir).select("doc_id", column().alias("value"))

    run.__name__ = name
    query(f"{TEXTS} SELECT doc_id, {sql} AS value FROM texts")(run)


UNCITED = f"replace(regexp_replace(text, '\\[[^\\]]*\\]', ' ', 'g'), '{TATWEEL}', '')"
STRIPPED = f"array_to_string(list_transform(string_split(text, ' '), lambda w: regexp_extract(w, '^((?s:.)*?)[{MARKS}]*$', 1) || replace(regexp_replace(regexp_extract(w, '[{MARKS}]*$'), '[{SHORT_MARKS}]', '', 'g'), ' ', '')), ' ')"
MOVED = "text"
for _ in range(8):
    MOVED = f"regexp_replace({MOVED}, '([{SHORT_MARKS}]+)({SHADDA}+)', '\\2\\1', 'g')"
DEDUPED = MOVED
for _m in MARKS:
    DEDUPED = f"regexp_replace({DEDUPED}, '{_m}+', '{_m}', 'g')"
WER_SQL = _squeeze(_fold("translate(" + _no_marks("text") + ", '" + WER_PUNCTUATION.replace("'", "''") + "', '" + " " * len(WER_PUNCTUATION) + "')"))

_text_query("normalize_text", lambda: text.normalize_text(F.col("text")), _squeeze(f"regexp_replace({UNCITED}, '[A-Za-z]+', ' ', 'g')"))
_text_query("latin_runs", lambda: text.latin_runs(F.col("text")), f"len(regexp_extract_all({UNCITED}, '[A-Za-z]+'))")
_text_query("normalize_marks", lambda: text.normalize_marks(F.col("text")), DEDUPED)
_text_query("count_misordered", lambda: text.count_misordered(F.col("text")), f"len(regexp_extract_all(text, '[{MARKS}]{SHADDA}'))")
_text_query("strip_final", lambda: text.strip_final(F.col("text")), STRIPPED)
_text_query("pausal_ok", lambda: text.pausal_ok(F.col("text")), f"{STRIPPED} = text")
_text_query("undiacritize", lambda: text.undiacritize(F.col("text")), _no_marks(_fold(f"regexp_replace(text, '[{MARKS}]', '', 'g')")))
_text_query("norm_key", lambda: text.norm_key(F.col("text")), _fold(_no_marks("text"), FOLD_FROM + QAF, FOLD_TO + JEEM))
_text_query("wer_norm", lambda: text.wer_norm(F.col("text")), WER_SQL)
_text_query("token_count", lambda: text.token_count(F.col("text"), F.array(*map(F.lit, "etaoin.ق "))), "CAST(len(regexp_replace(text, '[^etaoin.ق ]', '', 'g')) AS BIGINT)")

DOTTED = "replace(text, 'e', '.e')"
NEAR_SPACE = "regexp_matches(ch[i {0} 1], '^" + SPACE + "$')"
UNDOTTED = f"(SELECT array_to_string(list_filter(ch, lambda c, i: c <> '.' OR i = 1 OR i = len(ch) OR {NEAR_SPACE.format('-')} OR {NEAR_SPACE.format('+')}), '') FROM (SELECT string_split({DOTTED}, '') AS ch))"
_text_query("clean_phonemes", lambda: text.clean_phonemes(F.expr(DOTTED)), f"translate({UNDOTTED}, '{PHONEME_NOISE}', '')")


@query(
    f"""{TEXTS}, ch AS (SELECT unnest(string_split(text, '')) AS symbol FROM texts)
SELECT symbol, count(*) AS n FROM ch WHERE symbol <> '' AND symbol NOT IN (SELECT chr(CAST(c AS INTEGER)) FROM range(97, 123) t(c)) GROUP BY symbol"""
)
def oov_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = spark.range(97, 123).select(F.char("id").alias("symbol"))
    return frontend.oov_count(_texts(spark, sf_dir), "text", letters)


@query(
    f"""{TEXTS}, w AS (SELECT unnest(string_split({_squeeze("text")}, ' ')) AS w FROM texts),
s AS (SELECT {_no_marks(_fold("w"))} AS skeleton FROM w)
SELECT skeleton, count(*) AS n FROM s WHERE length(skeleton) > 2 AND skeleton LIKE '%n' GROUP BY skeleton ORDER BY n DESC, skeleton LIMIT 8"""
)
def top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontend.final_forms(_texts(spark, sf_dir), "text", "n")


@query(f"{TEXTS} SELECT count(*) AS n, count(*) FILTER (text <> '' AND {STRIPPED} = text) AS unchanged, round(avg(CASE WHEN text <> '' AND {STRIPPED} = text THEN 1.0 ELSE 0.0 END), 6) AS share FROM texts")
def pausal_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(frontend.pausal_share(_texts(spark, sf_dir), "text"))


#: Literal words and phonemes for the dialect's rules.
SPOKEN = [("سورة البقرة", "suurat albaqarat"), ("ذبحنا البقرة", "dhabaHna albaqarat"), ("القرآن", "alquraan"), ("قال قال", "qaal"), ("", "")]
LEXICON = ["القران", "الفقه"]


#: A word's letters, as ``undiacritize`` has them; ``@`` stands for the word.
BARE = _no_marks(_fold(f"regexp_replace(@, '[{MARKS}]', '', 'g')"))
SPEECH = (
    f"""WITH squeezed AS (SELECT doc_id AS idx, {_squeeze("text")} AS s FROM documents),
said AS (SELECT idx, translate(s, 'q', '{QAF}') AS text, CASE WHEN idx % 5 = 4 THEN s || ' more' ELSE s END AS phonemes FROM squeezed
  UNION ALL VALUES """
    + ", ".join(f"({-1 - k}, '{t}', '{p}')" for k, (t, p) in enumerate(SPOKEN))
    + f"""),
lists AS (SELECT idx, text, string_split(text, ' ') AS w, string_split(translate({UNDOTTED.replace(DOTTED, "phonemes")}, '{PHONEME_NOISE}', ''), ' ') AS p FROM said),
keeping AS (SELECT *, list_transform(range(1, len(w) + 1), lambda i: contains(w[i], '{QAF}') AND (list_contains({LEXICON}, {BARE.replace("@", "w[i]")}) OR (i > 1 AND list_contains({list(text.SURA_TRIGGERS)}, {BARE.replace("@", "w[i - 1]")})))) AS k FROM lists),
spoken AS (SELECT idx, text = '' AS silent, len(w) <> len(p) AS uneven, len(w) AS n, len(list_filter(w, lambda x: contains(x, '{QAF}'))) AS q, len(list_filter(k, lambda x: x)) AS kept,
  array_to_string(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN k[i] THEN p[i] ELSE replace(p[i], 'q', '{text.DIALECT_G}') END), ' ') AS said FROM keeping)
"""
)


def _phonemized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with qaf for q as words and the text itself, at each fifth with a word more, as phonemes; and the literals under negative ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", text.collapse(F.col("text")).alias("text"))
    sounds = F.when(F.col("doc_id") % 5 == 4, F.concat("text", F.lit(" more"))).otherwise(F.col("text"))
    docs = docs.select(F.col("doc_id").alias("idx"), F.translate("text", "q", QAF).alias("text"), sounds.alias("phonemes"))
    rows = docs.unionByName(spark.createDataFrame([(-1 - k, t, p) for k, (t, p) in enumerate(SPOKEN)], "idx long, text string, phonemes string"))
    return frontend.phonemized(rows, F.array(*map(F.lit, LEXICON)))


@query(SPEECH + "SELECT idx, CASE WHEN silent THEN '' WHEN NOT uneven THEN said END AS spoken, NOT silent AND uneven AS misaligned, CASE WHEN silent THEN 0 ELSE n END AS n_words, q AS n_q_words, kept AS n_q_kept FROM spoken")
def dialect_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _phonemized(spark, sf_dir).select("idx", "spoken", "misaligned", "n_words", "n_q_words", "n_q_kept")


@query(
    SPEECH
    + f"""SELECT count(*) AS sentences, CAST(0 AS BIGINT) AS errors, CAST(sum(CASE WHEN silent THEN 0 ELSE n END) AS BIGINT) AS words, CAST(sum(q) AS BIGINT) AS q_words, CAST(sum(kept) AS BIGINT) AS q_kept, CAST(sum(q - kept) AS BIGINT) AS q_rewritten,
  count(*) FILTER (NOT silent AND uneven) AS misaligned_sentences, CAST(sum(len(regexp_extract_all({UNCITED.replace("text", "said.text")}, '[A-Za-z]+'))) AS BIGINT) AS latin_dropped FROM spoken JOIN said USING (idx)"""
)
def frontend_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frontend.counters(_phonemized(spark, sf_dir))


GATES = {"letters": ("true", "symbol NOT IN (SELECT chr(CAST(c AS INTEGER)) FROM range(97, 123) t(c))"), "all": ("true", "false"), "aligned": ("silent OR NOT uneven", "false")}


@query(
    SPEECH
    + ", said_rows AS (SELECT silent, uneven, CASE WHEN silent THEN '' WHEN NOT uneven THEN said END AS spoken FROM spoken), gated AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS gate, (SELECT count(*) FROM (SELECT unnest(string_split(spoken, '')) AS symbol FROM said_rows WHERE {rows}) WHERE symbol <> '' AND {missing}) AS oov, "
        f"(SELECT count(*) FROM said_rows WHERE ({rows}) AND NOT silent AND uneven) AS misaligned, (SELECT count(*) FROM said_rows WHERE {rows}) AS sentences"
        for name, (rows, missing) in GATES.items()
    )
    + ") SELECT *, CASE WHEN oov > 0 THEN 'FAIL' WHEN misaligned > 0.05 * sentences THEN 'WARN' ELSE 'PASS' END AS verdict FROM gated"
)
def frontend_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate with a vocabulary of letters, with one of all that is spoken, and with the latter over aligned rows."""
    rows = frontend.tallied(_phonemized(spark, sf_dir))
    letters = spark.range(97, 123).select(F.char("id").alias("symbol"))
    spoken = rows.select("symbol").distinct()
    aligned = rows.filter(~F.col("misaligned"))
    gates = [frontend.tallied_gate(x, v).withColumn("gate", F.lit(name)) for name, x, v in (("letters", rows, letters), ("all", rows, spoken), ("aligned", aligned, spoken))]
    return pools.union_by_name(*gates)


#: A letter of Arabic script for each from a to z, and the phonemizer that says it so: a stand-in for an external one.
SCRIPT = "ابجدهوزحطيكلمنسعقفصرشتثخذض"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


class Speller:
    """Says each letter, merges a word of one alef with the next word, and can't say the at sign."""

    def __init__(self):
        self.sounds = str.maketrans(SCRIPT, LETTERS)
        self.merged = re.compile(f"(^| ){SCRIPT[0]} ")

    def __call__(self, texts: list[str]) -> list[str]:
        if any("@" in t for t in texts):
            raise ValueError("no sound for @")
        return [self.merged.sub(rf"\1{SCRIPT[0]}", t).translate(self.sounds) for t in texts]


PREPARED = _squeeze(f"regexp_replace({UNCITED}, '[A-Za-z]+', ' ', 'g')")
FRONTEND = (
    f"""WITH given AS (SELECT doc_id AS idx, translate(text, '{LETTERS}', '{SCRIPT}') AS text FROM documents),
ready AS (SELECT idx, {PREPARED} AS prepared FROM given),
lists AS (SELECT *, string_split(prepared, ' ') AS w, string_split(translate({UNDOTTED.replace(DOTTED, f"translate(prepared, '{SCRIPT}', '{LETTERS}')")}, '{PHONEME_NOISE}', ''), ' ') AS p, contains(prepared, '@') AS failed FROM ready),
keeping AS (SELECT *, list_transform(range(1, len(w) + 1), lambda i: contains(w[i], '{QAF}') AND (list_contains({LEXICON}, {BARE.replace("@", "w[i]")}) OR (i > 1 AND list_contains({list(text.SURA_TRIGGERS)}, {BARE.replace("@", "w[i - 1]")})))) AS k FROM lists),
said AS (SELECT idx, prepared, failed, prepared = '' AS silent, len(w) AS n, len(list_filter(w, lambda x: contains(x, '{QAF}'))) AS q, len(list_filter(k, lambda x: x)) AS kept,
  array_to_string(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN k[i] THEN p[i] ELSE replace(p[i], 'q', '{text.DIALECT_G}') END), ' ') AS spoken FROM keeping)
"""
    f"SELECT idx, prepared, CASE WHEN failed THEN '' ELSE spoken END AS spoken, CASE WHEN failed THEN 'ValueError: no sound for @' END AS error, NOT failed AND regexp_matches(prepared, '(^| ){SCRIPT[0]} ') AS misaligned, "
    "CASE WHEN failed OR silent THEN 0 ELSE n END AS n_words, CASE WHEN failed THEN 0 ELSE q END AS n_q_words, CASE WHEN failed THEN 0 ELSE kept END AS n_q_kept FROM said"
)


@query(FRONTEND)
def phonemize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole front-end over all documents, their small letters in Arabic script, with a stand-in for the model."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("idx"), F.translate("text", LETTERS, SCRIPT).alias("text"))
    rows = frontend.phonemize(docs, Speller, F.array(*map(F.lit, LEXICON)))
    return rows.select("idx", "prepared", "spoken", "error", "misaligned", "n_words", "n_q_words", "n_q_kept")


class Striper:
    """Means of every fourth sample from the first to the fourth on, over each wave's own length; needs eight samples."""

    def __call__(self, padded: np.ndarray, shares: np.ndarray) -> np.ndarray:
        lengths = np.rint(shares * padded.shape[1])
        if (lengths < 8).any():
            raise ValueError("too short")
        return np.stack([padded[:, k::4].sum(axis=1, dtype=np.float64) / lengths for k in range(4)], axis=1)


@query()
def encode_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of waves of unlike lengths: each embedding's first components, with a stand-in for the encoder."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.select("vec_id", F.slice("embedding", 1, (F.col("vec_id") % 60).cast("int")).alias("wave"))
    return rows.select("vec_id", models.encoded(F.col("wave"), Striper).alias("e")).select("vec_id", "e.vector", "e.error")


@query(f"SELECT doc_id, len(list_filter(w, lambda x, i: i > 1 AND x = w[i - 1])) AS repeats FROM (SELECT doc_id, list_filter(string_split({_squeeze('text')}, ' '), lambda x: x <> '') AS w FROM documents)")
def repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that equal the word before."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", text.tokens(F.col("text")).alias("w"))
    same = F.zip_with("w", text.previous_words(F.col("w")), lambda x, y: x == y)
    return rows.select("doc_id", F.size(F.filter(same, lambda x: x)).cast("long").alias("repeats"))


def _marked(c: Column) -> Column:
    """A text's words but each fifth, with a mark after every vowel."""
    marked = F.transform(text.tokens(c), lambda w: F.regexp_replace(w, "([aeiou])", "$1\u064e"))
    return F.array_join(F.filter(marked, lambda _, i: i % 5 != 4), " ")


@query()
def recover_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of talk as bare text, with marks after every vowel of all words but each fifth as the marked one."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "text")
    found = rows.withColumn("r", alignment.recover_marks(F.col("text"), _marked(F.col("text")), F.lit(None).cast("string")))
    return found.select("conv_id", "turn", F.crc32("r.text").alias("text_crc32"), F.round("r.coverage", 6).alias("coverage"))


@query()
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns of talk, with qaf for q, marks as in ``recover_marks`` and older ones on each third word; and the literals with their own marks."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.translate("text", "q", QAF).alias("text"))
    older = F.transform(text.tokens(F.col("text")), lambda w, i: F.when(i % 3 == 0, F.regexp_replace(w, "([aeiou])", "$1\u064e")).otherwise(w))
    turns = turns.withColumns({"text_tashkeel_raw": _marked(F.col("text")), "text_tashkeel": F.array_join(older, " ")})
    own = spark.createDataFrame([(t,) for t in ARABIC], "text string").select(text.undiacritize(F.col("text")).alias("text"), F.col("text").alias("text_tashkeel_raw"), F.lit("").alias("text_tashkeel"))
    rows = turns.unionByName(own).withColumn("coverage", F.lit(0.5))
    return rounded(frontend.coverage_report(rows))


@query()
def chunk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    chunks = alignment.chunk_text(F.col("text"), 120, "abcdefghijklmnopqrstuvwxyz ")
    return rows.select("doc_id", F.posexplode(chunks).alias("idx", "c")).select("doc_id", "idx", "c.text", "c.kind")


# Measures of sound and what they say ---------------------------------------------------------------------------------

#: Measures of files by rule: every event is one, and the events of odd users are the reference's.
MEASURES = """
SELECT event_id, user_id % 2 = 1 AS of_ref, value / 490.0D AS dead_frac, -60.0D + event_id % 70 AS high_low_db, (event_id % 11) / 10.0D AS flatness,
       1.0D + event_id % 13 AS pkmean_8_9k, 1.0D + event_id % 17 AS pkmean_9_10k, 1.0D + event_id % 5 AS pkmean_10_11k, 1.0D + event_id % 3 AS pkmean_11_12k,
       1.0D + event_id % 9 AS pkmean_8_10k, 1.0D + event_id % 4 AS pkmean_10_12k, -30.0D - event_id % 40 AS db_8_10k
FROM events"""
METRICS = ["dead_frac", "high_low_db", "flatness", *verdicts.TONAL, "pkmean_8_10k", "pkmean_10_12k", "db_8_10k"]
MEASURED = "WITH m AS (" + views.duckdb_numbers(MEASURES) + "), r AS (SELECT " + ", ".join(f"avg({c}) AS ref_{c}" for c in METRICS) + " FROM m WHERE of_ref)"


def _measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MEASURES.replace("FROM events", "FROM {events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))


def _with_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file's measures, with the reference's means."""
    rows = _measures(spark, sf_dir)
    means = verdicts.mean_metrics(rows.filter("of_ref"), METRICS).select(*(F.col(c).alias(f"ref_{c}") for c in METRICS))
    return rows.join(F.broadcast(means))


@query(
    MEASURED
    + """ SELECT event_id, CASE WHEN dead_frac > 0.5 OR high_low_db < -45 THEN 'ZEROED'
  WHEN pkmean_8_9k > greatest(3 * ref_pkmean_8_9k, 6) OR pkmean_9_10k > greatest(3 * ref_pkmean_9_10k, 6) OR pkmean_10_11k > greatest(3 * ref_pkmean_10_11k, 6) OR pkmean_11_12k > greatest(3 * ref_pkmean_11_12k, 6) THEN 'TONAL'
  WHEN flatness > 0.6 AND high_low_db > ref_high_low_db + 6 THEN 'HISSING' ELSE 'STRUCTURED' END AS verdict FROM m, r"""
)
def band_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_reference(spark, sf_dir).select("event_id", verdicts.band_verdict().alias("verdict"))


@query(MEASURED + " SELECT event_id, CASE WHEN greatest(pkmean_8_10k / ref_pkmean_8_10k, pkmean_10_12k / ref_pkmean_10_12k) > 2 THEN 'BUZZ' WHEN db_8_10k - ref_db_8_10k < -20 THEN 'DEAD' ELSE 'OK' END AS verdict FROM m, r")
def bandwidth_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_reference(spark, sf_dir).select("event_id", verdicts.bandwidth_verdict().alias("verdict"))


@query(MEASURED + ", v AS (SELECT " + ", ".join(f"avg({c}) AS {c}" for c in METRICS) + " FROM m WHERE NOT of_ref) " + " UNION ALL ".join(f"SELECT '{c}' AS metric, round({c}, 6) AS value, round(ref_{c}, 6) AS ref FROM v, r" for c in METRICS))
def against_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _measures(spark, sf_dir)
    run, ref = (verdicts.mean_metrics(rows.filter(c), METRICS).unpivot([], METRICS, "metric", "value") for c in ("not of_ref", "of_ref"))
    return rounded(verdicts.against_reference(run, ref))


@query("SELECT count(*) AS pieces, round(median(value / greatest(user_id / 10.0::DOUBLE, 1e-6)), 6) AS median_rtf, max(user_id / 10.0::DOUBLE) AS longest FROM events")
def synthesis_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("value").alias("seconds"), (F.col("user_id") / 10.0).alias("dur"))
    return rounded(scoring.synthesis_report(rows))


@query("SELECT bool_and(n_chars >= 0 AND text IS NOT NULL) AS passed FROM documents")
def preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts.preflight(spark.read.parquet(f"{sf_dir}/documents.parquet").select((F.col("text").isNotNull() & (F.col("n_chars") >= 0)).alias("ok")))


@query("SELECT doc_id, coalesce(lang, '') AS lang FROM documents WHERE text <> '' AND n_chars + 2 <= 510")
def within_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").filter(quality.has_text("text") & quality.within_budget("n_chars"))
    return quality.filled(rows.select("doc_id", "lang"), "lang")


@query(GOOD + " SELECT f.audio_file, g.speaker, f0_median FROM features f JOIN good g USING (audio_file) WHERE NOT isnan(f0_median)")
def keep_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.features(spark, sf_dir).filter(~F.isnan("f0_median"))
    return cohort.keep_selected(rows, quality.row_quality(views.clips(spark, sf_dir))).select("audio_file", "speaker", "f0_median")


WAVES = "WITH waves AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)"


@query(WAVES + ", tops AS (SELECT vec_id, v, list_max(list_transform(v, lambda x: abs(x))) AS top FROM waves) SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(x / top * 0.95, 6) AS x FROM (SELECT vec_id, top, unnest(v) AS x, unnest(range(len(v))) AS pos FROM tops WHERE top >= 1e-5)")
def peak_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as short waves."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter(quality.audible("embedding"))
    return rounded(rows.select("vec_id", F.posexplode(vectors.peak_normalize(F.col("embedding"))).alias("pos", "x")))


@query(WAVES + " SELECT vec_id, CAST(k // 4 AS INTEGER) AS frame, round(list_sum(v[k + 1 : k + 16]), 6) AS total FROM (SELECT vec_id, v, unnest(range(0, len(v) - 15, 4)) AS k FROM waves)")
def frame_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    rows = rows.select("vec_id", F.posexplode(vectors.frames(F.col("v"), 16, 4)).alias("frame", "f"))
    return rounded(rows.select("vec_id", "frame", F.aggregate("f", F.lit(0.0), lambda t, x: t + x).alias("total")))


PAUSED = ", ".join(f"('{k}', {int(v * audio.RATE)})" for k, v in audio.PAUSES.items())
SMOOTHED = "list_transform(range(1, len(v) + 1), lambda i: (v[i] + CASE WHEN i > 1 THEN v[i - 1] ELSE 0 END) / 2)"
POWER = "list_sum(list_transform({0}, lambda x: x * x)) / len({0})"


@query(WAVES + f", smooth AS (SELECT vec_id, v, {SMOOTHED} AS s FROM waves) SELECT vec_id, kind, len(v) + n AS samples, round({POWER.format('s')} / greatest({POWER.format('v')}, 1e-20), 6) AS kept FROM smooth JOIN (VALUES {PAUSED}) p(kind, n) ON kind = ['ellipsis', 'stop', 'comma', 'forced'][vec_id % 4 + 1]")
def pauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as waves with a pause by kind, and the power that a mean of each sample and the one before keeps."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("v", F.transform("embedding", lambda x: x.cast("double")))
    kind = F.element_at(F.array(*map(F.lit, ("ellipsis", "stop", "comma", "forced"))), (F.col("vec_id") % 4 + 1).cast("int"))
    smooth = F.transform("v", lambda x, i: (x + F.coalesce(F.get("v", i - 1), F.lit(0.0))) / 2)
    rows = rows.withColumns({"kind": kind, "smooth": smooth})
    return rounded(rows.select("vec_id", "kind", F.size(audio.with_pause(F.col("embedding"), F.col("kind"))).cast("long").alias("samples"), audio.retained_power(F.col("smooth"), F.col("v")).alias("kept")))


def _sounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wave of 3,000 samples or more for each vector: its components again and again, each time by another gain, with silence around."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", (F.col("vec_id") % 500).cast("int").alias("quiet"))
    gain = lambda i: ((i * 7919) % 101 - 50) / 50.0
    loud = F.transform(F.sequence(F.lit(0), F.lit(2999)), lambda i: (F.get("embedding", i % F.size("embedding")) * gain(i)).cast("float"))
    silence = F.array_repeat(F.lit(0.0).cast("float"), F.col("quiet"))
    return rows.select("vec_id", F.concat(silence, loud, silence).alias("wave"))


@query()
def band_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_sounds(spark, sf_dir).select("vec_id", audio.band_profile(F.col("wave")).alias("m")).select("vec_id", "m.*").drop("ok"))


@query()
def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_sounds(spark, sf_dir).select("vec_id", audio.bands(F.col("wave")).alias("m")).select("vec_id", "m.*").drop("ok"))


@query()
def trim_silence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many samples are left of each wave, the sum of their amounts and the places of their first and last loud ones."""
    trimmed = audio.trim_silence(F.col("wave"))
    rows = _sounds(spark, sf_dir).select("vec_id", F.size("wave").alias("samples"), trimmed.alias("t"))
    total = F.aggregate("t", F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))
    return rows.select("vec_id", "samples", F.size("t").alias("kept"), F.round(total, 3).alias("total"))


#: Clips of videos by rule: every event is one, twenty users share a video, and every thirtieth has no end.
CLIPPED = """
SELECT event_id, concat('v', user_id % 20) AS video_id, (event_id * 7919 % 100003) / 4.0D AS start,
       CASE WHEN event_id % 30 <> 7 THEN (event_id * 7919 % 100003) / 4.0D + value / 8.0D END AS finish
FROM events"""


@query(
    "WITH clips AS ("
    + views.duckdb_numbers(CLIPPED)
    + """), sound AS (SELECT * FROM clips WHERE start <= finish),
reached AS (SELECT *, max(finish) OVER (PARTITION BY video_id ORDER BY start, finish, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM sound),
numbered AS (SELECT *, sum(CASE WHEN reach IS NULL OR start >= reach THEN 1 ELSE 0 END) OVER (PARTITION BY video_id ORDER BY start, finish, event_id) - 1 AS island FROM reached)
SELECT video_id, CAST(island AS BIGINT) AS island, count(*) AS clips, round(min(start), 6) AS start, round(max(finish), 6) AS finish, round(sum(finish - start), 6) AS seconds FROM numbered GROUP BY video_id, island
UNION ALL SELECT video_id, NULL, count(*), round(min(start), 6), NULL, NULL FROM clips WHERE finish IS NULL GROUP BY video_id"""
)
def clip_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping clips of a video as islands, with what they cover; clips without an end are apart."""
    rows = spark.sql(CLIPPED.replace("FROM events", "FROM {events}"), events=spark.read.parquet(f"{sf_dir}/events.parquet"))
    found = scans.islands(rows, "video_id", "start", "finish", "event_id")
    return rounded(found.groupBy("video_id", "island").agg(F.count("*").alias("clips"), F.min("start").alias("start"), F.max("finish").alias("finish"), F.sum(F.col("finish") - F.col("start")).alias("seconds")))


# Files -----------------------------------------------------------------------------------------------------------


def _fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    WITH
    + """SELECT audio_file, speaker, duration, CASE WHEN CAST(audio_file AS BIGINT) % 3 <> 0 THEN snr_db END AS snr_db, CASE WHEN CAST(audio_file AS BIGINT) % 3 = 0 THEN coverage END AS coverage, CAST(NULL AS VARCHAR) AS shard FROM clips"""
)
def read_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clips written as shards of unlike columns, two thirds without ``coverage`` and one without ``snr_db``, and read as one corpus."""
    root, clips = _fresh_folder(spark, "shards"), views.clips(spark, sf_dir)
    third = F.col("audio_file").cast("long") % 3 == 0
    sinks.write_table(clips.filter(~third).drop("coverage"), f"{root}/a")
    sinks.write_table(clips.filter(third).drop("snr_db", "music_score"), f"{root}/b")
    return corpus.shards(spark, root, "part").select("audio_file", "speaker", "duration", "snr_db", "coverage", "shard")


#: A file of sentences by rule: each turn's role, a tab and its text, with comments and lines without a tab between.
SENTENCES = "CASE WHEN turn % 7 = 3 THEN '# ' || role || chr(9) || {0} WHEN turn % 7 = 5 THEN {0} ELSE role || chr(9) || {0} || CASE WHEN turn % 2 = 0 THEN chr(9) || 'more' ELSE '' END END"
ONE_LINE = "replace(replace(text, chr(10), ' '), chr(13), ' ')"
TRIMMED = "trim({0}, ' ')"


@query(f"WITH l AS (SELECT {SENTENCES.format(ONE_LINE)} AS line FROM conversations) SELECT {TRIMMED.format('string_split(line, chr(9))[1]')} AS category, {TRIMMED.format('substr(line, strpos(line, chr(9)) + 1)')} AS text FROM l WHERE NOT starts_with(line, '#') AND contains(line, chr(9))")
def evaluation_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns written as tab-separated sentences and read again: comments and lines without a tab go, the first tab parts."""
    path = _fresh_folder(spark, "sentences")
    lines = spark.read.parquet(f"{sf_dir}/conversations.parquet").select(F.expr(SENTENCES.format(ONE_LINE)).alias("line"))
    sinks.write_lines(lines, path)
    return corpus.evaluation_set(spark, path)


SAMPLED = "list_transform(embedding, lambda x: CAST(trunc(greatest(least(CAST(x AS DOUBLE), 1), -1) * 32767) AS BIGINT))"


@query(f"SELECT 's' || (vec_id % 20) AS speaker, CAST(vec_id AS VARCHAR) AS stem, len(embedding) AS samples, CAST(list_sum({SAMPLED}) AS BIGINT) AS total, list_max({SAMPLED}) AS top FROM embeddings WHERE vec_id % 13 <> 0")
def sound_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors written as one sound file each below their speaker's folder, and the folders read again."""
    path = _fresh_folder(spark, "sounds")
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.select(F.concat(F.lit("s"), F.col("vec_id") % 20).alias("speaker"), F.concat(F.lit("clips/"), F.col("vec_id").cast("string"), F.lit(".flac")).alias("audio_file"), F.when(F.col("vec_id") % 13 != 0, F.col("embedding")).alias("samples"))
    sinks.write_sounds(rows, path)
    sound = F.transform("samples", lambda x: F.round(x.cast("double") * 32768).cast("long"))
    found = corpus.wav_directory(spark, f"{path}/s*").select(F.split("path", "/").alias("p"), sound.alias("x"))
    return found.select(F.element_at("p", -2).alias("speaker"), text.stem(F.element_at("p", -1)).alias("stem"), F.size("x").cast("long").alias("samples"), F.aggregate("x", F.lit(0).cast("long"), lambda t, x: t + x).alias("total"), F.array_max("x").alias("top"))


# Scoring ---------------------------------------------------------------------------------------------------------

#: Letters beyond ASCII of the tables' texts; DuckDB's levenshtein counts bytes, so each becomes one ASCII byte that no normalised text has.
ACCENTED = "éèêçäöüßáíóúñÉÈÊÇÄÖÜÁÍÓÚÑàâîôûë"
STAND_INS = "".join(map(chr, [*range(1, 9), *range(14, 32)])) + "()[]{}"
NORMED = _squeeze(_fold("translate(" + _no_marks("{0}") + ", '" + WER_PUNCTUATION.replace("'", "''") + "', '" + " " * len(WER_PUNCTUATION) + "')"))
WORDS = "list_filter(string_split({0}, ' '), lambda x: x <> '')"
SCORED = (
    WITH.replace("WITH ", "WITH RECURSIVE ", 1)
    + f""", normed AS (SELECT idx, category, {NORMED.replace("{0}", "ref")} AS r, {NORMED.replace("{0}", "hyp")} AS h FROM pairs WHERE ref IS NOT NULL AND hyp IS NOT NULL),
listed AS (SELECT *, {WORDS.format("r")} AS a, {WORDS.format("h")} AS b FROM normed),
dp AS (SELECT idx, 0 AS i, range(0, len(b) + 1) AS line FROM listed
  UNION ALL
  SELECT idx, i + 1, list_reduce(range(1, len(b) + 1), lambda cur, j: list_append(cur, least(line[j + 1] + 1, cur[j] + 1, line[j] + CASE WHEN a[i + 1] <> b[j] THEN 1 ELSE 0 END)), [line[1] + 1])
  FROM dp JOIN listed USING (idx) WHERE i < len(a)),
edits AS (SELECT idx, line[len(b) + 1] AS word_edits FROM dp JOIN listed USING (idx) WHERE i = len(a)),
scored AS (SELECT idx, category, r, word_edits, CAST(len(a) AS BIGINT) AS words, CAST(length(r) AS BIGINT) AS chars,
  levenshtein(translate(r, '{ACCENTED}', '{STAND_INS[: len(ACCENTED)]}'), translate(h, '{ACCENTED}', '{STAND_INS[: len(ACCENTED)]}')) AS char_edits FROM listed JOIN edits USING (idx))
"""
)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scored(views.pairs(spark, sf_dir))


@query(SCORED + "SELECT idx, word_edits, char_edits, words, chars, round(word_edits / greatest(words, 1), 6) AS wer FROM scored")
def edit_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_scored(spark, sf_dir).select("idx", "word_edits", "char_edits", "words", "chars", "wer"))


@query(
    SCORED
    + f"""SELECT count(*) AS pairs, round(sum(word_edits) / greatest(sum(words), 1), 6) AS wer, round(sum(char_edits) / greatest(sum(chars), 1), 6) AS cer,
  round(coalesce(sum(word_edits) FILTER (r NOT LIKE '%{QAF}%'), 0) / greatest(coalesce(sum(words) FILTER (r NOT LIKE '%{QAF}%'), 0), 1), 6) AS wer_no_q FROM scored"""
)
def wer_cer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scoring.error_rates(_scored(spark, sf_dir)))


@query(SCORED + "SELECT category, round(sum(word_edits) / greatest(sum(words), 1), 6) AS wer, CAST(sum(words) AS BIGINT) AS words FROM scored GROUP BY category")
def wer_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scoring.by_category(_scored(spark, sf_dir)))


@query(SCORED + "SELECT round(sum(word_edits) / greatest(sum(words), 1), 6) AS wer, CAST(0.35 AS DOUBLE) AS threshold, sum(word_edits) / greatest(sum(words), 1) > 0.35 AS abort FROM scored")
def wer_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(scoring.wer_gate(_scored(spark, sf_dir), 0.35))
