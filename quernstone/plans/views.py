"""Stand-ins for a speech corpus, made of the test tables by rule, in Spark and as DuckDB SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Clips: documents as clips, sources as speakers, languages as videos, labels as measurements that are often missing.
CLIPS = """
SELECT CAST(d.doc_id AS {string}) AS audio_file, d.source AS speaker, d.lang AS video_id, d.n_chars / 200.0D AS duration, d.text AS text,
       CASE WHEN l.quality IS NOT NULL THEN 15.0D + 10 * l.quality END AS snr_db,
       CASE WHEN l.toxic IS NOT NULL THEN 4.5D - 0.5D * l.toxic END AS squim_mos,
       CASE WHEN l.toxic IS NOT NULL THEN 0.02D + 0.04D * (d.doc_id % 2) END AS music_score,
       CASE WHEN d.doc_id % 5 <> 0 THEN (d.doc_id % 12) / 100.0D END AS cer_yt_vs_cohere,
       CASE WHEN d.doc_id % 3 <> 0 THEN 0.7D + (d.doc_id % 7) / 20.0D END AS coverage,
       CASE WHEN l.toxic IS NOT NULL THEN l.toxic = 1 END AS boundary_clipped
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

#: Features: an event's value and user as its clip's pitch, every tenth of them not measured (NaN).
FEATURES = """
SELECT CAST(event_id AS {string}) AS audio_file, concat('src', user_id % 20) AS speaker, concat('v', user_id) AS video_id,
       CASE WHEN event_id % 10 = 0 THEN CAST('NaN' AS DOUBLE) ELSE 60.0D + value / 4.0D + 8 * (user_id % 20) END AS f0_median
FROM events"""

#: Speakers' vectors: twenty speakers over the embeddings.
VECTORS = "SELECT vec_id, concat('src', vec_id % 20) AS speaker, embedding AS ecapa, label FROM embeddings"

#: References and hypotheses: a turn and the next of its conversation, and a turn and itself with words left out.
PAIRS = """
SELECT a.conv_id * 1000 + a.turn AS idx, array_join({slice}, ' ') AS ref, array_join({other}, ' ') AS hyp, a.role AS category
FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
UNION ALL
SELECT 1000000000 + a.conv_id * 1000 + a.turn, array_join({slice}, ' '), array_join({dropped}, ' '), concat(a.role, '-near')
FROM conversations a"""

_SPARK = {
    "string": "STRING",
    "slice": "split(a.text, ' ')",
    "other": "split(b.text, ' ')",
    "dropped": "filter(split(a.text, ' '), (w, i) -> i % 7 <> 3)",
}
_DUCKDB = {
    "string": "VARCHAR",
    "slice": "string_split(a.text, ' ')",
    "other": "string_split(b.text, ' ')",
    "dropped": "list_filter(string_split(a.text, ' '), lambda w, i: i % 7 <> 4)",
}


def _duckdb(sql: str) -> str:
    return duckdb_numbers(sql.format(**_DUCKDB).replace("array_join(", "array_to_string("))


def duckdb_numbers(sql: str) -> str:
    """Spark's double literals as DuckDB has them."""
    return re.sub(r"([0-9.]+)D\b", r"CAST(\1 AS DOUBLE)", sql)


#: The views as the head of a DuckDB query.
WITH = "WITH " + ",\n".join(f"{name} AS ({_duckdb(sql)})" for name, sql in (("clips", CLIPS), ("features", FEATURES), ("vectors", VECTORS), ("pairs", PAIRS))) + "\n"


def _run(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    sources = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    sql = sql.format(**_SPARK)
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return spark.sql(sql, **sources)


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, CLIPS, "documents", "labels")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, FEATURES, "events")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, VECTORS, "embeddings")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, PAIRS, "conversations")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, so that sums in any order compare equal."""
    return df.select(*(F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))
