"""What the plans must have: pruned columns, pushed filters, early limits, no Python where none is needed."""

import re

import pytest
from pyspark.sql import functions as F

from quernstone.operators import pools, quality
from quernstone.plans import views
from quernstone.plans.registry import QUERIES

PYTHON = {"pair_cosine", "recover_marks", "coverage_report", "chunk_text", "phonemize", "encode_clips", "edit_distance", "wer_cer", "wer_by_category", "wer_gate", "band_profile", "bands", "trim_silence", "speaker_verdict", "sound_files"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - PYTHON))
def test_no_python(spark, sf_dir, name):
    assert not re.search("Python|Pandas|Arrow", plan(QUERIES[name](spark, sf_dir)))


def test_columns_are_pruned(spark, sf_dir):
    text = plan(quality.retention_report(views.clips(spark, sf_dir)))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in text and "ReadSchema: struct<doc_id:bigint,quality:int,toxic:int>" in text


def test_filters_are_pushed(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang").filter(F.col("lang") == "de")
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,de)]" in plan(pools.sample(rows, "doc_id", 10))


def test_caps_come_before_the_shuffle(spark, sf_dir):
    text = plan(pools.cap_per_key(views.features(spark, sf_dir), "speaker", "audio_file"))
    assert "WindowGroupLimit" in text.split("Exchange")[-1]


def test_rejection_is_an_anti_join(spark, sf_dir):
    text = plan(QUERIES["rejected"](spark, sf_dir))
    assert "LeftAnti" in text and not re.search("NestedLoop|Cartesian", text)


def test_pairs_of_centroids_meet_by_blocks(spark, sf_dir):
    assert not re.search("NestedLoop|Cartesian", plan(QUERIES["centroid_pairs"](spark, sf_dir)))
