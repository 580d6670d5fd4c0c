"""Native operators run no Python, and the Arrow ones over texts shuffle none."""

import re

import pytest

from quernstone.llm import queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op1_chat", "op10_urls"])
def test_native(spark, sf_dir, name):
    assert not re.search("Python|Pandas|Arrow|NestedLoop|Cartesian", plan(queries.QUERIES[name](spark, sf_dir)))


@pytest.mark.parametrize("name", ["op4_licenses", "op5_language", "op7_packing", "op8_decontamination", "op9_quality"])
def test_texts_stay_where_they_are_read(spark, sf_dir, name):
    text = plan(queries.QUERIES[name](spark, sf_dir))
    assert "Exchange" not in text and text.count("FileScan") == 1
