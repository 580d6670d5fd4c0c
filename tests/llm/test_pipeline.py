from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from quernstone.llm import decontam, langid, quality
from quernstone.llm.common import cut_lineage, table
from test_dealing import check_pieces
from test_decontam import brute, shingles, words_of
from test_simhash import edited_copies, similar


def test_run_matches_its_stages_by_brute_force(spark, sf_dir):
    """Each stage by plain code, with its own shingles, weights and rules; the learnt models alone are the operators'."""
    from pyspark.sql import functions as F

    docs = table(spark, sf_dir, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    voters = quality.fit(docs, table(spark, sf_dir, "labels"))
    kept = {d for d, t in texts.items() if voters.score(voters.latent(*quality.term_counts(t.encode()))[None])[0] >= 0.3}
    good = docs.filter(F.col("doc_id").isin(sorted(kept)))
    net = langid.fit(good)
    tables = net.pairs()

    def certainty(text):
        raw = text.encode()
        parts = langid.windows(raw)
        weights = [len(raw[k * langid.WINDOW : (k + 1) * langid.WINDOW]) for k in range(len(parts))]
        return (np.average(net.probabilities(parts, tables), axis=0, weights=weights)).max()

    kept = {d for d in kept if any(c.isalpha() for c in texts[d]) and certainty(texts[d]) >= 0.4}
    groups = similar([(d, texts[d]) for d in sorted(kept)])
    kept = {d for d in kept if groups[d] == d}
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    leaked = {d for d, _ in brute([(d, texts[d]) for d in kept], items)}
    want = kept - leaked - {d for d in kept if any(shorter(texts[d], t) for _, t in items)}
    pieces = corpus_pipeline.run(spark, sf_dir).withColumn("ids_crc32", F.crc32("ids")).collect()
    assert {r.doc_id for r in pieces} == want and leaked
    check_pieces(pieces, {d: texts[d] for d in want})


def shorter(text, item):
    """Whether a text shorter than the item is nearly all of it."""
    w, v = words_of(text), words_of(item)
    if not 5 <= len(w) < len(v):
        return False
    a, b = Counter(shingles(w)), Counter(shingles(v))
    return (a & b).total() / (a | b).total() >= 0.8


def test_very_long_and_odd_texts_go_through_all_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    clean = decontam.uncontaminated(docs.filter("lang = 'en' and n_chars > 300"), table(spark, sf_dir, "benchmark"), similarity=0.3)
    long = " ".join(r.text for r in clean.limit(60).collect())
    odd = [(10**6, long), (10**6 + 1, long + " and an end."), (10**6 + 2, "x" * 300_000), (10**6 + 3, None), (10**6 + 4, "")]
    rows = docs.limit(80).unionByName(spark.createDataFrame([(i, t, "en", "s", None) for i, t in odd], docs.schema))
    for name, stage in corpus_pipeline.STAGES:
        rows = cut_lineage(stage(spark, rows, sf_dir))
    assert {10**6, 10**6 + 1} & {r.doc_id for r in rows.collect()} == {10**6}


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", "en", None, 0), (2, "A text of some words.", None, "s", 3), (2, "A text of some words.", None, "s", 3)]])
def test_stages_with_odd_rows(spark, sf_dir, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        got = out.collect()
        assert out.columns == docs.columns or name == "packing"
        if name == "near_duplicates":
            assert sorted(got, key=repr) == sorted(docs.collect(), key=repr)
        if name in ("quality", "decontamination"):
            assert len(got) == len(rows)
        if name == "packing":
            assert sum(r.length == r.doc_tokens for r in got) == len(rows)


def test_the_near_duplicate_stage_drops_all_near_copies(spark):
    texts = edited_copies()
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    want = {i for i, first in similar(texts).items() if i == first}
    assert {r.doc_id for r in corpus_pipeline.keep_one_of_each(spark, docs, "").collect()} == want and len(want) < len(texts) - 30
