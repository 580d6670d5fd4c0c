"""A corpus pipeline over ``documents``: quality, language, near duplicates, benchmark passages, packing.

Each stage takes all that the one before kept, as reread from Parquet, and calls one operator of
``quernstone.llm``. The stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm import decontam, langid, packing, quality, simhash
from quernstone.llm.common import shared_folder, table

#: The columns of ``documents``.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document whose language is less likely than this is rejected.
SURE = 0.4


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the quality classifier rejects go.

    Null and empty texts have the share of good labels as their score, repeated rows have equal scores.
    """
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels"))).filter("predicted = 1").select(*COLUMNS)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents without a language, or whose most likely one has a score below ``SURE``, go.

    So null texts and texts without a letter go, and all if no row has a language to learn; repeated rows fare alike.
    """
    found = langid.predict(docs, langid.fit(docs))
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= SURE)).select(*COLUMNS)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the document with the smallest id of each group of near duplicates stays.

    Near duplicates share at least 0.8 of their five-word shingles, as counted, and not only a close fingerprint.
    Null and empty texts have no shingles and are equal to each other, so one of them stays.
    Rows that repeat an id are one document and stay together; rows without an id can't be told apart and stay.
    """
    gone = simhash.near_copies(docs).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents with a passage of the benchmark go. Null and empty texts have none; repeated rows fare alike."""
    return decontam.uncontaminated(docs, table(spark, sf_dir, "benchmark"), uneven=True).select(*COLUMNS)


def pack_all(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: all that is left, as pieces of sequences, with their ids. Null texts are empty; repeated rows are packed each."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good),
    ("language", keep_identified),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_uncontaminated),
    ("packing", pack_all),
]
#: The stages are learnt models, fingerprints and a tokenizer, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.

    Every stage's result is written to the shared folder of ``spark.checkpoint.dir`` and removed when the next
    stage's is there; the last one stays for whoever reads the rows.
    """
    base = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            old = spark._jvm.org.apache.hadoop.fs.Path(before)
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        docs, before = spark.read.parquet(path), path
    return docs
