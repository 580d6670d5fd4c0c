"""Cutting lineage in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that driver and executors share: the session's ``spark.checkpoint.dir``.

    Where neither that nor a checkpoint folder is set, a local session makes one; on a cluster there is none that
    all machines see, so that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quernstone-"))
    return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a checkpoint in the shared folder.

    Set ``spark.cleaner.referenceTracking.cleanCheckpoints`` to have checkpoints removed when nothing refers to them.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()
