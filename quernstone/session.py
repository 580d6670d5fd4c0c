"""SparkSession defaults for tests, the bench and ad-hoc use; jobs on a cluster bring their own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, app: str = "quernstone", **conf: str) -> SparkSession:
    """A local session: UTC, adaptive execution on, few shuffle partitions."""
    cores = cores or os.cpu_count() or 4
    settings = {
        "spark.master": f"local[{cores}]",
        "spark.app.name": app,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "6g",
        "spark.driver.host": "127.0.0.1",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | conf
    return SparkSession.builder.config(map=settings).getOrCreate()
