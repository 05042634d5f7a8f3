"""Session defaults. Only what a deployment leaves unset is chosen here."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str = "weftline", cores: int | None = None, **more: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own settings."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    conf = {
        "spark.master": f"local[{cores}]",
        "spark.app.name": name,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("WEFTLINE_DRIVER_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | more
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
