"""Session helper and table loading."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench; on a cluster the session is given."""
    cores = cores or os.cpu_count() or 4
    conf = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory,
    }
    spark = SparkSession.builder.master(f"local[{cores}]").appName("foliant").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
