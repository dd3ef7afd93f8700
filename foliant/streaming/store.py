"""Content-addressed store: a key is processed once, in batch or as a stream."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import lexicon as lx


def version(table_model: str = "accurate", ocr: str = "rapidocr") -> str:
    """Pipeline version with a suffix for each engine that is not the default."""
    extra = [f"tf-{table_model}"] * (table_model != "accurate") + [f"ocr-{ocr}"] * (ocr != "rapidocr")
    return ".".join([lx.PIPELINE_VERSION, *extra])


def key(content: Column, pipeline: str) -> Column:
    """SHA-256 of the content, a plus sign, the pipeline version."""
    return F.concat(F.sha2(content, 256), F.lit("+"), F.lit(pipeline))


def admission(text: Column) -> Column:
    """Why a document is not taken in; null if it is."""
    return (
        F.when(text.isNull(), "malformed").when(F.instr(text, "�") > 0, "undecodable").when(F.trim(text) == "", "empty")
    )


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder that driver and executors share (``spark.checkpoint.dir``); a local session may leave that unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = "file://" + tempfile.gettempdir()
    return f"{where.rstrip('/')}/foliant-{label}-{uuid.uuid4().hex}"


class Store:
    """Editions as Parquet, by pipeline version; a key that exists is never written again."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def exists(self) -> bool:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def read(self) -> DataFrame | None:
        return self.spark.read.parquet(self.path) if self.exists() else None

    def unseen(self, rows: DataFrame) -> DataFrame:
        fresh = rows.dropDuplicates(["key"])
        known = self.read()
        return fresh if known is None else fresh.join(known.select("key"), "key", "left_anti")

    def put(self, rows: DataFrame) -> None:
        """Add rows (``key, version, ...``) whose key is new."""
        self.unseen(rows).write.mode("append").partitionBy("version").parquet(self.path)


def ingest(stream: DataFrame, store: Store, pipeline: str, checkpoint: str) -> None:
    """Process what a stream (``id, text``) has and stop; another run takes only what came since."""

    def batch(rows: DataFrame, _: int) -> None:
        keyed = rows.withColumns({"key": key(F.coalesce("text", F.lit("")), pipeline), "version": F.lit(pipeline), "cause": admission(F.col("text"))})
        store.put(keyed)

    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
