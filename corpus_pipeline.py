"""A corpus pipeline of five training-data operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written and read
again before the next one.  All stages but the last return the columns of ``documents``:

1. ``quality``: texts that the base rule or the robust outlier test rejects go.
2. ``near_duplicates``: groups by five-word shingles at similarity 0.8; the document
   with the smallest id of each group stays.
3. ``personal_data``: spans are replaced by their kind.
4. ``mixture``: documents are taken as often as the source targets ask for.
5. ``packing``: what is left is tokenised and packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import jaccard, mixing, packing, pii
from foliant.llm import quality as rules
from foliant.llm.common import cut, read_table

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an id or without words link with nothing and stay; of rows with one id one stays."""
    groups = jaccard.group(docs, width=5, percent=80)
    gone = cut(groups.filter("doc_id <> component_id").select("doc_id").distinct(), "copies")
    if gone.count() <= jaccard.BROADCAST_IDS:
        gone = F.broadcast(gone)
    left = docs.join(gone, "doc_id", "left_anti")
    repeated = cut(groups.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return left
    once = left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(repeated, "doc_id", "left_anti").unionByName(once).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
