"""Secret scan over an incremental blob ledger (DataFrame functions only).

Every version of a text is addressed by the SHA-256 of its content.  A ledger table
remembers which (blob, rule version) pairs have been scanned and what they held; a run
scans only pairs that the ledger has not seen and then joins the findings of each blob
back to every path and version that carries it.  Copies, unchanged files and re-runs
therefore cost one hash each; raising one rule's version rescans that rule alone.

Defined results for odd input: a null text counts as empty; a null path is kept as a
path of its own; repeated rows each get their row back (one of them is scanned); a very long text is scanned as
a whole, in time linear in its length; an empty table gives an empty result; further columns of the
input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import digest_spans, find_spans, fresh_dir, let, read_table

SPAN = "struct<start:bigint,rank:int,kind:string,end:bigint>"
LEDGER = f"blob string, rules array<string>, spans array<{SPAN}>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: Java pattern, capture whose length counts, least length."""

    kind: str
    pattern: str
    group: int
    least: int
    version: int = 1
    base: bool = True

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The three base kinds.  Rules with ``base=False`` add spans only.
RULES = (
    Rule("assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, base=False),
    # Entered at the start of a run only, and never given back: linear in the text.
    Rule("jwt", "(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\\.eyJ[A-Za-z0-9_-]{10,}+\\.[A-Za-z0-9_-]{10,}+", 0, 1, base=False),
)


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule; matches whose measured part is too short are dropped."""
    # The scan for a rule's shortest acceptable run is cheap and decides most texts.
    hint = {"hex": "[0-9a-f]{24}", "access": "AKIA[A-Z0-9]{16}"}.get(rule.kind)
    return F.transform(
        F.filter(find_spans(text, rule.pattern, group=rule.group, hint=hint), lambda s: F.length(s["part"]) >= rule.least),
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), s["end"].alias("end")
        ),
    )


def _once(spans: Column) -> Column:
    """A sorted array without repeats (those of runs that scanned the same blob at the same time)."""
    return F.filter(spans, lambda s, i: (i == 0) | (s != F.get(spans, i - 1)))


def scan(
    versions: DataFrame, *, path_col: str = "path", text_col: str = "text", ledger_path: str | None = None, rules=RULES
) -> DataFrame:
    """Scan all versions through the ledger at ``ledger_path`` (a new one if None).

    Returns one row per input row: ``path, blob, spans`` with all spans ordered by
    start, then rule order.  New (blob, rule) scans are appended to the ledger.
    """
    spark = versions.sparkSession
    ledger_path = ledger_path or fresh_dir(spark, "blob-ledger")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    v = versions.select(F.col(path_col).alias("path"), text.alias("text"), F.sha2(text, 256).alias("blob"))

    seen = _read_ledger(spark, ledger_path)
    known = seen.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("known"))
    # One carrier per blob: only its row brings the text to the scan.
    carriers = v.groupBy("blob").agg(F.min("path").alias("path"))
    every = F.array(*[F.lit(r.key) for r in rules])
    pending = (
        carriers.join(known, "blob", "left")
        .withColumn("todo", F.array_except(every, F.coalesce("known", F.array().cast("array<string>"))))
        .filter(F.size("todo") > 0)
        .select(F.col("blob").alias("_blob"), F.col("path").alias("_path"), "todo")
    )
    work = v.join(
        pending,
        (F.col("blob") == F.col("_blob")) & F.col("path").eqNullSafe(F.col("_path")),
    )
    found = F.concat(
        *[
            F.when(F.array_contains("todo", r.key), rule_spans(F.col("text"), r, i)).otherwise(
                F.array().cast(f"array<{SPAN}>")
            )
            for i, r in enumerate(rules)
        ]
    )
    scanned = work.select("blob", F.col("todo").alias("rules"), found.alias("spans")).dropDuplicates(["blob"])
    scanned.write.mode("append").parquet(ledger_path)

    current = [r.key for r in rules]
    keyed = {r.kind: r.key for r in rules}
    findings = (
        _read_ledger(spark, ledger_path)
        # A span counts only from a scan that ran the rule's present version.
        .select(
            "blob",
            F.filter(
                "spans",
                lambda s: F.arrays_overlap(
                    F.array(F.coalesce(*[F.when(s["kind"] == k, F.lit(key)) for k, key in keyed.items()], F.lit(""))),
                    F.col("rules"),
                )
                & s["kind"].isin(*keyed),
            ).alias("spans"),
        )
        .filter(F.size("spans") > 0)
        .groupBy("blob")
        .agg(let(F.sort_array(F.flatten(F.collect_list("spans"))), _once).alias("spans"))
    )
    assert current
    return v.select("path", "blob").join(findings, "blob", "left").select(
        "path", "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans")
    )


def _read_ledger(spark: SparkSession, path: str) -> DataFrame:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def op1_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base counts and digest, and all spans."""
    found = scan(read_table(spark, sf_dir, "documents"), path_col="doc_id")
    base = F.filter("spans", lambda s: s["rank"] < 3)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        F.col("path").alias("doc_id"),
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(digest_spans(base), 256).alias("base_sha256"),
        digest_spans(F.col("spans")).alias("spans"),
    )
