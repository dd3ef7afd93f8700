"""Admission gates: each turns nodes into outcome rows ``edition, pre, gate, verdict, reason``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicon as lx
from ..functions import equations as eq
from ..functions import text as tx


def outcome(rows: DataFrame, gate: str, verdict: Column | str, reason: Column) -> DataFrame:
    value = F.lit(verdict) if isinstance(verdict, str) else verdict
    return rows.select("edition", "pre", F.lit(gate).alias("gate"), value.alias("verdict"), reason.alias("reason"))


def union(outcomes: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, outcomes)


def running_headers(nodes: DataFrame, least: int = 3, most_words: int = 12) -> DataFrame:
    """Lines that stand, trimmed, on at least three distinct pages of an edition."""
    line = nodes.select("edition", "page", F.explode(F.split("text", "\n")).alias("line")).withColumn("line", F.trim("line"))
    short = F.size(F.filter(F.split("line", r"\s+"), lambda w: w != "")).between(1, most_words)
    return line.filter((F.col("line") != "") & short).groupBy("edition", "line").agg(F.count_distinct("page").alias("pages")).filter(F.col("pages") >= least)


def header_footer(nodes: DataFrame) -> DataFrame:
    """Gate 1: nodes of several lines without the running headers in them, where something stays."""
    heads = running_headers(nodes).groupBy("edition").agg(F.collect_set("line").alias("heads"))
    lines = F.split("text", "\n")
    n = nodes.filter(F.instr("text", "\n") > 0).join(heads, "edition")
    kept = F.filter(lines, lambda x: ~F.array_contains("heads", F.trim(x)))
    n = n.withColumn("kept", kept).withColumn("removed", F.size(lines) - F.size("kept"))
    return n.filter((F.col("removed") > 0) & F.exists("kept", lambda x: F.trim(x) != "")).withColumn("text", F.array_join("kept", "\n")).drop("heads", "kept")


def run_integrity(nodes: DataFrame) -> DataFrame:
    """Gate 2: ``runs`` (array, null if none) must spell out the node's text; digits need runs."""
    raw = F.coalesce("raw_text", "text", F.lit(""))
    none = F.coalesce(F.size("runs"), F.lit(0)) <= 0
    bad = F.when(none & raw.rlike("[0-9]"), "text bears digits but has no runs").when(
        ~none & (tx.compare_form(tx.raw_text(F.col("runs"))) != tx.compare_form(raw)), "text not reconstructible from runs"
    )
    found = nodes.filter(F.trim(raw) != "").withColumn("_why", bad).filter("_why is not null")
    return outcome(found, "run_integrity", "quarantine", F.col("_why"))


def numbering(nodes: DataFrame) -> DataFrame:
    """Gate 3: consecutive numbered siblings; numbers between them that the whole edition lacks."""
    n = nodes.withColumn("parts", tx.numeric_parts(F.col("clause_id"))).filter("parts is not null")
    w = Window.partitionBy("edition", "parent").orderBy("pre")
    head = lambda c: F.slice(c, F.lit(1), F.size(c) - 1)
    n = n.withColumn("prev", F.lag("parts").over(w))
    n = n.filter((F.size("prev") == F.size("parts")) & (head(F.col("prev")) == head(F.col("parts"))))
    n = n.withColumns({"a": F.element_at("prev", -1), "b": F.element_at("parts", -1), "stem": F.array_join(head(F.col("parts")), ".")})
    turned = outcome(n.filter("b <= a"), "numbering", "quarantine", F.concat(F.lit("non-increasing after "), F.array_join("prev", ".")))
    gaps = n.filter("b > a + 1").withColumn("k", F.explode(F.sequence(F.col("a") + 1, F.col("b") - 1)))
    gaps = gaps.withColumn("missing", F.when(F.col("stem") == "", F.col("k").cast("string")).otherwise(F.concat_ws(".", "stem", F.col("k").cast("string"))))
    known = nodes.select("edition", F.array_join(tx.numeric_parts(F.col("clause_id")), ".").alias("missing")).filter("missing is not null").distinct()
    lost = gaps.join(known, ["edition", "missing"], "left_anti").groupBy("edition", "pre").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("k", "missing"))), lambda x: x["missing"]).alias("m")
    )
    return turned.unionByName(outcome(lost, "numbering", "quarantine", F.concat(F.lit("dropped "), F.array_join("m", ","))))


def modal_verbs(nodes: DataFrame) -> DataFrame:
    """Gate 6: the modals of raw and normalised text must be the same, case included."""
    a, b = tx.modals(F.col("raw_text"), F.col("lang")), tx.modals(F.col("normalized_text"), F.col("lang"))
    found = nodes.filter("raw_text is not null and normalized_text is not null").filter(a != b)
    return outcome(found, "modal_verbs", "quarantine", F.lit("modal verbs changed"))


def units(params: DataFrame, run_text: DataFrame) -> DataFrame:
    """Gate 7: per node missing units, missing comparators, and critical symbols lost on the way.
    ``params``: edition, pre, unit, raw_unit, comparator, tol_type; ``run_text``: edition, pre, runs."""
    per_node = params.groupBy("edition", "pre").agg(
        F.max(F.col("unit").isNull()).alias("no_unit"),
        F.max(F.col("comparator").isNull()).alias("no_comparator"),
        F.concat_ws(" ", F.collect_list("raw_unit"), F.collect_list("unit")).alias("blob"),
        F.collect_set("comparator").alias("comparators"),
        F.max(F.col("tol_type").isNotNull()).alias("tolerance"),
    )
    n = per_node.join(run_text, ["edition", "pre"], "left")
    structural = {"±": F.col("tolerance"), "≤": F.array_contains("comparators", "lte"), "≥": F.array_contains("comparators", "gte")}
    lost = [
        F.when(F.contains(F.coalesce("runs", F.lit("")), F.lit(s)) & ~F.contains("blob", F.lit(s)) & ~structural.get(s, F.lit(False)), F.lit(f"symbol '{s}' dropped"))
        for s in lx.CRITICAL_SYMBOLS
    ]
    why = F.array_compact(F.array(F.when(F.col("no_unit"), "missing unit"), F.when(F.col("no_comparator"), "missing comparator"), *lost))
    return outcome(n.withColumn("_why", why).filter(F.size("_why") > 0), "units", "quarantine", F.array_join("_why", "; "))


def equations(nodes: DataFrame) -> DataFrame:
    """Gate 8: equations without LaTeX, unbalanced, or with symbols that the LaTeX lacks."""
    latex = F.col("latex")
    why = (
        F.when(F.coalesce(F.length(F.trim(latex)), F.lit(0)) == 0, "no latex")
        .when(~eq.is_balanced(latex), "unbalanced")
        .when(F.exists("symbols", lambda s: F.instr(latex, s) == 0), "symbol not in latex")
    )
    return outcome(nodes.withColumn("_why", why).filter("_why is not null"), "equations", "quarantine", F.col("_why"))


def cross_reference(xrefs: DataFrame, clauses: DataFrame, captions: DataFrame) -> DataFrame:
    """Gate 9: references to clauses the edition lacks, or to captions it lacks although the number is
    within the range captured.  ``captions``: edition, kind, num."""
    refs = xrefs.withColumn("num", F.nullif(F.regexp_extract("surface", r"(\d+(?:\.\d+)*)", 1), F.lit("")))
    inside = refs.filter(F.col("kind").isin("clause", "annex", "section")).join(
        clauses.select("edition", F.col("clause_id").alias("surface")).distinct(), ["edition", "surface"], "left_anti"
    )
    numbers = captions.filter(F.col("num").rlike(r"^\d+$")).groupBy("edition", "kind").agg(F.max(F.col("num").cast("int")).alias("most"))
    objects = refs.filter(F.col("kind").isin("table", "figure") & F.col("num").isNotNull())
    objects = objects.join(captions.select("edition", "kind", "num").distinct(), ["edition", "kind", "num"], "left_anti")
    objects = objects.join(numbers, ["edition", "kind"], "left")
    beyond = F.coalesce(F.col("num").rlike(r"^\d+$") & (F.col("num").try_cast("int") > F.col("most")), F.lit(False))
    dangling = inside.select("edition", "pre", "surface").unionByName(objects.filter(~beyond).select("edition", "pre", "surface"))
    per_node = dangling.groupBy("edition", "pre").agg(F.array_join(F.sort_array(F.collect_list("surface")), ",").alias("_refs"))
    return outcome(per_node, "cross_reference", "quarantine", F.concat(F.lit("unresolved "), F.col("_refs")))


def summary(outcomes: DataFrame) -> DataFrame:
    """Counts of both verdicts per gate, zero filled."""
    return outcomes.groupBy("gate").pivot("verdict", ["quarantine", "repair"]).agg(F.count(F.lit(1))).fillna(0)


def exit_status(editions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """2 for an edition with an unresolved reference, 1 with any quarantine, else 0."""
    bad = outcomes.filter("verdict = 'quarantine'").groupBy("edition").agg(
        F.max(F.col("gate") == "cross_reference").alias("refs"), F.count(F.lit(1)).alias("quarantines")
    )
    status = F.when(F.col("refs"), 2).when(F.col("quarantines") > 0, 1).otherwise(0)
    return editions.join(bad, "edition", "left").select("edition", F.coalesce("quarantines", F.lit(0)).alias("quarantines"), status.alias("status"))
