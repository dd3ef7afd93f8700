"""Accuracy measures: coverage, order, headings, profiles and pooled ratios."""

from __future__ import annotations

import bisect
import itertools

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicon as lx
from ..functions import text as tx


def repeated_lines(lines: DataFrame, least: int = 3) -> DataFrame:
    """Folded lines on at least ``least`` distinct pages of an edition."""
    folded = tx.squeezed(F.lower("text"))
    return lines.withColumn("line", folded).filter("line <> ''").groupBy("edition", "line").agg(F.count_distinct("page").alias("pages")).filter(F.col("pages") >= least)


def without_furniture(lines: DataFrame, repeated: DataFrame) -> DataFrame:
    """Lines that are horizontal, outside the outer 7 % of the page, and not repeated."""
    y = (F.col("y0") + F.col("y1")) / 2
    inside = F.col("horizontal") & (y > 0.07 * F.col("height")) & (y < 0.93 * F.col("height"))
    return lines.filter(inside).withColumn("line", tx.squeezed(F.lower("text"))).join(repeated.select("edition", "line"), ["edition", "line"], "left_anti")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Share, 1 where there is nothing to count."""
    return F.coalesce(numerator / F.nullif(denominator, F.lit(0)), F.lit(1.0))


def coverage(pages: DataFrame) -> DataFrame:
    """``coverage``, ``missed`` of source tokens by extracted ones (array columns source, extracted)."""
    missed = F.array_except("source", "extracted")
    return pages.withColumn("missed", F.size(missed)).withColumn("coverage", 1 - F.coalesce(F.size(missed) / F.nullif(F.size("source"), F.lit(0)), F.lit(0.0)))


def kendall(rows: DataFrame, *keys: str) -> DataFrame:
    """Kendall tau of a page's order (``pos``) against the order by descending y; 1 for fewer than two rows.

    Inversions are counted page by page while its rows are put in order, so no pairs are made.
    """
    ranked = rows.withColumn("rank__", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("y"), "pos"))).select(*keys, "pos", "rank__")
    schema = ranked.select(*keys).schema

    def tau(page: pa.Table) -> pa.Table:
        order = sorted(zip(page.column("pos").to_pylist(), page.column("rank__").to_pylist(), strict=True))
        seen: list[int] = []
        score = pairs = 0
        for _, same in itertools.groupby(order, key=lambda r: r[0]):
            ranks = [r for _, r in same]
            for r in ranks:
                score += 2 * bisect.bisect_left(seen, r) - len(seen)
                pairs += len(seen)
            for r in ranks:
                bisect.insort(seen, r)
        return pa.table({**{k: page.column(k).slice(0, 1) for k in keys}, "tau": pa.array([score / pairs if pairs else 1.0])})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return ranked.groupBy(*keys).applyInArrow(tau, f"{fields}, tau double")


def page_confidence(scores: DataFrame) -> DataFrame:
    """``layout, parse, table, ocr`` scores of pages to four places, NaN as null."""
    clean = lambda c: F.when(~F.isnan(c), F.round(c, 4)).alias(c)
    return scores.select("edition", "page", *[clean(c) for c in ("layout", "parse", "table", "ocr")])


def source_lines(spans: DataFrame) -> DataFrame:
    """Lines of a page from its spans (``edition, page, line, ord, text, x0, y0, x1, y1, dx, dy, size``): text, box, largest
    type, and whether the line runs left to right (by the direction of its first span)."""
    texts = F.transform(F.sort_array(F.collect_list(F.struct("ord", "text"))), lambda s: s["text"])
    box = [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]
    first = F.min_by(F.struct("dx", "dy"), "ord")
    lines = spans.groupBy("edition", "page", "line").agg(F.array_join(texts, " ").alias("text"), *box, F.max("size").alias("size"), first.alias("_d"))
    return lines.withColumn("horizontal", (F.col("_d.dx") > 0.7) & (F.abs("_d.dy") < 0.3)).drop("_d")


def heading_candidate(text: Column) -> Column:
    """Dotted clause of a line that is short, no contents entry and no classification code."""
    t = F.trim(text)
    clause = tx.clause_of_heading(t)
    ok = (F.length(t) <= 120) & ~t.rlike(lx.METADATA_CODE) & ~t.rlike(lx.NUMBER_AT_END) & (F.size(F.split(t, r"\s+")) <= 8)
    return F.when(ok & (F.instr(F.regexp_replace(clause, "Annex", ""), ".") > 0), clause)


def worst(pages: DataFrame, k: int = 5) -> DataFrame:
    """The k pages of lowest coverage per edition among those with misses."""
    w = Window.partitionBy("edition").orderBy("coverage", "page")
    return pages.filter("missed > 0").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def profile(nodes: DataFrame) -> DataFrame:
    """One row per edition: counts by type, clauses, languages, pages and characters."""
    return nodes.groupBy("edition").agg(
        F.count(F.lit(1)).alias("nodes"),
        F.count_if(F.col("type") == "section").alias("sections"),
        F.count_if(F.col("type") == "paragraph").alias("paragraphs"),
        F.count("clause_id").alias("clauses"),
        F.count_distinct("lang").alias("langs"),
        F.max("page").alias("pages"),
        F.sum(F.length("text")).alias("chars"),
    )


def pooled(documents: DataFrame) -> DataFrame:
    """Corpus ratios: sums of numerators over sums of denominators, page-weighted coverage, alarms."""
    return documents.agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("pages").alias("pages"),
        ratio(F.sum("hit"), F.sum("total")).alias("recall"),
        (F.sum(F.col("coverage") * F.col("pages")) / F.sum("pages")).alias("coverage"),
        F.count_if(F.col("alarm")).alias("alarms"),
    )
