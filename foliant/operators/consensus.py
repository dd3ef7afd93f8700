"""Votes between sources, grids and confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicon as lx
from ..functions import equations as eq
from ..functions.text import squeezed


def text_votes(candidates: DataFrame, *, form=squeezed) -> DataFrame:
    """State of each node by the vote of its transcriptions (``edition, parser, text, normative``).

    A null text is no vote.  The authority is the highest-ranked parser present; without dissent the
    state is unanimous, with dissent quarantined for normative nodes, else majority if the authority
    and those who agree outnumber the rest.  Nodes with fewer than two voters are left out.
    """
    rank = F.array_position(F.array(*[F.lit(p) for p in lx.TEXT_AUTHORITY]), F.col("parser"))
    votes = candidates.withColumn("rank", rank).filter((F.col("rank") > 0) & F.col("text").isNotNull()).withColumn("form", form(F.col("text")))
    per_node = votes.groupBy("edition").agg(
        F.min_by("parser", "rank").alias("authority"),
        F.min_by("form", "rank").alias("auth_form"),
        F.max("normative").alias("normative"),
        F.count(F.lit(1)).alias("voters"),
        F.collect_list(F.struct("parser", "form")).alias("all"),
    )
    dissent = F.filter("all", lambda x: x["form"] != F.col("auth_form"))
    names = F.array_join(F.sort_array(F.transform(dissent, lambda x: x["parser"])), ",")
    against = F.size(dissent)
    state = (
        F.when(against == 0, "unanimous").when(F.col("normative"), "quarantined")
        .when(2 * (F.col("voters") - against) > F.col("voters"), "majority").otherwise("quarantined")
    )
    return per_node.filter("voters >= 2").select("edition", "authority", "voters", state.alias("state"), names.alias("dissenters"))


def grid_votes(tables: DataFrame) -> DataFrame:
    """``state`` from (rows, cols) of layout, ruling and word grids: columns l_rows, l_cols, r_rows, ..., w_cols."""
    agree = (F.col("l_rows") == F.col("r_rows")) & (F.col("l_cols") == F.col("r_cols"))
    words = F.coalesce((F.col("w_rows") == F.col("l_rows")) & (F.col("w_cols") == F.col("l_cols")), F.lit(False))
    state = (
        F.when(F.col("l_rows").isNull() | F.col("r_rows").isNull() | ~agree, "quarantined").when(words, "unanimous").otherwise("majority")
    )
    return tables.withColumn("state", state)


def strict_grid_votes(grids: DataFrame, *keys: str) -> DataFrame:
    """All three parsers must agree on rows, columns and spans (``parser, n_rows, n_cols, spans``)."""
    shape = F.struct("n_rows", "n_cols", "spans")
    per_table = grids.groupBy(*keys).agg(F.count_distinct("parser").alias("opinions"), F.size(F.collect_set(shape)).alias("shapes"))
    return per_table.withColumn("state", F.when((F.col("opinions") >= 3) & (F.col("shapes") == 1), "unanimous").otherwise("quarantined"))


def nearest_grid(tables: DataFrame, grids: DataFrame) -> DataFrame:
    """The grid of a table's page that differs least in rows plus columns, the first on ties."""
    met = tables.join(grids, ["edition", "page"], "left")
    gap = F.abs(F.col("n_rows") - F.col("g_rows")) + F.abs(F.col("n_cols") - F.col("g_cols"))
    return met.groupBy("edition", "page", "pre").agg(F.min_by("grid_ord", F.struct(gap.alias("gap"), F.col("grid_ord"))).alias("grid_ord"), F.min(gap).alias("gap"))


def equation_votes(candidates: DataFrame) -> DataFrame:
    """Quarantined if any engine's formula differs from the authority's in the comparison form."""
    c = candidates.withColumn("form", eq.compare_form(F.col("latex")))
    per_node = c.groupBy("edition", "pre").agg(
        F.max(F.when(F.col("parser") == "docling_formula", F.col("form"))).alias("auth"), F.collect_list(F.struct("parser", "form")).alias("all")
    )
    against = F.filter("all", lambda x: x["form"] != F.col("auth"))
    return per_node.select(
        "edition", "pre", F.when(F.size(against) > 0, "quarantined").otherwise("unanimous").alias("state"),
        F.array_join(F.sort_array(F.transform(against, lambda x: x["parser"])), ",").alias("dissenters"),
    )


def downgrade(nodes: DataFrame, pages: DataFrame) -> DataFrame:
    """Confidence of nodes on doubtful pages is replaced; other pages keep it."""
    table = F.create_map(*[F.lit(x) for p in lx.PAGE_CONFIDENCE.items() for x in p])
    n = nodes.join(pages, ["edition", "page"], "left")
    lower = F.try_element_at(table, F.col("page_class"))
    return n.withColumn("confidence", F.coalesce(lower, "confidence")).withColumn("review", lower.isNotNull())


def ocr_ceiling(confidence: Column, is_ocr: Column) -> Column:
    return F.when(is_ocr, F.least(confidence, F.lit(lx.OCR_CEILING))).otherwise(confidence)


def owners(spark) -> DataFrame:
    rows = [(content, page, engine) for content, engines in lx.OWNERS.items() for page, engine in zip(lx.PAGE_CLASSES, engines, strict=True)]
    return spark.createDataFrame(rows, "content string, page_class string, engine string")


def translation_groups(nodes: DataFrame) -> DataFrame:
    """Clauses tagged in at least two languages."""
    per = nodes.filter("clause_id is not null and lang is not null").groupBy("clause_id")
    return per.agg(F.count_distinct("lang").alias("langs"), F.count(F.lit(1)).alias("nodes")).filter("langs >= 2").withColumn("grp", F.concat(F.lit("tg:"), "clause_id"))


def dominant_language(nodes: DataFrame) -> DataFrame:
    """Most frequent language of an edition, ties to the one seen first."""
    per = nodes.filter("lang is not null").groupBy("edition", "lang").agg(F.count(F.lit(1)).alias("n"), F.min("pre").alias("first"))
    return per.groupBy("edition").agg(F.max_by("lang", F.struct("n", -F.col("first"))).alias("lang"))


def runs_in_regions(runs: DataFrame, regions: DataFrame, pad: float = 1.0) -> DataFrame:
    """Runs whose centre lies in a region grown by ``pad`` (top-left coordinates; same edition and page)."""
    met = regions.join(runs, ["edition", "page"])
    cx, cy = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    return met.filter(cx.between(F.col("l") - pad, F.col("r") + pad) & cy.between(F.col("t") - pad, F.col("b") + pad))


def to_top_left(l: Column, t: Column, r: Column, b: Column, height: Column) -> Column:  # noqa: E741
    """Bottom-left boxes (t above b) in top-left coordinates; others as they are."""
    flip = t > b
    return F.struct(l.alias("l"), F.when(flip, height - t).otherwise(t).alias("t"), r.alias("r"), F.when(flip, height - b).otherwise(b).alias("b"))


def line_baseline(spans: DataFrame, *keys: str) -> DataFrame:
    """Baseline and size of each line: of its largest span, the first on ties; and how each span stands."""
    line = Window.partitionBy(*keys)
    lead = F.max_by(F.struct("origin_y", "size"), F.struct("size", -F.col("ord"))).over(line)
    s = spans.withColumn("lead", lead)
    shift = F.col("lead.origin_y") - F.col("origin_y")
    small = (F.col("size") < F.col("lead.size")) & (F.abs(shift) > 0.15 * F.col("lead.size"))
    kind = F.when(small & (shift > 0), "superscript").when(small, "subscript").otherwise("normal")
    return s.withColumn("offset", shift).withColumn("vertical_align", kind).drop("lead")


def reading_lines(spans: DataFrame, *keys: str, tolerance: float = 3.0) -> DataFrame:
    """Lines of a page: in order of baseline, a new line where it is more than ``tolerance`` from the
    line's first baseline.  An anchor rule is a fold over the ordered baselines of one page."""
    values = F.array_sort(F.array_distinct(F.collect_list("origin_y")))

    def step(acc: Column, y: Column) -> Column:
        fresh = acc["anchor"].isNull() | (y - acc["anchor"] > tolerance)
        line = acc["line"] + fresh.cast("int")
        return F.struct(F.when(fresh, y).otherwise(acc["anchor"]).alias("anchor"), line.alias("line"), F.concat(acc["out"], F.array(F.struct(y.alias("origin_y"), line.alias("line")))).alias("out"))

    start = F.struct(F.lit(None).cast("double").alias("anchor"), F.lit(0).alias("line"), F.array().cast("array<struct<origin_y:double,line:int>>").alias("out"))
    lines = spans.groupBy(*keys).agg(F.aggregate(values, start, step, lambda a: a["out"]).alias("o"))
    lines = lines.select(*keys, F.explode("o").alias("o")).select(*keys, "o.origin_y", "o.line")
    order = Window.partitionBy(*keys).orderBy("line", "x0", "ord")
    return spans.join(lines, [*keys, "origin_y"]).withColumn("reading", F.row_number().over(order))
