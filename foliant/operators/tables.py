"""Tables: stitching, header lineage, grids, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicon as lx
from ..functions.text import squeezed
from ..functions.values import names_limit

TABLE = ("edition", "table_ord")


def flag_header_rows(cells: DataFrame, *keys: str) -> DataFrame:
    """``header_row``: rows with flagged cells, or row 0 where no cell of the table is flagged."""
    table, row = Window.partitionBy(*keys), Window.partitionBy(*keys, "row")
    any_flag = F.max(F.col("header").cast("int")).over(table) == 1
    return cells.withColumn("header_row", F.when(any_flag, F.max(F.col("header").cast("int")).over(row) == 1).otherwise(F.col("row") == 0))


def signatures(cells: DataFrame, *keys: str) -> DataFrame:
    """Per table: folded header texts in (row, col) order, whether flagged, columns and rows."""
    c = flag_header_rows(cells, *keys)
    head = F.when(F.col("header_row"), F.struct("row", "col", squeezed(F.lower("text")).alias("text")))
    return c.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(head)), lambda x: x["text"]).alias("signature"),
        (F.max(F.col("header").cast("int")) == 1).alias("flagged"),
        F.max(F.col("col") + F.col("colspan")).alias("n_cols"),
        F.max(F.col("row") + F.col("rowspan")).alias("n_rows"),
    )


def cells(items: DataFrame) -> DataFrame:
    """Cells of table items (``start_row, end_row, start_col, end_col``, header flag, text): a span is at
    least one, the page is the table's, and no header path is known yet."""
    return items.withColumns(
        {
            "row": F.col("start_row"), "rowspan": F.greatest(F.col("end_row") - F.col("start_row"), F.lit(1)),
            "col": F.col("start_col"), "colspan": F.greatest(F.col("end_col") - F.col("start_col"), F.lit(1)),
            "header": F.coalesce("header", F.lit(False)), "header_path": F.array().cast("array<string>"),
        }
    ).drop("start_row", "end_row", "start_col", "end_col")


def header_paths(cells: DataFrame, *keys: str) -> DataFrame:
    """Data cells with ``header_path``: header texts above their first column, top down.

    A table's few header cells travel to its data cells as one array, and each cell looks its own up."""
    c = flag_header_rows(cells, *keys)
    head = F.struct(F.col("row").alias("row"), F.col("col").alias("col"), (F.col("col") + F.col("colspan")).alias("end"), F.trim("text").alias("text"))
    heads = c.filter("header_row").filter(F.trim("text") != "").groupBy(*keys).agg(F.sort_array(F.collect_list(head)).alias("_heads"))
    data = c.filter(~F.col("header_row")).join(heads, list(keys), "left")
    above = F.filter(F.coalesce("_heads", F.array().cast("array<struct<row:int,col:int,end:int,text:string>>")), lambda h: (h["col"] <= F.col("col")) & (F.col("col") < h["end"]))
    # Of several cells of one header row the leftmost counts; they are in order.
    path = F.get(F.transform(F.array(above), lambda a: F.transform(F.filter(a, lambda h, i: (i == 0) | (F.get(a, i - 1)["row"] != h["row"])), lambda h: h["text"])), F.lit(0))
    return data.withColumn("header_path", path).drop("_heads")


def stitch(tables: DataFrame) -> DataFrame:
    """Islands of consecutive sibling tables with equal columns and header signature.

    ``tables``: edition, pre, signature, n_cols, first_data, n_rows.  Adds ``island`` (pre of the first
    table) and ``offset``: what is added to a data row of a continuation.
    """
    w = Window.partitionBy("edition").orderBy("pre")
    same = (F.col("signature") == F.lag("signature").over(w)) & (F.col("n_cols") == F.lag("n_cols").over(w)) & (F.size("signature") > 0)
    t = tables.withColumn("_new", (~F.coalesce(same, F.lit(False))).cast("int")).withColumn("_island", F.sum("_new").over(w))
    group = Window.partitionBy("edition", "_island").orderBy("pre")
    height = F.when(F.col("_new") == 1, F.col("n_rows")).otherwise(F.col("n_rows") - F.col("first_data"))
    t = t.withColumn("_height", height).withColumn("island", F.first("pre").over(group))
    above = F.sum("_height").over(group.rowsBetween(Window.unboundedPreceding, -1))
    return t.withColumn("offset", F.when(F.col("_new") == 1, 0).otherwise(above - F.col("first_data"))).drop("_new", "_island", "_height")


def coverage(cells: DataFrame, *keys: str) -> DataFrame:
    """Per table: positions covered more than once and positions not covered."""
    spots = cells.withColumn("r", F.explode(F.sequence("row", F.col("row") + F.col("rowspan") - 1))).withColumn(
        "c", F.explode(F.sequence("col", F.col("col") + F.col("colspan") - 1))
    )
    each = spots.groupBy(*keys, "r", "c").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy(*keys).agg(
        F.count_if(F.col("n") > 1).alias("overlaps"),
        ((F.max("r") + 1) * (F.max("c") + 1) - F.count(F.lit(1))).alias("holes"),
    )


def looks_nested(text: Column) -> Column:
    """At least two lines that all split into the same number (two or more) of tokens."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    sizes = F.array_distinct(F.transform(lines, lambda x: F.size(F.split(F.trim(x), r"\s+"))))
    return (F.size(lines) >= 2) & (F.size(sizes) == 1) & (F.get(sizes, F.lit(0)) >= 2)


def continuation(tables: DataFrame) -> DataFrame:
    """Gate: outcome pairs of neighbouring tables, by the share of equal header cells in place."""
    w = Window.partitionBy("edition").orderBy("pre")
    t = tables.filter(F.size("signature") > 0).withColumn("p", F.lag(F.struct("pre", "signature", "flagged")).over(w)).filter("p is not null")
    equal = F.aggregate(F.zip_with("signature", "p.signature", lambda a, b: F.coalesce(a == b, F.lit(False)).cast("int")), F.lit(0), lambda a, x: a + x)
    t = t.withColumn("overlap", equal / F.greatest(F.size("signature"), F.size("p.signature")))
    verdict = F.when(F.col("overlap") == 1, "repair").when((F.col("overlap") > 0) & F.col("flagged") & F.col("p.flagged"), "quarantine")
    t = t.withColumn("verdict", verdict).filter("verdict is not null")
    return t.select("edition", F.explode(F.array("pre", "p.pre")).alias("pre"), "verdict", "overlap")


def blank_limits(data: DataFrame) -> DataFrame:
    """Blank cells under a header that names a limit."""
    return data.filter(F.exists("header_path", names_limit) & (F.trim(F.coalesce("text", F.lit(""))) == ""))


def ruled_grid(slots: DataFrame) -> DataFrame:
    """Spans of ruled tables from empty slots: a cell spans the empty slots that follow it in its row.
    ``slots``: edition, page, table_ord, row, slot, is_null."""
    w = Window.partitionBy("edition", "page", "table_ord", "row").orderBy("slot")
    s = slots.withColumn("_cell", F.sum((~F.col("is_null")).cast("int")).over(w)).filter("_cell > 0")
    cells = s.groupBy("edition", "page", "table_ord", "row", "_cell").agg(F.min("slot").alias("col"), F.count(F.lit(1)).alias("colspan"))
    sizes = slots.groupBy("edition", "page", "table_ord").agg((F.max("row") + 1).alias("n_rows"), (F.max("slot") + 1).alias("n_cols"))
    spans = cells.filter("colspan > 1").groupBy("edition", "page", "table_ord").agg(F.sort_array(F.collect_list(F.struct("row", "col", "colspan"))).alias("spans"))
    return sizes.join(spans, ["edition", "page", "table_ord"], "left")


def word_grid(words: DataFrame, *keys: str) -> DataFrame:
    """Rows and columns of a region from word centres: a new cluster where the gap to the centre before
    exceeds 0.6 of the median height (1.5 of the median width)."""

    def clusters(low: str, high: str, factor: float, name: str) -> DataFrame:
        size = F.sort_array(F.collect_list(F.col(high) - F.col(low)))
        middle = words.groupBy(*keys).agg(F.element_at(size, (F.floor(F.count(F.lit(1)) / 2) + 1).cast("int")).alias("m"))
        centre = words.select(*keys, ((F.col(low) + F.col(high)) / 2).alias("v"))
        w = Window.partitionBy(*keys).orderBy("v")
        gap = F.col("v") - F.lag("v").over(w)
        marked = centre.withColumn("gap", gap).join(middle, list(keys))
        tolerance = factor * F.when(F.col("m") == 0, F.lit(1.0)).otherwise(F.col("m"))
        return marked.groupBy(*keys).agg((F.count_if(F.col("gap") > tolerance) + 1).alias(name))

    return clusters("y0", "y1", 0.6, "n_rows").join(clusters("x0", "x1", 1.5, "n_cols"), list(keys))
