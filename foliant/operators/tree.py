"""The document tree: nodes in preorder, re-parenting passes in closed form.

A node table has ``edition``, ``pre`` (preorder place) and where needed ``post_end`` (last
``pre`` of its subtree); a descendant test is then a range test.  Every pass keeps the
edition as its first key, so one partitioning serves all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import lexicon as lx
from ..functions import text as tx


def before(order: str = "pre", *keys: str):
    return Window.partitionBy(*(keys or ("edition",))).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def build(items: DataFrame, levels: int = 6) -> DataFrame:
    """Nodes of layout items: type, parent.  A heading's parent is the nearest earlier heading of a
    smaller level, other content's the last heading.  Page furniture and unknown labels go;
    headings that read like captions or legends become captions and notes."""
    caption = items["text"].rlike(lx.CAPTION_LIKE)
    legend = items["text"].rlike(lx.BLOCK_LABEL)
    plain = F.try_element_at(F.create_map(*[F.lit(x) for p in lx.NODE_TYPES.items() for x in p]), F.col("label"))
    heading = F.col("label").isin(*lx.HEADING_LABELS)
    kind = (
        F.when(heading & caption, "caption").when(heading & legend, "note").when(heading, "section")
        .when(F.col("label") == "caption", "caption").otherwise(plain)
    )
    nodes = items.filter(~F.col("label").isin(*lx.SKIPPED_LABELS)).withColumn("type", kind).filter("type is not null")
    level = F.when(F.col("type") == "section", F.coalesce("level", F.lit(1)))
    nodes = nodes.withColumn("level", level)
    last_of = [F.last(F.when(F.col("level") == k, F.col("pre")), ignorenulls=True).over(before()) for k in range(1, levels)]
    nodes = nodes.withColumns({f"_h{k}": c for k, c in enumerate(last_of, 1)})
    smaller = F.greatest(F.lit(None).cast("int"), F.lit(None).cast("int"), *[F.when(F.col("level") > k, F.col(f"_h{k}")) for k in range(1, levels)])
    any_heading = F.last(F.when(F.col("type") == "section", F.col("pre")), ignorenulls=True).over(before())
    parent = F.when(F.col("type") == "section", smaller).otherwise(any_heading)
    return nodes.withColumn("parent", parent).drop(*[f"_h{k}" for k in range(1, levels)])


def reconcile(nodes: DataFrame) -> DataFrame:
    """The seam where a second reading of a page may be set against the first: it changes nothing."""
    return nodes


def claim_captions(nodes: DataFrame, refs: DataFrame) -> DataFrame:
    """Captions that a table or figure names (``refs``: edition, owner, caption) become its children."""
    named = refs.groupBy("edition", F.col("caption").alias("pre")).agg(F.min("owner").alias("owner"))
    return nodes.join(named, ["edition", "pre"], "left").withColumn("parent", F.coalesce("owner", "parent")).drop("owner")


def attach_captions(siblings: DataFrame) -> DataFrame:
    """``owner``: the same-page table or figure next to a caption; null if both or neither side has one.

    Captions in a row after a table chain onto it while they stay on its page; only the last of a
    row can look ahead, and a table ahead that takes one no longer stands between.
    """
    w = Window.partitionBy("edition").orderBy("pre")
    holds = F.col("type").isin("table", "figure")
    s = siblings.withColumns(
        {
            "_prev": F.last(F.when(F.col("type") != "caption", F.struct("pre", "page", holds.alias("ok"))), ignorenulls=True).over(before()),
            "_next_ok": F.coalesce(F.lead(holds).over(w) & (F.lead("page").over(w) == F.col("page")), F.lit(False)),
            "_next": F.lead("pre").over(w),
            "_run": F.sum((F.col("type") != "caption").cast("int")).over(w),
        }
    )
    s = s.withColumn("_near", F.col("_prev.ok") & (F.col("_prev.page") == F.col("page")))
    run = Window.partitionBy("edition", "_run").orderBy("pre").rowsBetween(Window.unboundedPreceding, 0)
    # The chain holds while every caption of the row so far attached backwards.
    back = F.min(F.when(F.col("type") == "caption", (F.coalesce("_near", F.lit(False))).cast("int"))).over(run) == 1
    owner = F.when(F.col("type") == "caption", F.when(back & ~F.col("_next_ok"), F.col("_prev.pre")).when(F.col("_next_ok") & ~back, F.col("_next")))
    return s.withColumn("owner", owner).drop("_prev", "_next_ok", "_next", "_run", "_near")


def merge_numbers(nodes: DataFrame) -> DataFrame:
    """A node that is a clause number alone joins the short unnumbered title after it on its page;
    the joined text stands at the title, the number's node goes.  Its children (``parent``, ``owner``, where
    there are such columns) move to the title, and the title to its parent."""
    w = Window.partitionBy("edition").orderBy("pre")
    lone = F.col("text").rlike(lx.LONE_NUMBER)
    words = F.size(F.filter(F.split("text", r"\s+"), lambda x: x != ""))
    title = F.col("type").isin("section", "heading", "paragraph", "list_item") & (words <= 12) & tx.clause_of_heading(F.col("text")).isNull()
    n = nodes.withColumns({"_lone": F.coalesce(lone, F.lit(False)), "_title": F.coalesce(title, F.lit(False))})
    fits = F.coalesce(F.lead("_title").over(w) & (F.lead("page").over(w) == F.col("page")), F.lit(False))
    n = n.withColumn("_drop", F.col("_lone") & fits)
    number = F.when(F.lag("_drop").over(w), F.trim(F.lag("text").over(w)))
    joined = F.when(number.isNotNull(), F.concat_ws(" ", number, F.trim("text"))).otherwise(F.col("text"))
    links = [c for c in ("parent", "owner") if c in nodes.columns]
    n = n.withColumns({"_text": joined, "_to": F.when(F.col("_drop"), F.lead("pre").over(w))})
    gone = n.filter("_drop").select("edition", F.col("pre").alias("_from"), "_to", *[F.col(c).alias(f"_up_{c}") for c in links])
    out = n.filter(~F.col("_drop")).withColumn("text", F.col("_text")).drop("_lone", "_title", "_drop", "_text", "_to")
    for c in links:
        # The number's own parent may be a number that goes, too: then that one's title.
        above = gone.select(F.col("edition").alias("_e"), F.col("_from").alias("_f"), F.col("_to").alias("_t"))
        moves = gone.select("edition", F.col("_from").alias(c), "_to", F.col(f"_up_{c}").alias("_up"))
        moves = moves.join(above, (F.col("edition") == F.col("_e")) & (F.col("_up") == F.col("_f")), "left")
        moves = moves.select("edition", c, "_to", F.coalesce("_t", "_up").alias("_up"))
        moved = F.when(F.col("_to").isNull(), F.col(c)).when(F.col("_to") == F.col("pre"), F.col("_up")).otherwise(F.col("_to"))
        out = out.join(moves, ["edition", c], "left").withColumn(c, moved).drop("_to", "_up")
    return out.select(*nodes.columns)


def with_clauses(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("clause_id", tx.clause_id(F.col("type"), F.col("text")))


def nest(nodes: DataFrame) -> DataFrame:
    """Parent of each top-level node by clause numbers (``type, clause_id, relevant``).

    Annexes and excluded sections open a new stretch.  Inside one, a numbered node's parent is the
    nearest earlier strict prefix, unless a numbered node in between is not below that prefix;
    an unnumbered node belongs to the last opened one.
    """
    parts = tx.numeric_parts(F.col("clause_id"))
    annex = (F.col("type") == "section") & F.lower("clause_id").startswith("annex") & parts.isNull()
    reset = F.coalesce(annex | (parts.isNull() & (F.col("type") == "section") & ~F.col("relevant")), F.lit(False))
    w = Window.partitionBy("edition").orderBy("pre")
    n = nodes.withColumns({"parts": parts, "_annex": F.coalesce(annex, F.lit(False)), "_reset": reset})
    n = n.withColumn("_stretch", F.sum(F.col("_reset").cast("int")).over(w))
    opened = F.col("parts").isNotNull() | F.col("_annex")
    here = Window.partitionBy("edition", "_stretch").orderBy("pre").rowsBetween(Window.unboundedPreceding, -1)
    n = n.withColumn("_last", F.last(F.when(opened, F.col("pre")), ignorenulls=True).over(here))
    n = _nearest_prefix(n)
    value = F.when(F.col("_reset"), None).when(F.col("parts").isNotNull(), F.col("_up")).otherwise(F.col("_last"))
    return n.withColumn("parent", value.cast("int")).drop("_annex", "_reset", "_stretch", "_last", "_up")


def _nearest_prefix(n: DataFrame) -> DataFrame:
    """``_up``: of the numbered nodes of a stretch that are open when a node comes, the last whose parts
    are a strict prefix of its own.  One pass over each edition in order, with the open ones on a stack."""
    names = n.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in n.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, open_ = None, []
        for batch in batches:
            ups = []
            for edition, stretch, pre, parts in zip(*[batch.column(c).to_pylist() for c in ("edition", "_stretch", "pre", "parts")], strict=True):
                if (edition, stretch) != here:
                    here, open_ = (edition, stretch), []
                if parts is None:
                    ups.append(None)
                    continue
                while open_ and not (len(open_[-1][1]) < len(parts) and parts[: len(open_[-1][1])] == open_[-1][1]):
                    open_.pop()
                ups.append(open_[-1][0] if open_ else None)
                open_.append((pre, parts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ups, pa.int64())], [*names, "_up"])

    dealt = n.repartition("edition").sortWithinPartitions("edition", "_stretch", "pre")
    return dealt.mapInArrow(run, f"{fields}, _up bigint")


def hoist(nodes: DataFrame) -> DataFrame:
    """``hoisted``: numbered nodes whose nearest numbered ancestor (or, under an unnumbered
    container, the last numbered top-level node) is not a strict prefix of their number.
    ``nodes``: edition, pre, post_end, top (is top level), clause_id."""
    n = nodes.withColumn("parts", tx.numeric_parts(F.col("clause_id")))
    up = n.filter("parts is not null").select("edition", F.col("pre").alias("a"), F.col("post_end").alias("a_end"), F.col("parts").alias("a_parts"))
    near = (
        n.join(up, "edition").filter((F.col("a") < F.col("pre")) & (F.col("pre") <= F.col("a_end")))
        .groupBy("edition", "pre").agg(F.max_by("a_parts", "a").alias("near"))
    )
    running = F.last(F.when(F.col("top"), F.col("parts")), ignorenulls=True).over(before())
    n = n.withColumn("_running", running).join(near, ["edition", "pre"], "left")
    context = F.coalesce("near", "_running")
    wrong = ~F.col("top") & F.col("parts").isNotNull() & context.isNotNull() & ~tx.is_prefix(context, F.col("parts"))
    return n.withColumn("hoisted", F.coalesce(wrong, F.lit(False))).drop("_running", "near", "parts")


def chunkable(nodes: DataFrame) -> DataFrame:
    """Nodes with no irrelevant self or ancestor."""
    out = nodes.filter(~F.col("relevant")).select("edition", F.col("pre").alias("a"), F.col("post_end").alias("a_end"))
    inside = (nodes["edition"] == out["edition"]) & (nodes["pre"] >= out["a"]) & (nodes["pre"] <= out["a_end"])
    return nodes.join(out, inside, "left_anti")


def object_id(doc: Column, clause: Column, text: Column, standard: Column) -> Column:
    by_clause = F.concat(F.coalesce(standard, doc), F.lit("#"), clause)
    return F.coalesce(by_clause, F.concat(doc, F.lit("#"), F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 12)))


def restamp(nodes: DataFrame) -> DataFrame:
    """Content-addressed ids; repeats get ``~n`` in preorder.  ``nodes``: doc, clause_id, text, standard."""
    base = object_id(F.col("doc"), F.col("clause_id"), F.col("text"), F.col("standard"))
    n = F.row_number().over(Window.partitionBy("edition", "_base").orderBy("pre")) - 1
    out = nodes.withColumn("_base", base).withColumn("_n", n)
    return out.withColumn("object_id", F.when(F.col("_n") == 0, F.col("_base")).otherwise(F.concat_ws("~", "_base", F.col("_n").cast("string")))).drop("_base", "_n")


def standard_id(nodes: DataFrame) -> DataFrame:
    """Designation at the start of the first title-like node on page 1, per edition."""
    found = tx.squeezed(F.nullif(F.regexp_extract("text", lx.STANDARD_ID, 1), F.lit("")))
    rows = nodes.filter(F.col("type").isin("section", "heading", "paragraph", "caption") & (F.col("page") == 1))
    return rows.withColumn("standard", found).filter("standard is not null").groupBy("edition").agg(F.min_by("standard", "pre").alias("standard"))
