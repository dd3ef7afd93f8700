"""From layout items to an audited edition: the passes in their order, as one lazy plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import lexicon as lx
from ..functions import text as tx
from ..operators import gates as gt
from ..operators import tree as tr

@dataclass(frozen=True)
class Bundle:
    """``nodes``: one row a node with its parent, clause, role and id; ``xrefs``: references of nodes;
    ``outcomes``: what the gates found."""

    nodes: DataFrame
    xrefs: DataFrame
    outcomes: DataFrame


def caption_inventory(nodes: DataFrame) -> DataFrame:
    """Kind and number of each caption of a table or figure."""
    text = F.translate(F.col("text"), " ", " ")
    word = F.lower(F.regexp_extract(text, lx.CAPTION_LABEL, 1))
    kind = F.when(word.startswith("tab"), "table").otherwise("figure")
    found = nodes.filter((F.col("type") == "caption") & (word != ""))
    return found.select("edition", kind.alias("kind"), F.regexp_extract(text, lx.CAPTION_LABEL, 2).alias("num"))


def role(kind: Column, text: Column, lang: Column) -> Column:
    heading = F.when(kind.isin("section", "heading"), tx.heading_role(text, lang))
    return F.coalesce(heading, tx.admonition_role(text, lang), tx.modal_role(text, lang))


def assemble(items: DataFrame) -> Bundle:
    """``items``: edition, pre, page, label, level, text, lang."""
    nodes = tr.with_clauses(tr.merge_numbers(tr.attach_captions(tr.build(items))))
    nodes = nodes.withColumn("placed", F.coalesce("owner", "parent")).drop("owner", "parent", "level", "label")
    # Clause numbers decide where sections belong; everything else stays under its heading.
    nested = tr.nest(nodes.withColumn("relevant", F.lit(True))).withColumn(
        "parent", F.when((F.col("type") == "section") | F.col("clause_id").isNotNull(), F.col("parent")).otherwise(F.col("placed"))
    )
    nodes = nested.drop("placed", "relevant", "parts").withColumn("cdm_type", role(F.col("type"), F.col("text"), F.col("lang")))
    refs = nodes.select("edition", "pre", F.explode(tx.references(F.col("text"))).alias("x")).select("edition", "pre", "x.kind", "x.surface")
    clauses = nodes.filter("clause_id is not null").select("edition", "clause_id")
    outcomes = gt.union([gt.numbering(nodes), gt.cross_reference(refs, clauses, caption_inventory(nodes))])
    standard = tr.standard_id(nodes)
    stamped = tr.restamp(nodes.join(standard, "edition", "left").withColumn("doc", F.concat(F.lit("doc:"), F.col("edition").cast("string"))))
    return Bundle(stamped.drop("doc"), refs, outcomes)
