"""Views for readers and stores: status, scorecard, review queue, graph, chunks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def status(consensus: Column, review: Column, relevant: Column) -> Column:
    return (
        F.when(consensus == "quarantined", "critical").when(review, "serious").when(consensus == "majority", "warning")
        .when(~relevant, "excluded").otherwise("good")
    )


def review_queue(nodes: DataFrame, limit: int = 300) -> DataFrame:
    """Nodes to look at, least sure first, with the true number of them."""
    open_ones = nodes.filter("status in ('critical', 'serious', 'warning')")
    total = open_ones.agg(F.count(F.lit(1)).alias("total"))
    return open_ones.orderBy("confidence", "edition", "pre").limit(limit).crossJoin(F.broadcast(total))


def edges(nodes: DataFrame, xrefs: DataFrame, links: DataFrame, groups: DataFrame) -> DataFrame:
    """Edges of the document graph: nesting, continuation, resolved references, translations (as a star)."""
    last = nodes.filter("clause_id is not null").groupBy("edition", "clause_id").agg(F.max_by("pre", "pre").alias("to"))
    kind = lambda df, name: df.select("edition", F.col("src"), F.col("to"), F.lit(name).alias("edge"))
    nesting = kind(nodes.filter("parent is not null").select("edition", F.col("parent").alias("src"), F.col("pre").alias("to")), "nesting")
    refs = xrefs.join(last, [xrefs["edition"] == last["edition"], xrefs["surface"] == last["clause_id"]]).filter("pre <> to")
    refs = kind(refs.select(xrefs["edition"], F.col("pre").alias("src"), "to").distinct(), "xref")
    star = groups.withColumn("src", F.min("pre").over(Window.partitionBy("edition", "grp"))).filter("src <> pre")
    return reduce(DataFrame.unionByName, [nesting, kind(links, "continues"), refs, kind(star.select("edition", "src", F.col("pre").alias("to")), "translation")])


def chunk_payload(chunks: DataFrame) -> DataFrame:
    """Points for a vector store: id and vector; a chunk without one is an error."""
    checked = F.when(F.col("embedding").isNull(), F.raise_error(F.lit("a chunk without an embedding"))).otherwise(F.col("embedding"))
    return chunks.select("id", checked.alias("vector"))


def short_reason(reason: Column, most: int = 200) -> Column:
    """At most ``most`` characters, and how many more there are."""
    more = F.length(reason) - most
    return F.when(more > 0, F.concat(F.substring(reason, 1, most), F.lit(" ["), more.cast("string"), F.lit(" more chars]"))).otherwise(reason)


def by_discrepancy(changes: DataFrame, score: str, *ties: str) -> DataFrame:
    """``rank`` of changes by falling score, ties by ``ties``; null scores last.

    Ranks are counts of what stands before: rows are ordered only among those of one score.
    """
    counts = changes.groupBy(score).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(F.desc_nulls_last(score)).rowsBetween(Window.unboundedPreceding, -1)
    above = counts.select(F.col(score).alias("_score"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_above"))
    inside = F.row_number().over(Window.partitionBy(score).orderBy(*ties))
    met = changes.join(above, changes[score].eqNullSafe(above["_score"]))
    return met.withColumn("rank", F.col("_above") + inside).drop("_score", "_above")


def pixels(l: Column, t: Column, r: Column, b: Column, dpi: int = 150) -> Column:  # noqa: E741
    k = dpi / 72
    return F.struct((l * k).alias("l"), (t * k).alias("t"), (r * k).alias("r"), (b * k).alias("b"))


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """The same n rows for the same seed, whatever the partitions."""
    return rows.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))), key).limit(n)
