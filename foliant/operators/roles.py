"""Section roles: shape of a section's lines, headings, and place in the document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import lexicon as lx

def headings(spark: SparkSession) -> DataFrame:
    """Known headings with their role, pooled over languages."""
    from ..functions.text import bare

    rows = [(role, h) for role, names in lx.ROLE_HEADINGS.items() for h in names]
    return spark.createDataFrame(rows, "role string, heading string").withColumn("heading", bare(F.col("heading"))).dropDuplicates()


def shapes(lines: DataFrame, *keys: str) -> DataFrame:
    """Per section: how far its lines look like contents, an index, and how many characters they have.
    ``lines``: keys, ord, line."""
    w = Window.partitionBy(*keys).orderBy("ord")
    head = F.lower(F.get(F.split("line", r"[.\s]{2,}"), F.lit(0)))
    filled = lines.filter(F.trim("line") != "").withColumn("head", head)
    sorted_ok = F.when(F.lag("head").over(w).isNotNull(), (F.lag("head").over(w) <= F.col("head")).cast("double"))
    numbered = F.col("line").rlike(lx.NUMBER_AT_END)
    per = filled.withColumn("_ok", sorted_ok).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(numbered.cast("double")).alias("toc_share"),
        F.avg((numbered & (F.length("line") < 80)).cast("double")).alias("index_share"),
        F.coalesce(F.avg("_ok"), F.lit(0.0)).alias("sortedness"),
        F.sum(F.length("line")).alias("chars"),
    )
    return per.select(
        *keys, "n", "chars", F.when(F.col("n") >= 8, F.col("toc_share")).otherwise(0.0).alias("toc"),
        F.when(F.col("n") >= 10, F.least("index_share", "sortedness")).otherwise(0.0).alias("index"),
    )


def zones(sections: DataFrame) -> DataFrame:
    """front: before the first bare integer clause; back: the trailing run of index-shaped sections after it.
    ``sections``: edition, ord, clause_id, index (shape score)."""
    w = Window.partitionBy("edition")
    body = F.coalesce(F.min(F.when(F.col("clause_id").rlike(r"^\d+$"), F.col("ord"))).over(w), F.max("ord").over(w) + 1)
    last_other = F.coalesce(F.max(F.when(F.col("index") < 0.5, F.col("ord"))).over(w), F.lit(-1))
    s = sections.withColumns({"_body": body, "_back": last_other + 1})
    s = s.withColumn("_back", F.greatest("_back", "_body"))
    return s.withColumn("zone", F.when(F.col("ord") < F.col("_body"), "front").when(F.col("ord") >= F.col("_back"), "back").otherwise("body")).drop("_body", "_back")


def classify(sections: DataFrame) -> DataFrame:
    """Role of each section: the best of its zone's candidates if it reaches its threshold.
    ``sections``: zone, first (is first), page, heading_role, toc, index, chars."""

    def score(role: str, shape: Column) -> Column:
        ws, wd, _ = lx.ROLE_WEIGHTS[role]
        return ws * shape + F.when(F.array_contains("heading_roles", role), F.lit(wd)).otherwise(0.0)

    title = F.when(F.col("first") & (F.col("page") <= 1) & (F.col("chars") < 400), 1.0).otherwise(0.0)
    shape = {"toc": F.col("toc"), "list_of_figures": F.lit(0.0), "list_of_tables": F.lit(0.0), "title_page": title, "foreword": F.lit(0.0), "preface": F.lit(0.0)}
    front = F.array(*[F.struct(score(r, s).alias("s"), F.lit(-i).alias("i"), F.lit(r).alias("role"), F.lit(lx.ROLE_WEIGHTS[r][2]).alias("at")) for i, (r, s) in enumerate(shape.items())])
    back = F.array(F.struct(score("index", F.col("index")).alias("s"), F.lit(0).alias("i"), F.lit("index").alias("role"), F.lit(lx.ROLE_WEIGHTS["index"][2]).alias("at")))
    s = sections.withColumn("_best", F.array_max(F.when(F.col("zone") == "front", front).when(F.col("zone") == "back", back)))
    hit = F.coalesce((F.col("_best.s") > 0) & (F.col("_best.s") >= F.col("_best.at")), F.lit(False))
    return s.withColumns(
        {
            "section_role": F.when(hit, F.col("_best.role")).otherwise("normative"),
            "relevant": ~hit,
            "role_confidence": F.when(hit, F.round("_best.s", 3)).otherwise(F.lit(1.0)),
            "review": F.when(hit, F.col("_best.role") == "preface").otherwise(F.coalesce(F.col("_best.s") > 0.3, F.lit(False))),
        }
    ).drop("_best")


def gold_check(gold: DataFrame, sections: DataFrame) -> DataFrame:
    """Gold labels against classified sections whose heading contains the label's text."""
    met = gold.join(sections, (gold["doc"] == sections["edition"]) & F.contains(sections["heading"], gold["match"]), "left")
    return met.groupBy("doc").agg(
        F.count_if(F.col("gold_relevant") & ~F.col("relevant")).alias("false_exclusions"),
        F.count_if(~F.col("gold_relevant") & F.col("relevant")).alias("false_inclusions"),
        F.count_if(F.col("edition").isNull()).alias("unmatched"),
    )
