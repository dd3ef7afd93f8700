"""LaTeX forms as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _each(text: Column, *steps: tuple[str, str]) -> Column:
    for pattern, by in steps:
        text = F.regexp_replace(text, pattern, by)
    return text


def is_chemical(latex: Column) -> Column:
    elements = F.regexp_count(latex, F.lit("[A-Z][a-z]?\\d*"))
    arrow = latex.rlike(r"->|<-|<=>|\\rightarrow|\\leftrightarrow|\\rightleftharpoons")
    return ~latex.rlike(r"\\ce\s*\{") & (latex.rlike(r"\((?:aq|s|g|l)\)") | (arrow & (elements >= 2)))


def canonical(latex: Column) -> Column:
    """Without delimiters, sizing and spacing macros; chemistry wrapped; spaces collapsed."""
    s = F.trim(_each(F.trim(latex), (r"^\$+|\$+$", "")))
    s = F.trim(_each(s, (r"^\\\[|\\\]$", "")))
    s = F.when(is_chemical(s), F.concat(F.lit("\\ce{"), s, F.lit("}"))).otherwise(s)
    return F.trim(
        _each(
            s,
            (r"\\(?:left|right|bigl|bigr|Bigl|Bigr|biggl|biggr)\b", ""),
            (r"\\[,;:!]", " "),
            (r"\\(?:quad|qquad|thinspace|medspace|thickspace)\b", " "),
            (r"\{\s+", "{"),
            (r"\s+\}", "}"),
            (r"[ \t\n]+", " "),
        )
    )


def compare_form(latex: Column) -> Column:
    """What engines' transcriptions are compared in: equal commands folded, no spaces, no tags."""
    return _each(
        canonical(latex),
        (r"\\tag\s*\{[^{}]*\}", ""),
        (r"\\(?:text|mathrm|mathit|operatorname)\s*\{([^{}]*)\}", "$1"),
        (r"\\ ", " "),
        (r"(?:\\\\|\s)+$", ""),
        (r"\s+", ""),
    )


def defines(latex: Column) -> Column:
    """Text before the first equals sign."""
    left = F.trim(F.regexp_replace(F.substring_index(latex, "=", 1), r"\s+", " "))
    return F.when(F.instr(latex, "=") > 0, F.nullif(left, F.lit("")))


def symbols(latex: Column) -> Column:
    """Sorted single letters outside commands and words."""
    plain = F.regexp_replace(latex, r"\\[a-zA-Z]+", " ")
    return F.sort_array(F.array_distinct(F.regexp_extract_all(plain, F.lit("(?<![A-Za-z])[A-Za-z](?![A-Za-z])"), F.lit(0))))


def surface(defined: Column) -> Column:
    """Plain letters of a defined symbol, at least two."""
    s = _each(defined, (r"\\[a-zA-Z]+", ""), (r"[{}_^\\\s]+", ""))
    return F.when(s.rlike(r"(?U)^\p{Alnum}{2,}$"), s)


def is_balanced(latex: Column) -> Column:
    """Brackets match; escaped characters do not count.

    Innermost pairs are folded away by nesting depth in one pass over the characters.
    """
    kept = F.regexp_replace(F.regexp_replace(latex, r"(?s)\\.", ""), r"[^(){}\[\]]", "")
    opens, closes = "([{", ")]}"

    def step(open_ones: Column, c: Column) -> Column:
        partner = F.translate(c, closes, opens)
        matching = F.substring(open_ones, -1, 1) == partner
        closed = F.when(matching, F.regexp_replace(open_ones, r"(?s).$", "")).otherwise(F.lit("!"))
        return F.when(open_ones == "!", open_ones).when(c.isin(*opens), F.concat(open_ones, c)).otherwise(closed)

    return F.aggregate(F.filter(F.split(kept, ""), lambda c: c != ""), F.lit(""), step) == ""


def computes_limit(nodes: DataFrame) -> DataFrame:
    """``computes_limit`` for equations (``edition, pre, parent, type, normative, text, defines``): whether the letters
    of the symbol that one defines, with or without a space or underscore between them and not inside
    a word, occur in the normative texts beside it.

    A parent's children may be many: pairs are made of equations and normative siblings that hold the
    symbol's first letter only, and the texts are never put together.
    """
    letters = surface(F.col("defines"))
    symbol = F.filter(F.split(letters, ""), lambda c: c != "")
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}_])"), F.array_join(F.transform(symbol, lambda c: F.concat(F.lit(r"\Q"), c, F.lit(r"\E"))), r"[\s_]?"), F.lit(r"(?![\p{L}\p{N}_])"))
    made = nodes.filter("type = 'equation'").select("edition", "parent", F.col("pre").alias("_pre"), letters.alias("_letters"), pattern.alias("_pattern"))
    made = made.filter(F.length("_letters") > 0)
    # Equations of one parent that define the same symbol are looked up once.
    wanted = made.groupBy("edition", "parent", "_letters").agg(F.first("_pattern").alias("_pattern"))
    said = nodes.filter("normative and type <> 'equation'").select(F.col("edition").alias("_e"), F.col("parent").alias("_p"), "text")
    beside = (wanted["edition"] == said["_e"]) & wanted["parent"].eqNullSafe(said["_p"]) & F.contains("text", F.left("_letters", F.lit(1)))
    found = wanted.join(said, beside).filter(F.regexp_like("text", F.col("_pattern"))).select("edition", "parent", "_letters").distinct()
    hit = made.join(found.withColumnsRenamed({"edition": "_e", "parent": "_p", "_letters": "_l"}), (F.col("edition") == F.col("_e")) & F.col("parent").eqNullSafe(F.col("_p")) & (F.col("_letters") == F.col("_l")), "left_semi")
    flags = hit.select(F.col("edition").alias("_e"), "_pre")
    out = nodes.join(flags, (F.col("edition") == F.col("_e")) & (F.col("pre") == F.col("_pre")), "left")
    return out.withColumn("computes_limit", F.when(F.col("type") == "equation", F.col("_pre").isNotNull())).drop("_e", "_pre")
