"""Mixing sources to target weights: subset-sum budget fitting.

Each source has a target in words.  As many whole passes over the source as fit are
taken; of the budget left, every length gets its proportional number of documents, and
a bounded-knapsack dynamic programme over the remaining documents, counted by exact
length, spends the rest to the word where the lengths allow it.  Which documents of a
length are taken follows a seeded hash order, so that reruns agree.

A source's lengths are planned in one task, from a histogram with one row per distinct
length.  Targets are computed from one row per source.  The hash up to which documents of a length are
taken is found from counts of hash buckets and the rows of one bucket, so a common length is not ordered
in one task, and documents are not shuffled to be taken.

Defined results for odd input: a null or empty text has size 0 and is never taken; null
is a source of its own, last in order; repeated rows count and are chosen each, as many of them as
are wanted; a very long text counts as a whole; an empty table gives an empty result; further columns
are ignored (``choose`` and ``mix`` keep them; ``choose`` replaces columns that have the names of its own).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, aliased, cut, read_table

WEIGHTS = (3, 1, 2)
SHARE, CAP, SEED = 1.5, 2, 17
#: Budgets above this are first lowered by whole documents; the dynamic programme has one cell a word.
CELLS = 1 << 16
#: A plan of at most this many rows (about 60 bytes each) is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 200_000


def targets(sources: DataFrame, *, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``source, source_size`` with ``target``: shares of ``share`` x all words by weight, no
    source above ``cap`` times its size, what is cut off shared again by weight.

    With sources in the order of cap / weight, the capped ones come first: source i is
    capped if the level that its followers would get exceeds its own cap / weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    s = sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(cap))
    s = s.withColumn("ratio", F.col("most") / F.col("weight"))
    every = Window.partitionBy()
    rank = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    capped = F.coalesce(F.sum("most").over(rank.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = (share * F.sum("source_size").over(every) - capped) / F.sum("weight").over(rank.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", level)
    s = s.withColumn("water", F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")), F.when(F.col("level") <= F.col("ratio"), F.col("ratio"))).over(every))
    return s.select(
        "source", "source_size", F.when(F.col("level") > F.col("ratio"), F.col("most")).otherwise(
            F.least("most", F.coalesce("water", F.lit(0.0)) * F.col("weight"))
        ).alias("target"),
    )


def plan_source(lengths: np.ndarray, counts: np.ndarray, target: float, *, cap: int = CAP) -> tuple[int, np.ndarray]:
    """Whole passes, and how many documents of each length are taken once more."""
    total = int((lengths * counts).sum())
    extra = np.zeros(len(lengths), np.int64)
    if total == 0:
        return 0, extra
    passes = min(cap, int(target // total))
    if passes == cap:
        return passes, extra
    budget = int(round(target - passes * total))
    share = min(1.0, budget / total)
    extra = np.where(lengths > 0, np.floor(counts * share).astype(np.int64), 0)
    rest = budget - int((extra * lengths).sum())
    left = np.where(lengths > 0, counts - extra, 0)
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= CELLS:
            break
        n = min(int(left[i]), (rest - CELLS) // int(lengths[i]) + 1, rest // int(lengths[i])) if lengths[i] else 0
        extra[i] += n
        left[i] -= n
        rest -= n * int(lengths[i])
    return passes, extra + knapsack(lengths, left, rest)


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Counts of lengths, each at most ``counts``, whose sum comes closest to ``budget`` from below."""
    used = np.zeros(len(lengths), np.int64)
    if budget <= 0:
        return used
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    by = np.full(budget + 1, -1, np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        step, fresh = int(lengths[i]), reached
        if step <= 0 or step > budget:
            continue
        for _ in range(int(counts[i])):
            grown = np.zeros(budget + 1, bool)
            grown[step:] = fresh[:-step]
            grown &= ~reached
            if not grown.any():
                break
            reached = reached | grown
            by[grown] = i
            fresh = grown
        if reached[budget]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at:
        used[by[at]] += 1
        at -= int(lengths[by[at]])
    return used


def _measured(text: Column, doc_id: Column, source: Column, seed: int) -> dict[str, Column]:
    """Source key, size and seeded hash of a row."""
    words = F.size(F.filter(F.split(text, SPACE_CLASS), lambda w: w != ""))
    return {
        "_key": F.coalesce(F.concat(F.lit("="), source), F.lit("-")),
        "_size": F.greatest(F.coalesce(words, F.lit(0)), F.lit(0)).cast("bigint"),
        "_hash": F.xxhash64(F.lit(seed), doc_id, F.coalesce(text, F.lit(""))),
    }


def plan(docs: DataFrame, *, weights=WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """For each source and size what is taken of its rows: all of them ``passes`` times, and once more
    those whose hash comes before (``_bucket``, ``_last``), of the ``ties`` rows at that hash ``of_ties``.

    A row per source and distinct size: ``_key, _size, source_size, target, passes, _edge, _last, ties, of_ties``.
    """
    text = F.col("text").cast("string")
    measured = _measured(text, F.col("doc_id"), F.col("source"), seed)
    rows = cut(docs.select(*[c.alias(n) for n, c in measured.items()], "source").withColumn("_bucket", F.shiftrightunsigned("_hash", 54)), "mix")
    buckets = cut(rows.groupBy("_key", "_size", "_bucket").agg(F.count(F.lit(1)).alias("n"), F.min("source").alias("source")), "mix-buckets")
    histogram = buckets.groupBy("_key", "_size").agg(F.sum("n").alias("n"), F.min("source").alias("source"))
    sources = histogram.groupBy("_key").agg(F.sum(F.col("n") * F.col("_size")).alias("source_size"), F.min("source").alias("source"))
    aims = cut(targets(sources.select("source", "source_size"), weights=weights, share=share, cap=cap), "mix-targets")
    aims = aims.select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-")).alias("_key"), "source_size", "target")

    def of_source(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_size")
        passes, extra = plan_source(group["_size"].to_numpy(), group["n"].to_numpy(), float(group["target"].iloc[0]), cap=cap)
        return group.assign(passes=passes, extra=extra)[["_key", "_size", "source_size", "target", "passes", "extra"]]

    planned = cut(
        histogram.join(aims, "_key").select("_key", "_size", "n", "source_size", "target")
        .groupBy("_key").applyInPandas(of_source, "_key string, _size bigint, source_size bigint, target double, passes int, extra bigint"),
        "mix-plan",
    )
    # The bucket in which the last row taken lies, and the hash of that row: only rows of such buckets are ordered.
    ahead = Window.partitionBy("_key", "_size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    edges = buckets.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).join(planned, ["_key", "_size"])
    edges = edges.filter((F.col("ahead") < F.col("extra")) & (F.col("ahead") + F.col("n") >= F.col("extra")))
    edges = cut(edges.select("_key", "_size", "_bucket", (F.col("extra") - F.col("ahead")).alias("more")), "mix-edges")
    hashes = rows.join(edges, ["_key", "_size", "_bucket"]).groupBy("_key", "_size", "_bucket", "more", "_hash").agg(F.count(F.lit(1)).alias("ties"))
    upto = Window.partitionBy("_key", "_size").orderBy("_hash")
    hashes = hashes.withColumn("before", F.sum("ties").over(upto) - F.col("ties"))
    last = hashes.filter((F.col("before") < F.col("more")) & (F.col("before") + F.col("ties") >= F.col("more")))
    last = last.select("_key", "_size", F.col("_bucket").alias("_edge"), F.col("_hash").alias("_last"), "ties", (F.col("more") - F.col("before")).alias("of_ties"))
    return planned.drop("extra").join(last, ["_key", "_size"], "left")


def choose(docs: DataFrame, *, keep: list[str] | None = None, **options) -> DataFrame:
    """All rows of ``docs`` with ``size, source_size, target`` and ``copies`` (how often the mix takes it).

    Of the columns of ``docs`` only ``keep`` travel on (all if None); one of the four names is replaced.
    Texts are read twice and never written; which rows are taken depends on their hashes alone.
    """
    own = ("size", "source_size", "target", "copies")
    names = [c for c in (docs.columns if keep is None else keep) if c not in own]
    kept = [F.col(f"`{c}`").alias(f"__kept_{i}") for i, c in enumerate(names)]
    seed = options.get("seed", SEED)
    planned = cut(plan(docs, **options).coalesce(1), "mix-last")
    if planned.count() <= BROADCAST_ROWS:
        planned = F.broadcast(planned)
    measured = _measured(F.col("text").cast("string"), F.col("doc_id"), F.col("source"), seed)
    rows = docs.select(*kept, *[c.alias(n) for n, c in measured.items()]).join(planned, ["_key", "_size"])
    bucket = F.shiftrightunsigned("_hash", 54)
    taken = (bucket < F.col("_edge")) | ((bucket == F.col("_edge")) & (F.col("_hash") <= F.col("_last")))
    once_more = F.coalesce(taken, F.lit(False)).cast("int")
    out = lambda copies: [
        *[F.col(f"__kept_{i}").alias(n) for i, n in enumerate(names)],
        F.col("_size").alias("size"), "source_size", "target", F.when(F.col("_size") > 0, F.col("passes") + copies).otherwise(0).alias("copies"),
    ]
    if planned.filter("ties > of_ties").isEmpty():
        return rows.select(*out(once_more))
    # Repeated rows at the last hash: so many of them as are wanted.
    tied = F.coalesce((F.col("_hash") == F.col("_last")) & (F.col("ties") > F.col("of_ties")), F.lit(False))
    some = rows.filter(tied).withColumn("_n", F.row_number().over(Window.partitionBy("_key", "_size").orderBy("_hash")))
    return rows.filter(~tied).select(*out(once_more)).unionByName(some.select(*out((F.col("_n") <= F.col("of_ties")).cast("int"))))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``."""
    kept, safe, names = aliased(docs)
    taken = choose(docs.select(*kept, "doc_id", "source", "text"), keep=safe, **options).filter("copies > 0")
    rows = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(*[F.col(s).alias(n) for s, n in zip(safe, names, strict=True)])


def op4_mix_knapsack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, source, target and taken words of every document."""
    return choose(read_table(spark, sf_dir, "documents"), keep=["doc_id"]).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
