"""Quality rules: robust multivariate outliers (DataFrame functions only).

Each text becomes a short vector of transformed statistics.  For every language and
source a minimum-covariance-determinant estimate is fitted by concentration steps from several
starts: repeatedly keep the closest ``coverage`` share by Mahalanobis distance and re-estimate mean
and covariance from them; the end with the least determinant counts.  A text goes if its squared distance
exceeds the chi-square quantile of ``tail``.

A concentration step is one aggregation: distances are binned on a log scale, moments
are summed per (group, bin), and the bins up to the wanted share are added up.  Groups
of any size therefore pre-aggregate before the shuffle and nothing is collected.
Groups with fewer than ``least`` texts use the estimate of their language, or of the
whole corpus where that is small too.

Defined results for odd input: a null text has no words and fails the base rule; null
language or source is a group of its own; repeated rows each count and are returned;
an empty table gives an empty result; further columns are ignored, and ``accepted`` keeps them, whatever
their names (``statistics`` takes columns to keep by name: they must not be names of its own).  Whole
texts are measured, however long; a text's words must fit in a task.  Ties in distance share a bin.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, aliased, cut, let, read_table

SYMBOLS = "#*$%&|<>"
WINDOW = 8
DIM = 6
#: Least standard deviations; a dimension in which a group hardly varies (no symbols, no
#: repeated lines) must not turn tiny differences into huge distances.
FLOOR_SD = (0.08, 0.45, 0.55, 0.6, 0.4, 0.3)
COVERAGE = 0.6
#: A text goes if a normal vector would lie so far out with at most this probability.
TAIL = 1e-6
STARTS, STEPS = 3, 5
LEAST = 40


def chi2_above(x: float, dim: int) -> float:
    """P(chi-square > x) for an even number of dimensions."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dim // 2))


def chi2_quantile(above: float, dim: int) -> float:
    low, high = 0.0, 2000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_above(middle, dim) > above else (low, middle)
    return high


def consistency(coverage: float, dim: int = DIM) -> float:
    """Makes the covariance of the closest share of a normal sample that of all of it."""
    return coverage / (1 - chi2_above(chi2_quantile(1 - coverage, dim), dim + 2))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words lying in ``WINDOW``-word windows that occur at least twice (64-bit window hashes)."""
    zero = F.lit(0).cast("bigint")

    def counted(h: Column) -> Column:
        def of_sorted(s: Column) -> Column:
            at = lambda k, name: F.get(s, k)[name]
            twice = lambda k: F.coalesce(at(k, "h") == at(k - 1, "h"), F.lit(False)) | F.coalesce(
                at(k, "h") == at(k + 1, "h"), F.lit(False)
            )
            hit = F.filter(F.sequence(F.lit(0), F.size(s) - 1), twice)
            starts = F.sort_array(F.transform(hit, lambda k: at(k, "i")))
            return let(
                starts,
                lambda p: F.aggregate(
                    F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
                    zero,
                    lambda acc, x: acc + x,
                ),
            )

        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(let(pairs, of_sorted))

    def hashed(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
        )

    return F.when(F.size(words) >= WINDOW + 1, let(let(words, hashed), counted)).otherwise(zero)


def statistics(docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """Base statistics of every whole text, beside the columns ``keep``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]"))

    def all_of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            _repeat_words(w).alias("n_repeat_words"),
            F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))).cast("bigint").alias("n_same_before"),
        )

    count = lambda chars: F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("bigint")
    return docs.select(
        *keep,
        let(words_of(text), all_of).alias("w"),
        count(SYMBOLS).alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        count("A-Z").alias("n_upper"),
    ).select("*", "w.n_words", "w.word_chars", "w.n_repeat_words", "w.n_same_before").drop("w")


def _vector() -> list[Column]:
    n = F.col("n_words") + 20
    per_hundred = lambda c: F.log1p(100 * F.col(c) / n)
    return [
        F.log((F.col("word_chars") + 100) / n),
        per_hundred("n_symbols"),
        per_hundred("n_dup_lines"),
        per_hundred("n_repeat_words"),
        F.log1p(100 * F.col("n_upper") / (F.col("word_chars") + 100)),
        per_hundred("n_same_before"),
    ]


def _x(i: int) -> str:
    return f"x{i}"


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(DIM) for j in range(i + 1)]


KEY = ["g", "start"]


def _estimate(sums: DataFrame, scale: float) -> DataFrame:
    """Mean and Cholesky factor of the regularised covariance from moment sums per group."""
    n = F.col("n")
    out = sums.select(*KEY, *[(F.col(f"s{i}") / n).alias(f"m{i}") for i in range(DIM)], *[f"p{i}_{j}" for i, j in _pairs()], "n")
    cov = {
        (i, j): (F.col(f"p{i}_{j}") / n - F.col(f"m{i}") * F.col(f"m{j}")) * scale + (FLOOR_SD[i] ** 2 if i == j else 0.0)
        for i, j in _pairs()
    }
    out = out.select(*KEY, *[f"m{i}" for i in range(DIM)], *[c.alias(f"c{i}_{j}") for (i, j), c in cov.items()])
    for j in range(DIM):
        rest = F.col(f"c{j}_{j}") - sum((F.col(f"l{j}_{k}") ** 2 for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{j}_{j}", F.sqrt(F.greatest(rest, F.lit(1e-6))))
        out = out.withColumns(
            {
                f"l{i}_{j}": (
                    F.col(f"c{i}_{j}") - sum((F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0))
                )
                / F.col(f"l{j}_{j}")
                for i in range(j + 1, DIM)
            }
        )
    return out.select(*KEY, *[f"m{i}" for i in range(DIM)], *[f"l{i}_{j}" for i, j in _pairs()])


def _distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """``start`` and squared Mahalanobis distance ``d2`` by forward substitution, for each estimate of a row's group."""
    out = rows.join(estimates, "g", "left")
    for i in range(DIM):
        inner = sum((F.col(f"l{i}_{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))
        out = out.withColumn(f"y{i}", (F.col(_x(i)) - F.col(f"m{i}") - inner) / F.col(f"l{i}_{i}"))
    d2 = sum((F.col(f"y{i}") ** 2 for i in range(DIM)), F.lit(0.0))
    return out.withColumn("d2", d2).select(*rows.columns, "start", "d2")


SUMS = ["n", *[f"s{i}" for i in range(DIM)], *[f"p{i}_{j}" for i, j in _pairs()]]


def _moments() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.sum(_x(i)).alias(f"s{i}") for i in range(DIM)],
        *[F.sum(F.col(_x(i)) * F.col(_x(j))).alias(f"p{i}_{j}") for i, j in _pairs()],
    ]


def _closest(rows: DataFrame, coverage: float) -> DataFrame:
    """Moment sums of each group's closest share of texts, by binned distance."""
    kept = F.greatest(F.lit(-40), F.least(F.lit(400), F.floor(F.log2(F.col("d2") + 1e-9) * 8))).cast("int")
    # Summed per bin over all tasks first: what is ordered in one task is a row a bin.
    bins = cut(rows.groupBy(*KEY, kept.alias("bin")).agg(*_moments()), "mcd-bins")
    group = Window.partitionBy(*KEY)
    before = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    inside = bins.withColumns(
        {"n_before": F.coalesce(F.sum("n").over(before), F.lit(0)), "n_all": F.sum("n").over(group)}
    ).filter(F.col("n_before") < coverage * F.col("n_all"))
    return inside.groupBy(*KEY).agg(*[F.sum(c).alias(c) for c in SUMS])


def _few(df: DataFrame, label: str) -> DataFrame:
    """A row a group, in one file, so that its size tells Spark whether it may be broadcast."""
    return cut(df.coalesce(1), label)


def starts(train: DataFrame) -> DataFrame:
    """Three first estimates a group: about the median with the least deviations; about the median with
    the spread between quartiles; mean and covariance of all texts."""
    quartiles = lambda c: F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10000)
    every = train.groupBy("g").agg(*_moments(), *[quartiles(_x(i)).alias(f"q{i}") for i in range(DIM)])
    every = _few(every, "mcd-moments")

    def about_median(k: int, deviation) -> DataFrame:
        return every.select(
            "g", F.lit(k).alias("start"), *[F.get(f"q{i}", F.lit(1)).alias(f"m{i}") for i in range(DIM)],
            *[(deviation(i) if i == j else F.lit(0.0)).alias(f"l{i}_{j}") for i, j in _pairs()],
        )

    spread = lambda i: F.greatest((F.get(f"q{i}", F.lit(2)) - F.get(f"q{i}", F.lit(0))) / 1.349, F.lit(FLOOR_SD[i]))
    whole = _estimate(every.select("g", F.lit(2).alias("start"), *SUMS), 1.0)
    first = about_median(0, lambda i: F.lit(FLOOR_SD[i]))
    return first.unionByName(about_median(1, spread)).unionByName(whole)


def fit(rows: DataFrame, *, coverage: float = COVERAGE, steps: int = STEPS, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``g_full, g``: the group whose estimate serves a group; and the estimates ``g, m.., l..``.

    From each of several starts concentration steps are made; of the estimates that they end in, the one
    whose covariance has the least determinant stays."""
    counted = rows.filter(~F.col("base_failed"))
    sizes = counted.groupBy("g_lang", "g_full").agg(F.count(F.lit(1)).alias("n"))
    sizes = _few(sizes, "quality-groups")
    per_lang = sizes.groupBy("g_lang").agg(F.sum("n").alias("n_lang"))
    # Rows counted in a group: its own, and all rows of a language (of the corpus) where a
    # small group falls back on that.
    fallback = _few(
        sizes.join(per_lang, "g_lang").select(
            "g_full",
            F.when(F.col("n") >= least, F.col("g_full")).when(F.col("n_lang") >= least, F.col("g_lang")).otherwise(F.lit("")).alias("g"),
        ),
        "quality-chosen",
    )
    coords = [_x(i) for i in range(DIM)]
    own = counted.join(fallback, "g_full").filter(F.col("g") == F.col("g_full")).select("g", *coords)
    used = fallback.select("g").distinct()
    wider = [
        counted.select(F.col("g_lang").alias("g"), *coords).join(used, "g", "left_semi"),
        counted.select(F.lit("").alias("g"), *coords).join(used, "g", "left_semi"),
    ]
    train = reduce(DataFrame.unionByName, wider, own)
    estimates = _few(starts(train), "mcd-0")
    for k in range(steps):
        estimates = _few(_estimate(_closest(_distance(train, estimates), coverage), consistency(coverage)), f"mcd-{k + 1}")
    size = sum((F.log(F.col(f"l{i}_{i}")) for i in range(DIM)), F.lit(0.0))
    first = F.row_number().over(Window.partitionBy("g").orderBy(F.round(size, 9), "start"))
    best = estimates.withColumn("_first", first).filter("_first = 1").drop("_first")
    return fallback, _few(best, "mcd-least")


def _rows(stats: DataFrame) -> DataFrame:
    """``base_failed``, groups and vector beside ``statistics``."""
    tag = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    own = {"base_failed": failed, "g_lang": tag("lang"), "g_full": F.concat_ws("\u0001", tag("lang"), tag("source"))}
    return stats.withColumns(own | {_x(i): c for i, c in enumerate(_vector())})


def _judged(rows: DataFrame, fallback: DataFrame, estimates: DataFrame, tail: float) -> DataFrame:
    scored = _distance(rows.join(fallback, "g_full", "left"), estimates)
    far = F.coalesce(F.col("d2") > chi2_quantile(tail, DIM), F.lit(False))
    # One condition: its parts must not be pushed below the joins and counted there again.
    kept = F.when(F.col("base_failed"), False).otherwise(~far)
    return scored.withColumns({"distance": F.col("d2"), "kept": kept}).drop("d2", "start", "g", "g_lang", "g_full", *[_x(i) for i in range(DIM)])


def judge(stats: DataFrame, *, tail: float = TAIL, **options) -> DataFrame:
    """Add ``base_failed``, ``distance`` (squared) and ``kept`` to rows of ``statistics``."""
    rows = cut(_rows(stats), "quality")
    return _judged(rows, *fit(rows, **options), tail)


def accepted(docs: DataFrame, *, tail: float = TAIL, **options) -> DataFrame:
    """The rows of ``docs`` (with ``text, lang, source``) that are kept, with all their columns.

    Texts are measured twice, once for the estimates and once for the verdicts, and never written."""
    kept, safe, names = aliased(docs)
    measured = lambda keep: _rows(statistics(docs.select(*kept, "text", "lang", "source"), keep=(*keep, "lang", "source")))
    fallback, estimates = fit(cut(measured(()), "quality"), **options)
    rows = _judged(measured(safe), fallback, estimates, tail).filter("kept")
    return rows.select(*[F.col(s).alias(n) for s, n in zip(safe, names, strict=True)])


def op2_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and verdict for every document."""
    return judge(statistics(read_table(spark, sf_dir, "documents"))).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.col("distance").alias("mahalanobis_squared"),
    )
