"""Helpers shared by the training-data operators."""

from __future__ import annotations

import functools
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the word rule ``[^\x20\x09-\x0D]+``.
SPACE_CLASS = "[ \\t\\n\\x0B\\f\\r]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: Folders written by the operator that runs now (see ``settled``), and folders of local sessions.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)
_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local session may leave it unset, as in tests: it gets a temporary folder.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        context = spark.sparkContext
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = _local.setdefault(context.applicationId, "") or "file://" + tempfile.mkdtemp(prefix="foliant-shared-")
        _local[context.applicationId] = where
    return where.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/foliant-{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: later stages start
    from files that outlive any executor instead of from a long lineage."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    paths = _written.get()
    if paths is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def settled(label: str):
    """For functions of a DataFrame whose result is small: it is written, and every folder
    that ``cut`` wrote on the way is removed, so that disk is held by one step at a time."""

    def wrap(f):
        @functools.wraps(f)
        def run(df: DataFrame, *args, **options) -> DataFrame:
            paths: list[str] = []
            outer = _written.set(paths)
            try:
                result = cut(f(df, *args, **options), label)
                last = paths.pop()
            finally:
                _written.reset(outer)
                for path in paths:
                    remove(df.sparkSession, path)
            if _written.get() is not None:
                _written.get().append(last)
            return result

        return run

    return wrap


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def aliased(docs: DataFrame) -> tuple[list[Column], list[str], list[str]]:
    """The columns of ``docs`` under names that nothing clashes with, these names, and the old ones.

    Operators that hand rows on work beside such columns, so extra columns may have any name.
    """
    safe = [f"__kept_{i}" for i in range(len(docs.columns))]
    return [docs[f"`{c}`"].alias(s) for c, s in zip(docs.columns, safe, strict=True)], safe, docs.columns


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, although ``body`` uses
    it inside lambdas (which would otherwise evaluate it again for every element)."""
    return F.transform(F.array(value), body)[0]


#: ``running`` adds up blocks of so many numbers.
BLOCK = 128


def running(numbers: Column, join=lambda a, x: a + x) -> Column:
    """For each number of an array, the sum of it and all before it (``array<bigint>``), or what else
    ``join`` makes of two numbers; 0 must leave a number as it is.

    ``aggregate`` copies its accumulator at every step, so a growing array costs the square of its
    size.  Numbers are therefore joined inside blocks, and then the blocks.
    """

    def within(v: Column) -> Column:
        return F.aggregate(
            v,
            F.array().cast("array<bigint>"),
            lambda acc, x: F.concat(acc, F.array(join(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0).cast("bigint")), x))),
        )

    def moved(z: Column) -> Column:
        base = lambda j: F.coalesce(F.get(z["totals"], j - 1), F.lit(0).cast("bigint"))
        return F.flatten(F.transform(z["blocks"], lambda b, j: F.transform(b, lambda x: join(base(j), x))))

    def totalled(blocks: Column) -> Column:
        totals = within(F.transform(blocks, lambda b: F.get(b, F.size(b) - 1)))
        return let(F.struct(blocks.alias("blocks"), totals.alias("totals")), moved)

    def dealt(v: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(BLOCK))
        return let(F.transform(at, lambda i: within(F.slice(v, i, BLOCK))), totalled)

    return let(numbers, dealt)


#: ``pieces`` cuts texts into so many code points.
PIECE = 1024


def pieces(text: Column) -> Column:
    """A text as pieces of ``PIECE`` code points, so that a place far inside is found at once."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def part(of: Column, at: Column, n: Column) -> Column:
    """``n`` code points from ``at`` (from 0) of a text given by its ``pieces``."""
    first, least = F.floor(at / PIECE).cast("int"), F.greatest(n, F.lit(0))
    near = F.array_join(F.slice(of, first + 1, F.floor(least / PIECE).cast("int") + 2), "")
    return F.substring(near, (at - first * PIECE + 1).cast("int"), least.cast("int"))


def find_spans(text: Column, pattern: str, *, group: int | None = None, hint: str | None = None) -> Column:
    """Leftmost non-overlapping matches of a Java pattern as
    ``array<struct<start:bigint, end:bigint, hit:string, part:string, before:string, after:string>>``.

    Offsets are code points, ``end`` exclusive; ``part`` is the capture ``group`` (the
    whole match if None); ``before``/``after`` are the texts up to the next match.  The
    texts between matches (``split``) and the matches (``regexp_extract_all``)
    alternate, so running sums of their lengths give the offsets.  The pattern must
    not match the empty string.  Texts in which ``hint`` (the pattern itself if None) finds nothing are
    not looked through.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    bundle = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        hits.alias("hits"),
        *([F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("parts")] if group else []),
    )
    empty_type = "array<struct<start:bigint,end:bigint,hit:string,part:string,before:string,after:string>>"
    empty = F.array().cast(empty_type)

    def located(z: Column) -> Column:
        sizes = F.transform(z["hits"], lambda h, i: (F.length(F.get(z["gaps"], i)) + F.length(h)).cast("bigint"))

        def spans(ends: Column) -> Column:
            return F.transform(
                z["hits"],
                lambda h, i: F.struct(
                    (F.get(ends, i) - F.length(h)).alias("start"),
                    F.get(ends, i).alias("end"),
                    h.alias("hit"),
                    F.get(z["parts" if group else "hits"], i).alias("part"),
                    F.get(z["gaps"], i).alias("before"),
                    F.get(z["gaps"], i + 1).alias("after"),
                ),
            )

        return let(running(sizes), spans)

    return F.when(text.rlike(hint or pattern), let(bundle, located)).otherwise(empty)


def digest_spans(spans: Column) -> Column:
    """``kind:start:end`` of an ordered span array, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
