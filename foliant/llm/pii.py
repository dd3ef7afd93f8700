"""Personal data: bootstrapped contextual extraction (DataFrame functions only).

Seeds are the base matches: e-mail and IP addresses, card and phone numbers, each as a whole.
Seeds and runs of words with digits (or an ``@``) are instances; the words around them
are lexical patterns.  Patterns and instances form a bipartite graph that is scored in
rounds: a pattern is as good as the instances it catches, an instance as good as the
patterns that catch it.  Patterns that reach ``accept`` after the last round mark the
instances they catch as personal data of kind ``context``, although no base rule
matches them.

Defined results for odd input: a null text counts as empty; a null id is kept; repeated
rows each get their row back; whole texts are searched, however long, and as context the ``BESIDE`` characters on
either side of an instance; an empty table gives an empty result; further columns are ignored (``find`` keeps
them but for one named ``spans``, ``redact`` all of them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import aliased, cut, digest_spans, find_spans, let, part, pieces, read_table, running

SPAN = "struct<rank:int,start:bigint,kind:string,end:bigint>"
KINDS = ("email", "ip", "card", "phone", "context")
#: The base patterns, written so that a scan is linear in the text: repeats
#: that cannot be given back are possessive, and a run is entered only at its start.
PATTERNS = {
    "email": "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?<![0-9])[0-9]++(?:\\.[0-9]+){3}",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: Cheap tests that any accepted match passes.
HINTS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "(?:[0-9][\\x20-]?){13}", "phone": "\\+[0-9]"}
#: Stands for the characters of base matches where candidates are looked for; U+FFFF is no character.
MASK = "￿"
#: A word with a digit or an @ and nothing masked.
_WORD = "[^\\x20\\x09-\\x0D0-9@￿]*+[0-9@][^\\x20\\x09-\\x0D￿]*+(?![^\\x20\\x09-\\x0D])"
#: Runs of such words, a space apart; groups of capitals may lie between, before and after.
RUN = (
    f"(?<![^\\x20\\x09-\\x0D])(?:[A-Z]{{1,4}}\\x20)?+{_WORD}(?:(?<![,;:!?.])\\x20(?:[A-Z]{{1,4}}\\x20)?+{_WORD})*+"
    "(?:(?<![,;:!?.])\\x20[A-Z]{1,3}(?![^\\x20\\x09-\\x0D.,;:!?)\\]]))?+"
)
LEAD, TAIL = "^[A-Z]{1,4}\\x20", "\\x20[A-Z]{1,3}$"
#: Words of a run that are candidates of their own: with at least six digits or an @.
INSTANCE = (
    "(?<![^\\x20\\x09-\\x0D])(?=[^\\x20\\x09-\\x0D@]*+@|(?:[^\\x20\\x09-\\x0D0-9]*+[0-9]){6})[^\\x20\\x09-\\x0D]+"
)
#: Of the text beside an instance only so much is looked at.
BESIDE = 200
PLACE = "struct<start:bigint,end:bigint,instance:string,run:bigint,whole:boolean,seed:boolean>"
#: Discovered spans up to this many (under 100 bytes each) are broadcast to their texts; more are joined by a shuffle.
BROADCAST_SPANS = 200_000
ROUNDS, ACCEPT, SUPPORT = 3, 0.9, 5


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    places = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), value)
    return F.aggregate(places, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def _holds(kind: str, hit: Column) -> Column:
    n = F.length(_digits(hit))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$")
        return F.forall(F.split(hit, "\\."), small)
    if kind == "phone":
        return n.between(9, 15)
    return n.between(13, 19) & _luhn(_digits(hit))


def base_spans(text: Column) -> Column:
    """Base matches ordered by kind, then start."""

    def of(rank: int, kind: str) -> Column:
        return F.transform(
            F.filter(find_spans(text, PATTERNS[kind], hint=HINTS[kind]), lambda s: _holds(kind, s["hit"])),
            lambda s: F.struct(
                F.lit(rank).alias("rank"), s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")
            ),
        )
    return F.concat(*[of(rank, kind) for rank, kind in enumerate(PATTERNS)])


def _reached(spans: Column) -> Column:
    """For each of the spans, ordered by start, the furthest end up to and with it."""
    return running(F.transform(spans, lambda s: s["end"]), F.greatest)


def _seeds(text: Column, base: Column) -> Column:
    """``seeds``: base matches that do not overlap an earlier one; ``masked``: the text with all matches masked."""

    def of(z: Column) -> Column:
        text_part = lambda at, n: part(z["pieces"], at, n)
        before = lambda i: F.coalesce(F.get(z["ends"], i - 1), F.lit(0).cast("bigint"))

        def seed(s: Column) -> Column:
            return F.struct(
                s["start"].alias("start"), s["end"].alias("end"), text_part(s["start"], s["end"] - s["start"]).alias("instance"),
                s["start"].alias("run"), F.lit(True).alias("whole"), F.lit(True).alias("seed"),
            )

        def masked(s: Column, i: Column) -> Column:
            start = F.greatest(s["start"], before(i))
            hidden = F.repeat(F.lit(MASK), F.greatest(s["end"] - start, F.lit(0)).cast("int"))
            return F.concat(text_part(before(i), start - before(i)), hidden)

        last = F.get(z["ends"], F.size(z["ends"]) - 1)
        return F.struct(
            F.transform(F.filter(z["spans"], lambda s, i: s["start"] >= before(i)), seed).alias("seeds"),
            F.concat(F.array_join(F.transform(z["spans"], masked), ""), text_part(last, F.length(text) - last)).alias("masked"),
        )

    by_start = F.array_sort(base, lambda x, y: F.when(x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(F.signum(y["end"] - x["end"])).cast("int"))
    none = F.struct(F.array().cast(f"array<{PLACE}>").alias("seeds"), text.alias("masked"))
    bundle = lambda b: F.struct(b.alias("spans"), _reached(b).alias("ends"), pieces(text).alias("pieces"))
    return F.when(F.size(base) > 0, let(by_start, lambda b: let(bundle(b), of))).otherwise(none)


def _candidates(masked: Column) -> Column:
    """Runs of words with digits, without and with the capitals around them, and long words inside them."""

    def place(start: Column, hit: Column, run: Column, whole: bool) -> Column:
        lead = F.length(F.regexp_extract(hit, "^[^A-Za-z0-9+@]*", 0))
        core = F.regexp_replace(F.regexp_replace(hit, "^[^A-Za-z0-9+@]+", ""), "[^A-Za-z0-9]+$", "")
        return F.struct(
            (start + lead).alias("start"), (start + lead + F.length(core)).alias("end"), core.alias("instance"),
            run.alias("run"), F.lit(whole).alias("whole"), F.lit(False).alias("seed"),
        )

    def of(s: Column) -> Column:
        lead = F.length(F.regexp_extract(s["hit"], LEAD, 0))
        inner = F.regexp_replace(F.regexp_replace(s["hit"], LEAD, ""), TAIL, "")
        core = F.array(place(s["start"] + lead, inner, s["start"], True))
        full = F.when(lead > 0, F.array(place(s["start"], s["hit"], s["start"], True))).otherwise(F.array().cast(f"array<{PLACE}>"))
        words = F.transform(find_spans(s["hit"], INSTANCE), lambda w: place(s["start"] + w["start"], w["hit"], s["start"], False))
        several = F.when(inner.contains(" "), words).otherwise(F.array().cast(f"array<{PLACE}>"))
        return F.concat(core, full, several)

    return F.filter(F.flatten(F.transform(find_spans(masked, RUN), of)), lambda o: o["instance"] != "")


def _instances(text: Column, places: Column) -> Column:
    """``places`` with the two words before and the one after."""
    word = lambda gap, pattern: F.lower(F.regexp_extract(gap, pattern, 1))

    def of_blocks(blocks: Column) -> Column:
        def beside(at: Column) -> Column:
            return part(blocks, at, F.lit(BESIDE))

        def one(s: Column) -> Column:
            from_ = F.greatest(s["start"] - BESIDE, F.lit(0).cast("bigint"))
            before = F.left(beside(from_), (s["start"] - from_).cast("int"))
            # Brackets and the like that touch the instance are not words.
            left = F.regexp_replace(before, "(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D\\p{L}\\p{N}]+$", "")
            right = F.regexp_replace(beside(s["end"]), "^[^\\x20\\x09-\\x0D\\p{L}\\p{N}]+", "")
            return F.struct(
                *[s[c].alias(c) for c in ("start", "end", "instance", "run", "whole", "seed")],
                word(left, "([^\\x20\\x09-\\x0D]*)[\\x20\\x09-\\x0D]*$").alias("l1"),
                word(left, "([^\\x20\\x09-\\x0D]*)[\\x20\\x09-\\x0D]+[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*$").alias("l2"),
                word(right, "^[\\x20\\x09-\\x0D]*([^\\x20\\x09-\\x0D]*)").alias("r1"),
            )

        return F.transform(places, one)

    empty = F.array().cast("array<struct<start:bigint,end:bigint,instance:string,run:bigint,whole:boolean,seed:boolean,l1:string,l2:string,r1:string>>")
    return F.when(F.size(places) > 0, let(pieces(text), of_blocks)).otherwise(empty)


def _patterns(o: Column) -> Column:
    return F.array(
        F.concat(F.lit("L "), o["l1"]),
        F.concat(F.lit("LL "), o["l2"], F.lit(" "), o["l1"]),
        F.concat(F.lit("LR "), o["l1"], F.lit(" _ "), o["r1"]),
    )


def _marked(text: Column) -> Column:
    """Base spans, and instances with their contexts.  Each step is computed once a row."""
    words = lambda z: let(F.concat(z["seeds"], _candidates(z["masked"])), lambda p: _instances(text, p))
    return let(base_spans(text), lambda b: F.struct(b.alias("base"), let(_seeds(text, b), words).alias("words")))


def _all_spans(base: Column, extra: Column) -> Column:
    return F.concat(base, F.coalesce(extra, F.array().cast(f"array<{SPAN}>")))


def find(
    docs: DataFrame, *, text_col: str = "text", keep: list[str] | None = None, rounds: int = ROUNDS, accept: float = ACCEPT, support: int = SUPPORT
) -> DataFrame:
    """All rows of ``docs`` with ``spans``: base matches first by kind, discovered ones last.

    Of the columns of ``docs`` only ``keep`` travel on (all if None)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    kept, safe, names = aliased(docs.select(*[F.col(f"`{c}`") for c in keep]) if keep is not None else docs)
    rows = cut(docs.select(*kept, F.monotonically_increasing_id().alias("_row"), _marked(text).alias("_both")), "pii")
    found = discover(rows.select("_row", F.col("_both.words").alias("_words")), rounds=rounds, accept=accept, support=support)
    out = [F.col(s).alias(n) for s, n in zip(safe, names, strict=True) if n != "spans"]
    return rows.join(found, "_row", "left").select(*out, _all_spans(F.col("_both.base"), F.col("_extra")).alias("spans"))


def discover(rows: DataFrame, *, rounds: int, accept: float, support: int) -> DataFrame:
    """``_row, _extra``: spans that only the context gives away."""
    occurrences = rows.select("_row", F.explode("_words").alias("o")).select(
        "_row", "o", F.col("o.seed").alias("seed"), F.explode(_patterns(F.col("o"))).alias("pattern")
    )
    edges = cut(
        occurrences.groupBy("pattern", F.col("o.instance").alias("instance")).agg(F.max("seed").alias("seed")),
        "pii-edges",
    )
    score = None
    for k in range(rounds):
        scored = edges if score is None else edges.join(score, "instance", "left")
        # Instances accepted in the round before support new patterns as seeds do.
        trusted = F.col("seed") if score is None else F.col("seed") | F.coalesce(F.col("score") >= accept, F.lit(False))
        value = F.when(F.col("seed"), 1.0).otherwise(F.lit(0.0) if score is None else F.coalesce("score", F.lit(0.0)))
        patterns = cut(
            scored.groupBy("pattern")
            .agg(F.sum(value).alias("good"), F.count(F.lit(1)).alias("n"), F.count_if(trusted).alias("support"))
            .filter(F.col("support") >= support)
            .select("pattern", (F.col("good") / (F.col("n") + 0.5)).alias("worth"))
            .filter(F.col("worth") >= 0.5),
            f"pii-patterns-{k}",
        )
        if k + 1 < rounds:
            score = cut(
                edges.filter(~F.col("seed"))
                .join(patterns, "pattern")
                .groupBy("instance")
                .agg((1 - F.exp(F.sum(F.log1p(-F.least(F.col("worth"), F.lit(0.999)))))).alias("score")),
                f"pii-instances-{k}",
            )
    good = patterns.filter(F.col("worth") >= accept).select("pattern")
    span = lambda start, end: F.struct(
        F.lit(KINDS.index("context")).alias("rank"), start.alias("start"), F.lit("context").alias("kind"), end.alias("end")
    )
    hits = occurrences.filter(~F.col("seed")).join(good, "pattern", "left_semi").select("_row", "o.run", "o.whole", "o.start", "o.end")
    # Of a run that is caught as a whole, the words inside are not named again.
    runs = hits.groupBy("_row", "run").agg(
        F.min(F.when(F.col("whole"), F.col("start"))).alias("start"),
        F.max(F.when(F.col("whole"), F.col("end"))).alias("end"),
        F.collect_set(span(F.col("start"), F.col("end"))).alias("words"),
    )
    spans = F.when(F.col("start").isNotNull(), F.array(span(F.col("start"), F.col("end")))).otherwise(F.col("words"))
    return runs.select("_row", spans.alias("spans")).groupBy("_row").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("_extra"))


def redact(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind, ``[EMAIL]`` and so on.

    Overlapping spans are one replacement, named by the first; ``n_chars``, if there, follows."""
    kept, safe, names = aliased(docs)
    at = safe[names.index("text")]
    text = F.col(at).cast("string")

    def replaced(spans: Column) -> Column:
        def of(z: Column) -> Column:
            before = lambda i: F.coalesce(F.get(z["ends"], i - 1), F.lit(0).cast("bigint"))

            def fresh(s: Column, i: Column) -> Column:
                said = F.concat(part(z["pieces"], before(i), s["start"] - before(i)), F.lit("["), F.upper(s["kind"]), F.lit("]"))
                return F.when(s["start"] >= before(i), said).otherwise("")

            last = F.get(z["ends"], F.size(z["ends"]) - 1)
            return F.concat(F.array_join(F.transform(spans, fresh), ""), part(z["pieces"], last, F.length(text) - last))

        return let(F.struct(_reached(spans).alias("ends"), pieces(text).alias("pieces")), of)

    by_start = F.sort_array(
        F.transform(F.col("spans"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    # Spans depend on the text alone, so discovered ones come back by its hashes and no text is written.
    whole = F.coalesce(text, F.lit(""))
    key = F.struct(F.xxhash64(whole).alias("a"), F.xxhash64(F.lit(7), whole).alias("b")).alias("_row")
    rows = docs.select(*kept)
    marked = rows.select(key, _marked(whole)["words"].alias("_words")).filter(F.size("_words") > 0)
    extra = cut(discover(cut(marked, "pii"), **(dict(rounds=ROUNDS, accept=ACCEPT, support=SUPPORT) | options)), "pii-extra")
    if (extra.agg(F.sum(F.size("_extra"))).first()[0] or 0) <= BROADCAST_SPANS:
        extra = F.broadcast(extra)
    found = rows.select(*safe, key, base_spans(whole).alias("_base")).join(extra, "_row", "left")
    found = found.select(*safe, _all_spans(F.col("_base"), F.col("_extra")).alias("spans"))
    changed = F.size("spans") > 0
    fresh = found.withColumn("_text", F.when(changed, let(by_start, replaced)))

    def out(s: str, name: str) -> Column:
        if name == "text":
            return F.coalesce("_text", s).alias(name)
        if name == "n_chars":
            return F.when(F.col("_text").isNotNull(), F.length("_text")).otherwise(F.col(s)).cast(docs.schema[name].dataType).alias(name)
        return F.col(s).alias(name)

    return fresh.select(*[out(s, n) for s, n in zip(safe, names, strict=True)])


def op5_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts and digest, and all spans."""
    found = find(read_table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["rank"] < 4)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS[:4]],
        F.sha2(digest_spans(base), 256).alias("base_sha256"),
        digest_spans(F.col("spans")).alias("spans"),
    )
