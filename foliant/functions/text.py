"""Text forms and text tests as Spark columns.

Unicode normal forms have no Spark function; those few run as pandas functions over
Arrow batches, everything else stays in the JVM.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import lexicon as lx

_SHIELD = {c: chr(0xE000 + i) for i, c in enumerate(lx.SUPERSCRIPT + lx.SUBSCRIPT)}
_UNSHIELD = {v: k for k, v in _SHIELD.items()}


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


@F.pandas_udf(T.StringType())
def _nfkc_shielded(s: pd.Series) -> pd.Series:
    def one(t: str | None) -> str | None:
        if t is None:
            return None
        shielded = t.translate(str.maketrans(_SHIELD))
        return unicodedata.normalize("NFKC", shielded).translate(str.maketrans(_UNSHIELD))

    return s.map(one)


@F.pandas_udf(T.StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(T.StringType())
def folded(s: pd.Series) -> pd.Series:
    """NFC, casefold, white space to single spaces."""
    return s.map(lambda t: None if t is None else " ".join(unicodedata.normalize("NFC", t).casefold().split()))


@F.pandas_udf(T.StringType())
def bare(s: pd.Series) -> pd.Series:
    """NFKD, casefold, without combining marks, trimmed: the form headings are matched in."""

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        return "".join(c for c in unicodedata.normalize("NFKD", t.strip().casefold()) if not unicodedata.combining(c))

    return s.map(one)


@F.pandas_udf(T.BooleanType())
def is_nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.is_normalized("NFC", t))


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def compare_form(text: Column) -> Column:
    """What two parsers' texts are compared in; never touches case, signs or scripts."""
    t = F.regexp_replace(_nfkc_shielded(text), "-\n", "")
    t = F.translate(t, "\u00ad\u2013\u2014\u2015", "\u00ad---")
    return squeezed(F.regexp_replace(t, "\u00ad", ""))


def same_content(a: Column, b: Column) -> Column:
    fold = lambda x: F.regexp_replace(F.translate(_nfkc(x), "\u2212\u2013\u2014\u2015", "----"), r"(?U)\s+", "")
    return fold(a) == fold(b)


def preferred(raw: Column, text: Column) -> Column:
    """The run-derived text where it says the same as the plain one."""
    has = lambda c: F.coalesce(F.length(c), F.lit(0)) > 0
    return (
        F.when(has(raw) & has(text) & same_content(raw, text), raw)
        .when(has(text), text)
        .when(has(raw), raw)
        .otherwise(F.lit(""))
    )


def raw_text(runs: Column) -> Column:
    """Text of an array of runs ``(text, vertical_align)``, raised and lowered digits in Unicode."""
    return F.array_join(
        F.transform(
            runs,
            lambda r: F.when(r["vertical_align"] == "superscript", F.translate(r["text"], lx.PLAIN, lx.SUPERSCRIPT))
            .when(r["vertical_align"] == "subscript", F.translate(r["text"], lx.PLAIN_SUB, lx.SUBSCRIPT))
            .otherwise(r["text"]),
        ),
        "",
    )


def content_words(text: Column) -> Column:
    """Distinct words of at least three letters."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\p{L}{3,}"), F.lit(0)))


def numeric_tokens(text: Column) -> Column:
    """Distinct tokens with a digit, whole."""
    return F.array_distinct(F.filter(F.split(squeezed(F.lower(text)), " "), lambda t: t.rlike("[0-9]")))


def language(lang: Column) -> Column:
    """Lexicon language of a tag: its first part where known, else English."""
    key = F.lower(F.substring_index(F.coalesce(lang, F.lit("en")), "-", 1))
    return F.when(key.isin(*lx.MODALS), key).otherwise("en")


def by_language(lang: Column, build) -> Column:
    """``build(language)`` for the lexicon language of each row."""
    first, *rest = lx.MODALS
    out = F.when(language(lang) == rest[0], build(rest[0])).when(language(lang) == rest[1], build(rest[1]))
    return out.otherwise(build(first))


def modals(text: Column, lang: Column) -> Column:
    """Modal surfaces in order, as written; longer ones win over their beginnings."""

    def found(code: str) -> Column:
        pattern = "|".join(sorted(lx.MODALS[code], key=len, reverse=True))
        return F.regexp_extract_all(text, F.lit(rf"(?iU)\b({pattern})\b"), F.lit(1))

    return by_language(lang, found)


def modal_role(text: Column, lang: Column) -> Column:
    def role(code: str) -> Column:
        table = F.create_map(*[F.lit(x) for pair in lx.MODALS[code].items() for x in pair])
        return F.transform(modals(text, lang), lambda m: F.element_at(table, F.lower(m)))

    roles = by_language(lang, role)
    return F.coalesce(*[F.when(F.array_contains(roles, r), F.lit(r)) for r in lx.ROLE_ORDER])


def admonition_role(text: Column, lang: Column) -> Column:
    head = F.substring(F.lower(F.trim(text)), 1, 40)
    return F.when(by_language(lang, lambda c: head.rlike("^(" + "|".join(lx.ADMONITIONS[c]) + r")\b")), F.lit("Warning"))


def heading_role(text: Column, lang: Column) -> Column:
    """Role of a section heading after a leading clause number."""
    name = F.regexp_replace(F.lower(F.trim(text)), r"^\s*\d+(\.\d+)*\s+", "")

    def role(code: str) -> Column:
        out = F.lit(None).cast("string")
        for heading, value in lx.SECTION_ROLES[code].items():
            out = F.when(name == heading, F.lit(value)).otherwise(out)
        return out

    return by_language(lang, role)


def filled(value: Column) -> Column:
    """The value, null if empty; evaluated once, where ``nullif`` would evaluate it twice."""
    return F.get(F.filter(F.array(value), lambda v: v != ""), F.lit(0))


def clause_of_heading(text: Column) -> Column:
    """Clause of a section or heading: annex, leading number, or dotted number at the end."""
    t = F.trim(text)
    got = lambda pattern: filled(F.regexp_extract(t, pattern, 1))
    annex = got(lx.ANNEX_CLAUSE)
    return F.coalesce(
        F.concat(F.lit("Annex "), F.upper(annex)),
        got(lx.LEADING_CLAUSE),
        got(lx.TRAILING_CLAUSE),
    )


def clause_of_body(text: Column, most_words: Column | int) -> Column:
    """Clause of a list item or paragraph: a leading dotted number before a short title."""
    t = F.trim(text)
    title = F.regexp_replace(t, r"(\s*\([^)]*\)\s*)+$", "")
    short = F.size(F.filter(F.split(title, r"\s+"), lambda w: w != "")) <= most_words
    number = filled(F.regexp_extract(t, lx.NUMBERED_TITLE, 1))
    return F.when(short, number)


def clause_id(kind: Column, text: Column) -> Column:
    most = F.when(kind == "list_item", 12).otherwise(6)
    return F.when(kind.isin("section", "heading"), clause_of_heading(text)).when(
        kind.isin("list_item", "paragraph"), clause_of_body(text, most)
    )


def numeric_parts(clause: Column) -> Column:
    """``5.3.1`` as [5, 3, 1]; null for annexes and other labels."""
    return F.when(clause.rlike(r"^\d{1,3}(\.\d{1,3})*$"), F.transform(F.split(clause, r"\."), lambda x: x.cast("int")))


def is_prefix(a: Column, b: Column) -> Column:
    """a is a strict prefix of b."""
    return (F.size(a) < F.size(b)) & (F.slice(b, F.lit(1), F.size(a)) == a)


def triage(text: Column, n_images: Column) -> Column:
    """Struct ``page_class, char_count, garbage, cid, long``."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    n = F.greatest(F.size(words), F.lit(1))
    chars = F.length(text)
    garbage = F.coalesce((chars - F.length(F.regexp_replace(text, "\ufffd", ""))) / F.nullif(chars, F.lit(0)), F.lit(0.0))
    cid = F.regexp_count(text, F.lit(r"\(cid:\d+\)")) / n
    long = F.size(F.filter(words, lambda w: F.length(w) >= 25)) / n
    clean = (garbage <= lx.MAX_GARBAGE) & (cid <= lx.MAX_CID) & (long <= lx.MAX_LONG)
    kind = (
        F.when(chars < lx.MIN_CHARS, F.when(n_images > 0, "SCANNED").otherwise("UNCERTAIN"))
        .when(clean, "DIGITAL_CLEAN")
        .otherwise("DIGITAL_DIRTY")
    )
    return F.struct(kind.alias("page_class"), chars.alias("char_count"), garbage.alias("garbage"), cid.alias("cid"), long.alias("long"))


def pseudo_lines(text: Column) -> Column:
    """Entries that end in a page number; the whole text if there are none."""
    found = F.transform(
        F.regexp_extract_all(text, F.lit(lx.ENTRY_END), F.lit(0)), lambda x: F.trim(x)
    )
    return F.when(F.size(found) > 0, found).otherwise(F.array(text))


def references(text: Column) -> Column:
    """Array of (kind, surface): clauses, annexes, tables, figures, each once, in that order.

    Lead words must stand alone and numbers must end: "temper 5" and "per 61000-4" are no references.
    """
    number = r"\d{1,3}(?:\.\d{1,3})*(?![\d-])"
    leads = "|".join(re.escape(lead).replace(r"\ ", r"\s+") for lead in lx.REFERENCE_LEADS)
    kinds = (
        ("clause", rf"(?iU)\b(?:{leads})\s*\[?\s*({number})\s*\]?", lambda x: x),
        ("annex", r"(?iU)\b(?:annex|anhang|annexe)\s+([A-Z]{1,3}(?:\.\d{1,3})*)\b", lambda x: F.concat(F.lit("Annex "), F.upper(x))),
        ("table", rf"(?iU)\b(?:table|tabelle)\s+({number})", lambda x: F.concat(F.lit("Table "), x)),
        ("figure", rf"(?iU)\b(?:figure|fig\.?|bild|abbildung)\s+({number})", lambda x: F.concat(F.lit("Figure "), x)),
    )

    def of(kind: str, pattern: str, surface) -> Column:
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        return F.transform(hits, lambda x: F.struct(F.lit(kind).alias("kind"), surface(x).alias("surface")))

    return F.array_distinct(F.concat(*[of(*k) for k in kinds]))
