"""The language of a text, by its script or its frequent short words (no model; JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import lexicon as lx


def detect(text: Column) -> Column:
    """Tag of the language; null if the text is null, short, or too like two languages.

    A script of its own decides if half the letters are in it (a text with kana is Japanese, whatever
    its share of Han).  Else the languages' short words are counted: a language's confidence is its count's
    share in the two highest counts, and ties are uncertain.
    """
    length = lambda kept: F.length(F.regexp_replace(text, f"[^{kept}]+", ""))
    letters = length("\\p{L}")
    script = F.coalesce(*[
        F.when((length(chars + (lx.SCRIPTS["zh"] if code == "ja" else "")) * 2 >= letters) & (length(chars) > 0), code)
        for code, chars in lx.SCRIPTS.items()
    ])
    words = F.split(F.lower(text), "[^\\p{L}]+")

    def by_words(w: Column) -> Column:
        count = lambda known: F.size(F.filter(w, lambda x: x.isin(*known)))
        counts = [F.struct(count(known).alias("n"), F.lit(code).alias("code")) for code, known in lx.STOP_WORDS.items()]
        return F.get(F.transform(F.array(F.reverse(F.sort_array(F.array(*counts)))), _surest), F.lit(0))

    found = F.get(F.transform(F.array(words), by_words), F.lit(0))
    return F.when(F.length(text) >= lx.MIN_LANGUAGE_CHARS, F.when(letters > 0, F.coalesce(script, found)))


def _surest(ordered: Column) -> Column:
    first, second = F.get(ordered, F.lit(0)), F.get(ordered, F.lit(1))["n"]
    return F.when((first["n"] > 0) & (first["n"] >= lx.MIN_LANGUAGE_CONFIDENCE * (first["n"] + second)), first["code"])
