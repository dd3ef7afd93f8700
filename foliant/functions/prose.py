"""Limit values stated in sentences.

A sentence is read into tokens (numbers, signs, words); numbers are then joined with the signs and the
number beside them and the unit after them into statements, and each statement gets its bound
from what stands before it.  Offsets matter, so this runs in Python, on Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import lexicon as lx

_TOKEN = re.compile(r"(?P<number>(?:\d{1,3}(?:\s\d{3})+(?!\d)|\d+)(?:[.,]\d+)*)|(?P<bound><=|>=|[<>≤≥])|(?P<word>[^\W\d]\w*)|(?P<sign>[^\w\s])")
_LONGEST_UNIT = max(map(len, lx.UNITS))
_DASHES, _JOINTS = frozenset("-–—"), frozenset(lx.RANGE_WORDS)


@dataclass
class Token:
    kind: str
    start: int
    end: int
    text: str


def decimal(surface: str, lang: str | None) -> Decimal | None:
    """The Python twin of ``values.decimal``."""
    digits = "".join(surface.split())
    last = max(digits, key=lambda c: digits.rfind(c) if c in ",." else -1, default="")
    if "," in digits and "." in digits:
        other = "," if last == "." else "."
        digits = digits.replace(other, "").replace(",", ".")
    elif "," in digits:
        head, *groups = digits.split(",")
        local = (lang or "").split("-")[0].lower() in lx.COMMA_LANGUAGES
        thousands = not local and 1 <= len(head) <= 3 and head.isdigit() and all(len(g) == 3 and g.isdigit() for g in groups)
        digits = digits.replace(",", "" if thousands else ".")
    try:
        return Decimal(digits)
    except InvalidOperation:
        return None


def unit(surface: str) -> str | None:
    plain = surface.strip().replace("\u03bc", "\u00b5")
    return lx.CASED_UNITS.get(plain) or lx.UNITS.get(plain.lower())


def tokens(text: str) -> list[Token]:
    """Numbers glued to a word, a point or a comma before them count as words."""
    out = []
    for m in _TOKEN.finditer(text):
        kind = m.lastgroup or ""
        before = text[m.start() - 1 : m.start()]
        if kind == "number" and before and (before.isalnum() or before in "_.,"):
            kind = "word"
        out.append(Token(kind, m.start(), m.end(), m[0]))
    return out


def unit_at(text: str, at: int) -> tuple[int, str] | None:
    """End and surface of the longest unit that starts at ``at`` or after white space there."""
    while at < len(text) and text[at].isspace():
        at += 1
    for n in range(min(_LONGEST_UNIT, len(text) - at), 0, -1):
        surface = text[at : at + n]
        after = text[at + n : at + n + 1]
        if surface.lower().replace("\u03bc", "\u00b5") in lx.UNITS and not (after.isalnum() or after == "_"):
            return at + n, surface
    return None


class Sentence:
    """The tokens of a text, read from left to right."""

    def __init__(self, text: str):
        self.text, self.tokens = text, tokens(text)

    def is_(self, i: int, *kinds_or_texts: str) -> bool:
        return 0 <= i < len(self.tokens) and (self.tokens[i].kind in kinds_or_texts or self.tokens[i].text in kinds_or_texts)

    def joint(self, i: int, extra: tuple = ()) -> bool:
        """A dash or word that makes a range of the numbers beside it."""
        return 0 <= i < len(self.tokens) and (self.tokens[i].text in _DASHES or self.tokens[i].text.lower() in _JOINTS.union(extra))

    def at(self, place: int) -> int:
        """The first token that starts at ``place`` or later."""
        return next((i for i, t in enumerate(self.tokens) if t.start >= place), len(self.tokens))

    def frequency(self, end: int) -> int | None:
        """End of a unit of frequency after ``end``."""
        found = unit_at(self.text, end)
        return found[0] if found and unit(found[1]) in lx.FREQUENCY_UNITS else None

    def band(self) -> tuple[int, int] | None:
        """The first frequency band: two numbers joined, the second with a unit of frequency."""
        for i, t in enumerate(self.tokens):
            if t.text[0].isdigit():
                after = self.frequency(t.end)
                j = self.at(after) if after else i + 1
                if self.joint(j, lx.BAND_WORDS) and self.is_(j + 1, "number") and (end := self.frequency(self.tokens[j + 1].end)):
                    return t.start, end
        return None

    def statement(self, i: int) -> Statement | None:
        """What the number at token ``i`` says together with the signs, the numbers and the unit after it."""
        said = Statement(i)
        j = i + 1
        if self.is_(j, "±") and self.is_(j + 1, "number"):
            said.around, j = j + 1, j + 2
        elif self.is_(j, "+") and self.is_(j + 1, "number") and self.is_(j + 2, "/") and self.is_(j + 3, "-", "−") and self.is_(j + 4, "number"):
            said.above, said.below, j = j + 1, j + 4, j + 5
        if said.around and self.is_(j, "%") and unit_at(self.text, self.tokens[j].end):
            said.percent, j = True, j + 1
        if self.joint(j) and self.is_(j + 1, "number"):
            said.upper, j = j + 1, j + 2
        found = unit_at(self.text, self.tokens[j - 1].end)
        if found:
            said.end, said.unit = found
            return said
        return None


@dataclass
class Statement:
    value: int
    around: int = 0
    above: int = 0
    below: int = 0
    upper: int = 0
    percent: bool = False
    unit: str = ""
    end: int = 0


def phrase_bound(before: str) -> str | None:
    said = " ".join(before.lower().split())
    return next((name for name, phrases in lx.PHRASES.items() if said.endswith(phrases)), None)


def noun_bound(text: str, upto: int) -> str | None:
    """Compound nouns such as "Mindestabstand" name the bound of a whole sentence."""
    near, whole = text[:upto].lower(), text.lower()
    if not any(lead + noun in near for leads in lx.BOUND_LEADS.values() for lead in leads for noun in lx.BOUND_NOUNS):
        return None
    return next(name for name, leads in lx.BOUND_LEADS.items() if any(lead in whole for lead in leads))


def in_limit_context(text: str, at: int) -> bool:
    """A limit is spoken of shortly before ``at``, in the same sentence."""
    near = text[max(0, at - lx.KEYWORD_WINDOW) : at]
    near = near[near.rfind(".") + 1 :].lower()
    return any(k in near for k in lx.LIMIT_KEYWORDS) or any(re.search(rf"{k}\b", near) for k in lx.LIMIT_WORD_ENDS)


def parameters(text: str | None, lang: str | None) -> list[dict]:
    """Limit values stated in a sentence; a frequency band is the condition of the others.

    A soft hyphen between digits is a dash, elsewhere nothing.  No bound is made up: a value without one
    counts only where a limit is spoken of.  A null text states nothing.
    """
    text = re.sub("(?<=\\d)\u00ad(?=\\d)", "-", text or "").replace("\u00ad", "")
    s = Sentence(text)
    band = s.band()
    condition = " ".join(text[slice(*band)].split()) if band else None
    number = lambda i: decimal(s.tokens[i].text, lang) if i else None
    out, done = [], 0
    for i, t in enumerate(s.tokens):
        if t.kind != "number" or t.start < done or (said := s.statement(i)) is None:
            continue
        value, high = decimal(t.text, lang), number(said.upper)
        done = said.end
        if value is None or band and band[0] <= t.start < band[1]:
            continue
        symbol = s.tokens[i - 1] if s.is_(i - 1, "bound") else None
        first = i - 1 if symbol else i
        lead = s.is_(first - 1, "±")
        begin = s.tokens[first - lead].start
        name = unit(said.unit)
        row = dict.fromkeys(NAMES) | {"unit": name, "raw_unit": said.unit, "quantity_kind": lx.QUANTITY_KIND.get(name or ""), "condition": condition}
        if said.above:
            row |= {"tol_type": "asymmetric", "tol_value": number(said.above), "tol_lower": number(said.below), "tol_unit": name}
        elif said.around:
            row |= {"tol_type": "relative" if said.percent else "symmetric", "tol_value": number(said.around), "tol_unit": "%" if said.percent else name}
        if high is not None:
            row |= {"comparator": "range", "low": value, "high": high}
        elif lead:
            row |= {"comparator": "range", "low": -value, "high": value, "tol_type": "symmetric", "tol_value": value, "tol_unit": name}
        else:
            bound = lx.COMPARATORS[symbol.text] if symbol else phrase_bound(text[max(0, begin - lx.PHRASE_WINDOW) : begin])
            bound = bound or noun_bound(text, said.end + lx.NOUN_WINDOW)
            if bound is None and not in_limit_context(text, t.start):
                continue
            row |= {"value": value, "comparator": bound}
        out.append(row)
    return out


DECIMALS = ("value", "low", "high", "tol_value", "tol_lower")
NAMES = ("value", "unit", "raw_unit", "comparator", "low", "high", "quantity_kind", "condition", "tol_type", "tol_value", "tol_lower", "tol_unit")


def prose_parameters(nodes: DataFrame, *, text: str = "text", lang: str = "lang", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, and a row for each limit value that a node's text states.

    Texts without a digit never leave the JVM.  Names in ``keep`` must not be among ``NAMES``.
    """
    types = {n: pa.decimal128(38, 18) if n in DECIMALS else pa.string() for n in NAMES}
    schema = ", ".join([*[f"`{c}` {nodes.schema[c].dataType.simpleString()}" for c in keep], *[f"{n} {'decimal(38,18)' if n in DECIMALS else 'string'}" for n in NAMES]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i, (t, g) in enumerate(zip(batch.column("text__").to_pylist(), batch.column("lang__").to_pylist(), strict=True)):
                for p in parameters(t, g):
                    rows.append(i)
                    found.append(p)
            kept = [batch.column(c).take(pa.array(rows, pa.int64())) for c in keep]
            values = [pa.array([p[n] for p in found], kind) for n, kind in types.items()]
            yield pa.RecordBatch.from_arrays([*kept, *values], [*keep, *NAMES])

    asked = nodes.filter(F.col(text).rlike("[0-9]")).select(*keep, F.col(text).alias("text__"), F.col(lang).alias("lang__"))
    return asked.mapInArrow(run, schema)
