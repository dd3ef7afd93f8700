"""Known cases of the text, value and tree functions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from foliant.functions import equations as eq
from foliant.functions import text as tx
from foliant.functions import language as ln
from foliant.functions import prose as ps
from foliant.functions import values as vl
from foliant.operators import consensus as cs
from foliant.operators import gates as gt
from foliant.operators import metrics as mt
from foliant.operators import tables as tb
from foliant.operators import tree as tr
from foliant.sources import readers as rd


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items()))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "clause"),
    [
        ("4.2.3 Limits", "4.2.3"),
        ("Grenzwertklassen 5.3.4", "5.3.4"),
        ("Anhang ZA Normative references", "Annex ZA"),
        ("Prüffeldstärke 2", None),
        ("2009-04-01 Ausgabedatum", None),
        ("Nach IEC 61000-4-3", None),
    ],
)
def test_heading_clause(spark, text, clause):
    assert one(spark, tx.clause_of_heading(F.col("t")), t=text) == clause


def test_definition_term(spark):
    assert one(spark, tx.clause_id(F.lit("paragraph"), F.col("t")), t="3.28 Anstieg des Spektrums (siehe auch Bild 1)") == "3.28"


@pytest.mark.parametrize(
    ("text", "path", "value", "unit", "condition"),
    [
        ("0,5 m/s²", [], "0,5", "m/s^2", None),
        ("230 - 1000", [], "230-1000", None, None),
        ("≤ 40 dBµV/m", [], "≤40", "dBµV/m", None),
        ("40 dBµV/m at 3 m", [], "40", "dBµV/m", "at 3 m"),
        ("40", ["Limit (dBµV/m)"], "40", "dBµV/m", None),
    ],
)
def test_quantity(spark, text, path, value, unit, condition):
    q = one(spark, vl.quantity(F.col("t"), F.col("p")), t=text, p=path)
    assert (q["value"], q["unit"], q["condition"]) == (value, unit, condition)


def test_no_quantity(spark):
    assert one(spark, vl.quantity(F.col("t"), F.array()), t="Test Sec.3 [14.6]") is None


def test_prose_parameters():
    (p,) = ps.parameters("The field strength shall be ≤ 40 dBµV/m at 80 MHz - 1 GHz", "en")
    assert (p["value"], p["unit"], p["comparator"], p["condition"], p["quantity_kind"]) == (40, "dBµV/m", "lte", "80 MHz - 1 GHz", "field_strength")
    (p,) = ps.parameters("the limit shall be 10 ± 0.5 V/m", "en")
    assert (p["tol_type"], p["tol_value"]) == ("symmetric", Decimal("0.5"))
    (p,) = ps.parameters("max level 10 +0.5/-0.2 V/m", "en")
    assert (p["tol_type"], p["tol_value"], p["tol_lower"]) == ("asymmetric", Decimal("0.5"), Decimal("0.2"))
    (p,) = ps.parameters("the limit shall be 10 ± 5 % V/m", "en")
    assert (p["tol_type"], p["tol_unit"]) == ("relative", "%")
    (p,) = ps.parameters("field strength 10 - 15 V/m", "en")
    assert (p["low"], p["high"], p["value"]) == (10, 15, None)
    for text in ("the field shall be 10 V/m", "item14 Hz", "DNVGL-CP-0203 may be used", None):
        assert ps.parameters(text, "en") == []
    (p,) = ps.parameters("limit 1,234.5 V", "en")
    assert p["value"] == Decimal("1234.5")


def said(text, lang="en"):
    return [(p["value"], p["unit"], p["comparator"], p["low"], p["high"], p["condition"]) for p in ps.parameters(text, lang)]


def test_prose_cases():
    ten = Decimal(10)
    assert said("shall be at least 10 V/m") == [(ten, "V/m", "gte", None, None, None)]
    assert said("limit 40 dBµV/m in the range 3-100 Hz") == [(40, "dBµV/m", None, None, None, "3-100 Hz")]
    assert said("limit 40 dBµV/m over 80 MHz - 1 GHz") == [(40, "dBµV/m", None, None, None, "80 MHz - 1 GHz")]
    assert said("Prüfe den Frequenzbereich 0,1 MHz bis 6 000 MHz.", "de") == []
    assert said("Frequenzbereich 9 kHz\u00ad30 MHz, 5\u00ad10 Hz", "de") == []
    assert said("Abweichungen von mehr als 5 % sind nicht zulässig.", "de") == [(5, "%", "gte", None, None, None)]
    assert said("voltage ± 10 % and ± 15 %") == [(None, "%", "range", -ten, ten, None), (None, "%", "range", Decimal(-15), Decimal(15), None)]
    (p,) = ps.parameters("the limit shall be 10 ± 1 %", "en")
    assert (p["value"], p["unit"], p["tol_type"], p["tol_value"]) == (10, "%", "symmetric", 1)
    assert said("ein Mindestabstand von 3 m", "de") == [(3, "m", "gte", None, None, None)]
    assert said("die Höchstspannung 1.500,5 V", "de") == [(Decimal("1500.5"), "V", "lte", None, None, None)]
    assert said("Model X100 Hz, 3 items, a limit. Now 10 V/m") == []
    assert said("die Feldstärke muss ≤ 0,5 V/m sein", "de") == [(Decimal("0.5"), "V/m", "lte", None, None, None)]
    assert said("max 3 MW and min 4 mW") == [(3, "MW", None, None, None, None), (4, "mW", None, None, None, None)]
    assert said("x" * 200_000 + " at most 5 m" + " 1 2 3" * 20_000) == [(5, "m", "lte", None, None, None)]


def test_prose_table(spark):
    df = spark.createDataFrame([(1, "at most 5 V and at least 3 V", "en"), (2, None, "en"), (3, "no number", None), (1, "at most 5 V and at least 3 V", "en")], "pre int, text string, lang string")
    got = sorted((r["pre"], r["comparator"], r["value"]) for r in ps.prose_parameters(df, keep=("pre",)).collect())
    assert got == [(1, "gte", 3)] * 2 + [(1, "lte", 5)] * 2
    assert ps.prose_parameters(df.limit(0), keep=("pre",)).count() == 0


@pytest.mark.parametrize(("surface", "lang", "value"), [("0,5", "de", "0.5"), ("1,500", "en", "1500"), ("3,5", "en", "3.5"), ("1.234,5", "de", "1234.5"), ("x", "en", None)])
def test_decimal(spark, surface, lang, value):
    got = one(spark, vl.decimal(F.col("s"), F.col("g")), s=surface, g=lang)
    assert got == (None if value is None else Decimal(value))
    assert ps.decimal(surface, lang) == got


def test_ambiguous(spark):
    assert one(spark, vl.ambiguous(F.col("s"), F.lit("en")), s="3,5") is True
    assert one(spark, vl.ambiguous(F.col("s"), F.lit("de")), s="3,5") is False


def test_units_by_case(spark):
    assert [one(spark, vl.unit(F.col("u")), u=u) for u in ("MW", "mW", "μV", "ohm", "q")] == ["MW", "mW", "µV", "Ω", None]


def test_references(spark):
    got = one(spark, tx.references(F.col("t")), t="see 4.2, see 4.2 again. See Table 22 and Bild 15; details in Anhang A. temper 5, per 61000-4")
    assert [tuple(r) for r in got] == [("clause", "4.2"), ("annex", "Annex A"), ("table", "Table 22"), ("figure", "Figure 15")]


def test_compare_form(spark):
    for text, form in (("shall   be\n10 V/m", "shall be 10 V/m"), ("over-\nload", "overload"), ("10⁻³", "10⁻³")):
        assert one(spark, tx.compare_form(F.col("t")), t=text) == form


def test_preferred(spark):
    assert one(spark, tx.preferred(F.col("a"), F.col("b")), a="10⁻³ V", b="10-3 V") == "10⁻³ V"
    assert one(spark, tx.preferred(F.col("a"), F.col("b")), a="Hz", b="6 Hz") == "6 Hz"


def test_equations(spark):
    assert one(spark, eq.compare_form(F.col("x")), x="$$a \\text{d} = \\left(b\\right) \\tag{2}$$") == one(spark, eq.compare_form(F.col("x")), x="a \\mathrm{d}=(b)")
    assert one(spark, eq.canonical(F.col("x")), x="2H2 + O2 -> 2H2O").startswith("\\ce{")
    for text, ok in (("(a[b]{c})", True), ("(a", False), ("a)", False), ("\\{a", True), ("([)]", False), ("", True)):
        assert one(spark, eq.is_balanced(F.col("x")), x=text) is ok
    assert one(spark, eq.symbols(F.col("x")), x="V/m + \\text x") == ["V", "m", "x"]


def nested(spark, clauses):
    rows = [(1, i, "section" if c else "paragraph", c, True) for i, c in enumerate(clauses)]
    df = spark.createDataFrame(rows, "edition int, pre int, type string, clause_id string, relevant boolean")
    return [r["parent"] for r in tr.nest(df).orderBy("pre").collect()]


def test_nest(spark):
    assert nested(spark, ["5.3", "5.3.1", "5.3.5", "5.3.5.1", "5.3.6"]) == [None, 0, 0, 2, 0]
    assert nested(spark, ["5.3", "5.3.2.1"]) == [None, 0]
    assert nested(spark, ["5.3", None, "6"]) == [None, 0, None]
    assert nested(spark, ["5.3", "5.3.1", "Annex A"]) == [None, 0, None]


def test_nest_equals_a_stack(spark):
    import random

    rnd = random.Random(3)
    rows, want = [], []
    for e in range(60):
        stack: list[tuple[int, list | None]] = []
        for i in range(12):
            parts = [rnd.randint(1, 2) for _ in range(rnd.randint(1, 3))] if rnd.random() < 0.7 else None
            annex = parts is None and rnd.random() < 0.3
            clause = ".".join(map(str, parts)) if parts else "Annex A" if annex else None
            rows.append((e, i, "section", clause, True))
            if parts:
                while stack and (stack[-1][1] is None or not (len(stack[-1][1]) < len(parts) and parts[: len(stack[-1][1])] == stack[-1][1])):
                    stack.pop()
                want.append(stack[-1][0] if stack else None)
                stack.append((i, parts))
            elif annex:
                want.append(None)
                stack = [(i, None)]
            else:
                want.append(stack[-1][0] if stack else None)
    df = spark.createDataFrame(rows, "edition int, pre int, type string, clause_id string, relevant boolean")
    assert [r["parent"] for r in tr.nest(df).orderBy("edition", "pre").collect()] == want


def numbered(spark, rows):
    df = spark.createDataFrame([(1, *r) for r in rows], "edition int, pre int, parent int, clause_id string")
    return {(r["pre"], r["reason"]) for r in gt.numbering(df).collect()}


def test_numbering_gate(spark):
    assert numbered(spark, [(0, None, "5.2"), (1, None, "5.4")]) == {(1, "dropped 5.3")}
    assert numbered(spark, [(0, None, "5.2"), (1, None, "5.3")]) == set()
    assert numbered(spark, [(0, None, "Annex A"), (1, None, "Annex C")]) == set()
    assert numbered(spark, [(0, None, "3.23"), (1, 0, "3.24"), (2, None, "3.27"), (3, 2, "3.26")]) == {(2, "dropped 3.25")}


def test_header_gate(spark):
    rows = [(1, p, p, "ACME STD 42") for p in (1, 2, 3)] + [(1, 4, 4, "before\nACME STD 42\nafter")]
    df = spark.createDataFrame(rows, "edition int, pre int, page int, text string")
    (r,) = gt.header_footer(df).collect()
    assert (r["pre"], r["text"], r["removed"]) == (4, "before\nafter", 1)


def test_votes(spark):
    rows = [(1, "pymupdf", "a", False), (1, "surya", "a", False), (1, "rapidocr", "b", False)]
    rows += [(2, p, t, True) for _, p, t, _ in rows[:3]] + [(3, "pymupdf", "a", False), (3, "surya", "b", False), (4, "surya", "x", False), (4, "pymupdf", None, False)]
    df = spark.createDataFrame(rows, "edition int, parser string, text string, normative boolean")
    got = {r["edition"]: (r["state"], r["dissenters"]) for r in cs.text_votes(df, form=tx.compare_form).collect()}
    assert got == {1: ("majority", "rapidocr"), 2: ("quarantined", "rapidocr"), 3: ("quarantined", "surya")}


@pytest.mark.parametrize("pairs", [[(["freq", "limit"], ["freq", "limit"], True), (["freq"], ["level"], False)]])
def test_stitch(spark, pairs):
    for a, b, merged in pairs:
        rows = [(1, i, s, len(s), 1, 3) for i, s in enumerate((a, b))]
        df = spark.createDataFrame(rows, "edition int, pre int, signature array<string>, n_cols int, first_data int, n_rows int")
        got = tb.stitch(df).orderBy("pre").collect()
        assert (got[1]["island"] == 0) is merged
        assert got[1]["offset"] == (2 if merged else 0)


def test_captions(spark):
    rows = [(1, 0, "table", 1), (1, 1, "caption", 1), (1, 2, "caption", 1), (1, 3, "paragraph", 1), (1, 4, "caption", 2), (1, 5, "figure", 2), (1, 6, "caption", 2), (1, 7, "table", 2)]
    df = spark.createDataFrame(rows, "edition int, pre int, type string, page int")
    got = {r["pre"]: r["owner"] for r in tr.attach_captions(df).collect() if r["type"] == "caption"}
    assert got == {1: 0, 2: 0, 4: 5, 6: None}


def test_store_is_idempotent(spark, tmp_path):
    from foliant.streaming.store import Store, ingest

    source, store = tmp_path / "in", Store(spark, str(tmp_path / "store"))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "id int, text string")
    for _ in range(2):
        docs.write.mode("append").parquet(str(source))
        ingest(spark.readStream.schema("id int, text string").parquet(str(source)), store, "0.14.0", str(tmp_path / "cp"))
    assert store.read().count() == 3


def test_language(spark):
    said = {"Предел напряжения составляет": "ru", "试验方法和要求的说明文件以及其他相关内容": "zh", "これは試験の方法についての説明です": "ja", "시험 방법에 대한 설명입니다 그리고": "ko", "هذا هو الحد الأقصى للجهد": "ar"}
    said |= {"the limit of the field is": "en", "to": None, "12345678901234": None, "xyzzy plugh foo bar": None, "det er ikke en stor test af udstyr": "da", "il limite della prova non sono": "it"}
    for text, code in said.items():
        assert one(spark, ln.detect(F.col("t")), t=text) == code, text


def test_language_of_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) > 300")
    right = docs.select((ln.detect(F.col("text")) == F.col("lang")).alias("ok")).filter("ok is not null").groupBy("ok").count().collect()
    counts = {r["ok"]: r["count"] for r in right}
    assert counts[True] > 0.95 * sum(counts.values()) and sum(counts.values()) > 0.8 * docs.count()


def test_merged_numbers_leave_no_dangling_children(spark):
    rows = [(1, 0, 1, "section", "4", None, None), (1, 1, 1, "section", "4.1", 0, None), (1, 2, 1, "paragraph", "Scope of tests", 1, None), (1, 3, 1, "paragraph", "A sentence that follows it and is much longer than any title of a section would ever be.", 1, None), (1, 4, 2, "section", "5", None, None), (1, 5, 3, "paragraph", "Next page", 4, None)]
    df = spark.createDataFrame(rows, "edition bigint, pre int, page int, type string, text string, parent int, owner int")
    got = {r["pre"]: (r["text"][:14], r["parent"]) for r in tr.merge_numbers(df).collect()}
    assert got[2] == ("4.1 Scope of t", 0) and got[3][1] == 2 and got[4] == ("5", None) and got[5][1] == 4 and 1 not in got
    assert all(p is None or p in got for _, p in got.values())


def test_nest_of_a_long_edition(spark):
    import random
    import time

    rnd, rows, parts = random.Random(3), [], [1]
    for i in range(20_000):
        kind = rnd.random()
        if kind < 0.3:
            parts = [*parts, 1][:6]
        elif kind < 0.8:
            parts = [*parts[:-1], parts[-1] % 900 + 1]
        elif len(parts) > 1:
            parts = [*parts[:-2], parts[-2] % 900 + 1]
        rows.append((1, i, "section", ".".join(map(str, parts)) if rnd.random() < 0.8 else None, rnd.random() > 0.001))
    df = spark.createDataFrame(rows, "edition bigint, pre int, type string, clause_id string, relevant boolean")
    began = time.perf_counter()
    got = {r["pre"]: r["parent"] for r in tr.nest(df).collect()}
    assert time.perf_counter() - began < 30
    stack, last = [], None
    for _, pre, _, clause, relevant in rows:
        if clause is None:
            if not relevant:
                stack, last = [], None
                assert got[pre] is None
            else:
                assert got[pre] == last
            continue
        p = clause.split(".")
        while stack and stack[-1][1] != p[: len(stack[-1][1])] or stack and len(stack[-1][1]) >= len(p):
            stack.pop()
        assert got[pre] == (stack[-1][0] if stack else None)
        stack.append((pre, p))
        last = pre


def test_kendall_equals_all_pairs(spark):
    import random

    rnd = random.Random(4)
    rows = [(p, i if p % 2 else rnd.randint(0, 5), float(rnd.randint(0, 9))) for p in range(12) for i in range(p * 3)]
    got = {r["page"]: r["tau"] for r in mt.kendall(spark.createDataFrame(rows, "page int, pos int, y double"), "page").collect()}
    for page in {p for p, *_ in rows}:
        own = sorted((r for r in rows if r[0] == page), key=lambda r: (-r[2], r[1]))
        ranks = [(r[1], k) for k, r in enumerate(own)]
        pairs = [(a, b) for a in ranks for b in ranks if a[0] < b[0]]
        want = sum(1 if b[1] > a[1] else -1 for a, b in pairs) / len(pairs) if pairs else 1.0
        assert abs(got[page] - want) < 1e-9


def test_html_items(spark):
    html = '<nav><div>menu</div><p>still menu</p></nav><h2>Head</h2><p>one <b>two</b><div class="ad"><p>buy<br>now</div><p>three</p><ul><li>x</ul><footer>f'
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id bigint, html string")
    got = [(r["label"], r["level"], r["text"]) for r in rd.html_items(df).orderBy("edition", "pre").collect()]
    shown = [x for x in got if x[0] != "page_header"]
    assert shown == [("section_header", 2, "Head"), ("paragraph", None, "one two"), ("paragraph", None, "three"), ("list_item", None, "x")]
    assert [x[2] for x in got if x[0] == "page_header"] == ["menu", "still menu", "buy now", "f"]


def test_html_items_against_a_plain_reading(spark):
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {}
    for r in rd.html_items(pages).filter("label <> 'page_header'").orderBy("edition", "pre").collect():
        got[r["edition"]] = got.get(r["edition"], "") + " " + r["text"]
    plain = lambda t: " ".join(t.split())
    import html

    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        assert plain(got[r["page_id"]]) == plain(html.unescape(re.sub(r"<[^>]*>", lambda m: "" if re.match("</?b>", m[0]) else " ", inside)))
