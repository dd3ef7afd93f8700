"""Registered queries: every operator over the driver's tables, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import lexicon as lx
from ..fixtures import frame, sql_with
from ..functions import equations as eq
from ..functions import language as ln
from ..functions import prose as ps
from ..functions import text as tx
from ..functions import values as vl
from ..operators import consensus as cs
from ..operators import gates as gt
from ..operators import metrics as mt
from ..operators import roles as rl
from ..operators import tables as tb
from ..operators import tree as tr
from ..operators import views as vw
from ..session import table
from ..sources import readers as rd
from ..streaming import store as st

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None, *views: str):
    """Register a function under its name; ``oracle`` follows the definitions of ``views``."""

    def register(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLE[f.__name__] = (sql_with(*views) if views else "") + oracle
        return f

    return register


def fx(spark: SparkSession, d: str, name: str) -> DataFrame:
    return frame(spark, d, name)


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


# --- sources, sinks, versions -------------------------------------------------------------


@query(
    """SELECT CAST(d.doc_id AS VARCHAR) AS path, sha256(d.text) || '+0.14.0' AS key, bool_or(l.doc_id IS NOT NULL) AS ready
       FROM documents d LEFT JOIN (SELECT DISTINCT sha256(text) AS h, 1 AS doc_id FROM documents WHERE doc_id % 3 = 0) l ON sha256(d.text) = l.h
       GROUP BY ALL"""
)
def src3_listing(spark, d):
    """SRC1-SRC4: documents with their content key and whether the store has it."""
    files = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("content"), "doc_id")
    stored = files.filter("doc_id % 3 = 0").select(st.key(F.col("content"), st.version()).alias("key"))
    return rd.listing(files, stored, st.version())


@query("SELECT CASE WHEN text IS NULL THEN 'malformed' WHEN trim(text) = '' THEN 'empty' ELSE 'ok' END AS cause, count(*) AS n FROM documents GROUP BY 1")
def src5_admission(spark, d):
    """SRC5: why documents are not taken in."""
    return table(spark, d, "documents").groupBy(F.coalesce(st.admission(F.col("text")), F.lit("ok")).alias("cause")).agg(F.count(F.lit(1)).alias("n"))


@query()
def src9_html_items(spark, d):
    """SRC9, TREE1 on web pages: items by label, read from the html."""
    return rd.html_items(table(spark, d, "pages")).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("edition").alias("editions"))


@query(
    """, s AS (SELECT edition, 1 AS page, qty % 3 AS table_ord, ord AS row, k AS slot, (qty + k) % 4 = 0 AND k > 0 AS is_null FROM fx_rows, (SELECT unnest([0, 1, 2, 3]) AS k)),
       m AS (SELECT *, sum(CASE WHEN is_null THEN 0 ELSE 1 END) OVER (PARTITION BY edition, table_ord, row ORDER BY slot) AS c FROM s),
       g AS (SELECT edition, table_ord, row, c, count(*) AS n FROM m GROUP BY ALL)
       SELECT n AS colspan, count(*) AS cells FROM g GROUP BY 1""",
    "fx_rows",
)
def src11_ruled_spans(spark, d):
    """SRC11: column spans of ruled tables, recovered from empty slots."""
    k = F.explode(F.array(*[F.lit(i) for i in range(4)]))
    slots = fx(spark, d, "fx_rows").select("edition", F.lit(1).alias("page"), (F.col("qty") % 3).alias("table_ord"), F.col("ord").alias("row"), "qty", k.alias("slot"))
    slots = slots.withColumn("is_null", ((F.col("qty") + F.col("slot")) % 4 == 0) & (F.col("slot") > 0))
    grid = tb.ruled_grid(slots)
    spans = grid.select(F.explode("spans").alias("s")).groupBy(F.col("s.colspan").cast("bigint").alias("colspan")).agg(F.count(F.lit(1)).alias("cells"))
    all_slots = slots.agg(F.count(F.lit(1)).alias("n"))
    wide = grid.select(F.explode("spans").alias("s")).agg(F.coalesce(F.sum("s.colspan"), F.lit(0)).alias("w"))
    ones = all_slots.crossJoin(wide).select(F.lit(1).cast("bigint").alias("colspan"), (F.col("n") - F.col("w")).alias("cells"))
    return spans.unionByName(ones)


_TRIAGE = """CASE WHEN length(text) < 40 THEN 'UNCERTAIN'
    WHEN (length(text) - length(replace(text, chr(65533), ''))) / length(text) <= 0.02
     AND len([w FOR w IN string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+') IF length(w) >= 25]) / greatest(len([w FOR w IN string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+') IF w <> '']), 1) <= 0.05
    THEN 'DIGITAL_CLEAN' ELSE 'DIGITAL_DIRTY' END"""


@query(
    f"SELECT c.content, p.page_class, CASE c.content WHEN 'text' THEN CASE p.page_class WHEN 'DIGITAL_CLEAN' THEN 'digital_layer' WHEN 'DIGITAL_DIRTY' THEN 'docling' ELSE 'rapidocr' END ELSE 'docling' END AS engine, p.n"
    f" FROM (SELECT unnest(['layout', 'table', 'equation', 'text']) AS content) c, (SELECT {_TRIAGE} AS page_class, count(*) AS n FROM documents GROUP BY 1) p"
)
def src13_owners(spark, d):
    """SRC13: which engine owns which content, by the triage class of the page."""
    pages = table(spark, d, "documents").select(tx.triage(F.col("text"), F.lit(0)).alias("t")).groupBy("t.page_class").agg(F.count(F.lit(1)).alias("n"))
    return cs.owners(spark).join(pages, "page_class").select("content", "page_class", "engine", "n")


@query("SELECT CASE lang WHEN 'en' THEN 'foreword' WHEN 'de' THEN 'toc' END AS role, count(*) AS n FROM documents WHERE lang IN ('en', 'de') GROUP BY 1")
def src14_role_headings(spark, d):
    """SRC14, SET4: roles of headings by the pooled dictionary, whatever their case and marks."""
    said = F.when(F.col("lang") == "en", " FOREWORD ").when(F.col("lang") == "de", "Inhaltsverzeichnis").when(F.col("lang") == "fr", "Résumé").otherwise("Limits")
    docs = table(spark, d, "documents").select(tx.bare(said).alias("heading"))
    return docs.join(rl.headings(spark), "heading").groupBy("role").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT sum(CASE WHEN length(text) > 200 THEN 200 + length(' [' || (length(text) - 200) || ' more chars]') ELSE length(text) END)::BIGINT AS chars FROM documents")
def snk4_reasons(spark, d):
    """SNK4: reasons cut for display."""
    return table(spark, d, "documents").agg(F.sum(F.length(vw.short_reason(F.col("text")))).alias("chars"))


@query("SELECT vec_id AS id, len(embedding)::BIGINT AS size FROM embeddings")
def snk5_points(spark, d):
    """SNK5: thin payloads for a vector store."""
    chunks = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    return vw.chunk_payload(chunks).select("id", F.size("vector").cast("bigint").alias("size"))


@query("SELECT 'accurate' AS table_model, 'rapidocr' AS ocr, '0.14.0' AS version UNION ALL SELECT 'fast', 'surya', '0.14.0.tf-fast.ocr-surya'")
def ver1_versions(spark, d):
    """VER1: the pipeline version names what differs from the default."""
    rows = [(t, o, st.version(t, o)) for t, o in (("accurate", "rapidocr"), ("fast", "surya"))]
    return spark.createDataFrame(rows, "table_model string, ocr string, version string")


# --- tree -----------------------------------------------------------------------------------

_ITEMS = """, n AS (SELECT *, CASE WHEN label = 'section_header' THEN CASE WHEN regexp_matches(text, '^Table [0-9]+') THEN 'caption' WHEN text = 'Legend:' THEN 'note' ELSE 'section' END
     WHEN label = 'caption' THEN 'caption' WHEN label = 'table' THEN 'table' WHEN label = 'picture' THEN 'figure' ELSE 'paragraph' END AS type FROM fx_items WHERE label <> 'page_header'),
  p AS (SELECT a.edition, a.pre, a.type, a.page, CASE WHEN a.type = 'section'
     THEN (SELECT max(b.pre) FROM n b WHERE b.edition = a.edition AND b.pre < a.pre AND b.type = 'section' AND b.level < a.level)
     ELSE (SELECT max(b.pre) FROM n b WHERE b.edition = a.edition AND b.pre < a.pre AND b.type = 'section') END AS parent FROM n a)
"""


@query(_ITEMS + "SELECT type, count(*) AS n, count(parent) AS placed, sum(parent)::BIGINT AS parents FROM p GROUP BY 1", "fx_items")
def tree1_build(spark, d):
    """TREE1, TREE15: nodes and parents from layout items."""
    nodes = tr.build(fx(spark, d, "fx_items"))
    return nodes.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.count("parent").alias("placed"), F.sum("parent").alias("parents"))


@query(
    _ITEMS + """, r AS (SELECT edition, min(pre) AS owner, max(pre) + 1 AS cap FROM n WHERE type IN ('table', 'figure') GROUP BY edition)
    SELECT count(*) AS captions, sum(coalesce(r.owner, p.parent))::BIGINT AS parents FROM p LEFT JOIN r ON r.edition = p.edition AND r.cap = p.pre WHERE p.type = 'caption'""",
    "fx_items",
)
def tree2_claimed_captions(spark, d):
    """TREE2: captions named by a table or figure become its children."""
    nodes = tr.build(fx(spark, d, "fx_items"))
    refs = nodes.filter("type in ('table', 'figure')").groupBy("edition").agg(F.min("pre").alias("owner"), (F.max("pre") + 1).alias("caption"))
    return tr.claim_captions(nodes, refs).filter("type = 'caption'").agg(F.count(F.lit(1)).alias("captions"), F.sum("parent").alias("parents"))


@query(
    _ITEMS + """, s AS (SELECT *, lag(type) OVER w AS pt, lag(page) OVER w AS pp, lead(type) OVER w AS nt, lead(page) OVER w AS np FROM n WINDOW w AS (PARTITION BY edition ORDER BY pre)),
    k AS (SELECT *, max(CASE WHEN type <> 'caption' THEN pre END) OVER (PARTITION BY edition ORDER BY pre ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM s),
    j AS (SELECT k.*, q.type AS qt, q.page AS qp FROM k LEFT JOIN n q ON q.edition = k.edition AND q.pre = k.prev),
    b AS (SELECT *, coalesce(qt IN ('table', 'figure') AND NOT EXISTS (SELECT 1 FROM n m WHERE m.edition = j.edition AND m.type = 'caption' AND m.pre > j.prev AND m.pre <= j.pre AND m.page <> j.qp), FALSE) AS back,
          coalesce(nt IN ('table', 'figure') AND np = page, FALSE) AS ahead FROM j WHERE type = 'caption')
    SELECT count(*) AS captions, count(*) FILTER (WHERE back AND NOT ahead) AS backward, count(*) FILTER (WHERE ahead AND NOT back) AS forward FROM b""",
    "fx_items",
)
def tree4_attach_captions(spark, d):
    """TREE4: captions next to exactly one table or figure of their page."""
    got = tr.attach_captions(tr.build(fx(spark, d, "fx_items"))).filter("type = 'caption'")
    return got.agg(F.count(F.lit(1)).alias("captions"), F.count_if(F.col("owner") < F.col("pre")).alias("backward"), F.count_if(F.col("owner") > F.col("pre")).alias("forward"))


@query("SELECT edition, pre::BIGINT AS pre, label, text FROM fx_items", "fx_items")
def tree5_identity(spark, d):
    """TREE5: the reconcile seam changes no row."""
    return longs(tr.reconcile(fx(spark, d, "fx_items")).select("edition", "pre", "label", "text"), "pre")


@query(
    """, t AS (SELECT edition, pre, page, type, CASE WHEN pre % 3 = 1 THEN '4.' || pre WHEN pre % 3 = 2 THEN 'term of ' || edition ELSE '9 other' END AS text FROM fx_nodes),
       w AS (SELECT *, lead(text) OVER v AS nx, lead(page) OVER v AS np, lag(text) OVER v AS pv, lag(page) OVER v AS pp FROM t WINDOW v AS (PARTITION BY edition ORDER BY pre))
       SELECT count(*) AS n, sum(length(CASE WHEN text LIKE 'term%' AND pv LIKE '4.%' AND pp = page THEN pv || ' ' || text ELSE text END))::BIGINT AS chars
       FROM w WHERE NOT coalesce(text LIKE '4.%' AND nx LIKE 'term%' AND np = page, FALSE)""",
    "fx_nodes",
)
def tree6_merge_numbers(spark, d):
    """TREE6: a clause number alone joins the title after it."""
    n = fx(spark, d, "fx_nodes").select("edition", "pre", "page", "type")
    text = F.when(F.col("pre") % 3 == 1, F.concat(F.lit("4."), "pre")).when(F.col("pre") % 3 == 2, F.concat(F.lit("term of "), "edition")).otherwise("9 other")
    return tr.merge_numbers(n.withColumn("text", text)).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


_CLAUSES = ", c AS (SELECT *, CASE WHEN type = 'section' THEN regexp_extract(text, '^([0-9]{1,3}(\\.[0-9]{1,3})*)', 1) END AS clause FROM fx_nodes)\n"


@query(_CLAUSES + "SELECT clause AS clause_id, count(*) AS n FROM c GROUP BY 1", "fx_nodes")
def tree7_clause_ids(spark, d):
    """TREE7: clause labels of sections; prose gets none."""
    return tr.with_clauses(fx(spark, d, "fx_nodes")).groupBy("clause_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT number, len(string_split(number, '.'))::BIGINT AS depth FROM fx_nodes WHERE number NOT LIKE 'A%' GROUP BY 1", "fx_nodes")
def tree8_parts(spark, d):
    """TREE8: numeric parts of clause labels."""
    n = fx(spark, d, "fx_nodes").select("number", F.size(tx.numeric_parts(F.col("number"))).cast("bigint").alias("depth"))
    return n.filter("depth > 0").distinct()


_FLAT = """, f AS (SELECT edition, pre, number AS clause, CASE WHEN number LIKE 'A%' THEN NULL ELSE number END AS num, coalesce(number LIKE 'A%', FALSE) AS reset FROM fx_nodes),
  g AS (SELECT *, sum(reset::INT) OVER (PARTITION BY edition ORDER BY pre) AS grp FROM f),
  o AS (SELECT *, max(CASE WHEN num IS NOT NULL OR reset THEN pre END) OVER (PARTITION BY edition, grp ORDER BY pre ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lst FROM g),
  u AS (SELECT i.edition, i.pre, max(j.pre) AS up FROM g i JOIN g j ON i.edition = j.edition AND i.grp = j.grp AND j.pre < i.pre AND i.num LIKE j.num || '.%'
        WHERE NOT EXISTS (SELECT 1 FROM g k WHERE k.edition = i.edition AND k.grp = i.grp AND k.pre > j.pre AND k.pre < i.pre AND k.num IS NOT NULL AND k.num NOT LIKE j.num || '.%')
        GROUP BY i.edition, i.pre)
"""


@query(
    _FLAT + "SELECT o.edition, o.pre::BIGINT AS pre, CASE WHEN reset THEN NULL WHEN num IS NOT NULL THEN u.up ELSE lst END::BIGINT AS parent FROM o LEFT JOIN u ON u.edition = o.edition AND u.pre = o.pre",
    "fx_nodes",
)
def tree10_nest_by_clause(spark, d):
    """TREE10: the hierarchy that clause numbers imply."""
    n = fx(spark, d, "fx_nodes").select(
        "edition", "pre", F.lit("section").alias("type"), F.regexp_replace("number", "^A", "Annex A").alias("clause_id"), F.lit(True).alias("relevant")
    )
    return longs(tr.nest(n).select("edition", "pre", "parent"), "pre", "parent")


@query(
    """, t AS (SELECT edition, pre, number AS clause, pre % 3 = 1 AS top, CASE WHEN number LIKE 'A%' THEN NULL ELSE number END AS num FROM fx_nodes),
       x AS (SELECT *, coalesce(min(CASE WHEN top THEN pre END) OVER (PARTITION BY edition ORDER BY pre ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1000) - 1 AS stop FROM t),
       a AS (SELECT c.edition, c.pre, c.num, c.top, (SELECT arg_max(p.num, p.pre) FROM x p WHERE p.edition = c.edition AND p.top AND p.pre < c.pre AND p.num IS NOT NULL AND c.pre <= p.stop) AS near,
             (SELECT arg_max(p.num, p.pre) FROM x p WHERE p.edition = c.edition AND p.top AND p.pre < c.pre AND p.num IS NOT NULL) AS running FROM x c)
       SELECT count(*) FILTER (WHERE NOT top AND num IS NOT NULL AND coalesce(near, running) IS NOT NULL AND num NOT LIKE coalesce(near, running) || '.%') AS hoisted, count(*) AS n FROM a""",
    "fx_nodes",
)
def tree9_hoist(spark, d):
    """TREE9: numbered nodes under a clause that is no prefix of their number."""
    n = fx(spark, d, "fx_nodes").select("edition", "pre", F.col("number").alias("clause_id"), (F.col("pre") % 3 == 1).alias("top"))
    after = Window.partitionBy("edition").orderBy("pre").rowsBetween(1, Window.unboundedFollowing)
    stop = F.coalesce(F.min(F.when(F.col("top"), F.col("pre"))).over(after), F.lit(1000)) - 1
    n = n.withColumn("post_end", F.when(F.col("top"), stop).otherwise(F.col("pre")))
    return tr.hoist(n).agg(F.count_if("hoisted").alias("hoisted"), F.count(F.lit(1)).alias("n"))


_TABLES = """, h AS (SELECT ord, edition, 'T' || (qty % 2) AS sig, 2 + tax % 2 AS n_cols, 1 + disc AS n_rows FROM fx_rows WHERE flag <> 'N')
"""


@query(
    _TABLES + """, m AS (SELECT *, CASE WHEN sig = lag(sig) OVER w AND n_cols = lag(n_cols) OVER w THEN 0 ELSE 1 END AS fresh FROM h WINDOW w AS (PARTITION BY edition ORDER BY ord)),
    i AS (SELECT *, sum(fresh) OVER (PARTITION BY edition ORDER BY ord) AS isl, CASE WHEN fresh = 1 THEN n_rows ELSE n_rows - 1 END AS height FROM m),
    z AS (SELECT edition, isl, min(ord) AS island, count(*) AS tables, sum(height) AS n_rows FROM i GROUP BY ALL)
    SELECT tables, count(*) AS islands, sum(n_rows)::BIGINT AS n_rows FROM z GROUP BY 1""",
    "fx_rows",
)
def tree11_stitch(spark, d):
    """TREE11: consecutive tables with the same header become one."""
    t = fx(spark, d, "fx_rows").filter("flag <> 'N'").select(
        "edition", F.col("ord").alias("pre"), F.array(F.concat(F.lit("T"), (F.col("qty") % 2).cast("string"))).alias("signature"),
        (2 + F.col("tax") % 2).alias("n_cols"), F.lit(1).alias("first_data"), (1 + F.col("disc")).alias("n_rows"),
    )
    s = tb.stitch(t).groupBy("edition", "island").agg(F.count(F.lit(1)).alias("tables"), F.max(F.col("offset") + F.col("n_rows")).alias("n_rows"))
    return s.groupBy("tables").agg(F.count(F.lit(1)).alias("islands"), F.sum("n_rows").cast("bigint").alias("n_rows"))


_PATHS = """, p AS (SELECT d.*, h.text AS head FROM fx_cells d JOIN fx_cells h ON h.edition = d.edition AND h.header AND NOT d.header AND h.col <= d.col AND d.col < h.col + h.colspan)
"""


@query(_PATHS + "SELECT head AS path, count(*) AS cells FROM p GROUP BY 1", "fx_cells")
def tree12_header_paths(spark, d):
    """TREE12: header texts above each data cell."""
    c = tb.header_paths(fx(spark, d, "fx_cells"), "edition")
    return c.groupBy(F.array_join("header_path", " > ").alias("path")).agg(F.count(F.lit(1)).alias("cells"))


@query(
    """, t AS (SELECT CASE WHEN qty % 2 = 0 THEN 'a ' || qty || chr(10) || 'b ' || price ELSE 'a ' || qty || chr(10) || 'b' END AS text FROM fx_rows)
       SELECT len(string_split(string_split(text, chr(10))[2], ' ')) = 2 AS nested, count(*) AS n FROM t GROUP BY 1""",
    "fx_rows",
)
def tree13_nested_tables(spark, d):
    """TREE13: cells whose lines look like rows of a table."""
    second = F.when(F.col("qty") % 2 == 0, F.concat(F.lit("b "), F.col("price").cast("string"))).otherwise("b")
    text = F.concat(F.lit("a "), F.col("qty").cast("string"), F.lit("\n"), second)
    return fx(spark, d, "fx_rows").groupBy(tb.looks_nested(text).alias("nested")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """, t AS (SELECT edition, pre, pre % 3 = 1 AS top, number IS NOT NULL OR pre % 3 <> 1 AS relevant FROM fx_nodes),
       x AS (SELECT *, CASE WHEN top THEN coalesce(min(CASE WHEN top THEN pre END) OVER (PARTITION BY edition ORDER BY pre ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 1000) - 1 ELSE pre END AS stop FROM t)
       SELECT edition, count(*) AS chunks FROM x a WHERE NOT EXISTS (SELECT 1 FROM x b WHERE b.edition = a.edition AND NOT b.relevant AND b.pre <= a.pre AND a.pre <= b.stop) GROUP BY 1""",
    "fx_nodes",
)
def tree14_chunkable(spark, d):
    """TREE14: nodes without an irrelevant ancestor."""
    n = fx(spark, d, "fx_nodes").select("edition", "pre", (F.col("pre") % 3 == 1).alias("top"), (F.col("number").isNotNull() | (F.col("pre") % 3 != 1)).alias("relevant"))
    after = Window.partitionBy("edition").orderBy("pre").rowsBetween(1, Window.unboundedFollowing)
    stop = F.coalesce(F.min(F.when(F.col("top"), F.col("pre"))).over(after), F.lit(1000)) - 1
    n = n.withColumn("post_end", F.when(F.col("top"), stop).otherwise(F.col("pre")))
    return tr.chunkable(n).groupBy("edition").agg(F.count(F.lit(1)).alias("chunks"))


@query(
    """, b AS (SELECT edition, pre, coalesce('S' || edition || '#' || number, 'D' || edition || '#' || substr(sha256(text), 1, 12)) AS base FROM fx_nodes),
       r AS (SELECT *, row_number() OVER (PARTITION BY edition, base ORDER BY pre) - 1 AS k FROM b)
       SELECT edition, pre::BIGINT AS pre, CASE WHEN k = 0 THEN base ELSE base || '~' || k END AS object_id FROM r""",
    "fx_nodes",
)
def tree16_restamp(spark, d):
    """TREE16: content-addressed ids, repeats numbered in reading order."""
    e = F.col("edition").cast("string")
    n = fx(spark, d, "fx_nodes").withColumns({"doc": F.concat(F.lit("D"), e), "standard": F.concat(F.lit("S"), e), "clause_id": F.col("number")})
    return longs(tr.restamp(n).select("edition", "pre", "object_id"), "pre")


@query("SELECT edition, 'IEC 61000-' || (edition % 9) || '-3' AS standard FROM fx_nodes WHERE pre = 1", "fx_nodes")
def tree17_standard_id(spark, d):
    """TREE17: designation on the title page."""
    n = fx(spark, d, "fx_nodes").withColumn("text", F.concat(F.lit("IEC 61000-"), (F.col("edition") % 9).cast("string"), F.lit("-3 Limits, see IEC 60068")))
    return tr.standard_id(n)


# --- texts ------------------------------------------------------------------------------------


@query()
def txt1_unicode_forms(spark, d):
    """TXT1, TXT2, TXT4-TXT7, TXT32: Unicode forms of texts, as counts."""
    t = F.col("text")
    docs = table(spark, d, "documents").select("lang", t, tx.nfc(t).alias("nfc"), tx.compare_form(t).alias("cmp"), tx.folded(t).alias("fold"), tx.bare(t).alias("bare"), tx.is_nfc(t).alias("ok"), tx.preferred(tx.nfc(t), t).alias("pref"))
    sums = [F.sum(F.length(c)).alias(c) for c in ("nfc", "cmp", "fold", "bare", "pref")]
    return docs.groupBy("lang").agg(*sums, F.count_if(~F.col("ok")).alias("not_nfc"), F.count_if(tx.same_content(F.col("text"), F.col("cmp"))).alias("same"))


@query("SELECT edition, pre::BIGINT AS pre, qty || translate(CAST(disc AS VARCHAR), '0123456789', '⁰¹²³⁴⁵⁶⁷⁸⁹') || translate(CAST(tax AS VARCHAR), '0123456789', '₀₁₂₃₄₅₆₇₈₉') AS text FROM (SELECT edition, ord AS pre, qty, disc, tax FROM fx_rows)", "fx_rows")
def txt3_raw_text(spark, d):
    """TXT3: text of runs, raised and lowered digits in Unicode."""
    run = lambda c, a: F.struct(F.col(c).cast("string").alias("text"), F.lit(a).alias("vertical_align"))
    runs = F.array(run("qty", "normal"), run("disc", "superscript"), run("tax", "subscript"))
    return fx(spark, d, "fx_rows").select("edition", F.col("ord").cast("bigint").alias("pre"), tx.raw_text(runs).alias("text"))


@query("SELECT doc_id, len(list_distinct(regexp_extract_all(lower(text), '\\p{L}{3,}')))::BIGINT AS words, len(list_distinct([t FOR t IN string_split_regex(trim(lower(text)), '[ \\t\\n\\x0B\\f\\r]+') IF regexp_matches(t, '[0-9]')]))::BIGINT AS numeric_tokens FROM documents")
def txt8_tokens(spark, d):
    """TXT8, TXT9: distinct words and numeric tokens."""
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.size(tx.content_words(t)).cast("bigint").alias("words"), F.size(tx.numeric_tokens(t)).cast("bigint").alias("numeric_tokens"))


@query("SELECT edition, ord::BIGINT AS ord, k::BIGINT AS k, 'Scope .... ' || (ord + k) AS line FROM (SELECT edition, ord, unnest([0, 1]) AS k FROM fx_rows)", "fx_rows")
def txt10_pseudo_lines(spark, d):
    """TXT10: merged entries split where a page number ends one."""
    text = F.concat(F.lit("Scope .... "), F.col("ord"), F.lit(" Scope .... "), F.col("ord") + 1)
    rows = fx(spark, d, "fx_rows").select("edition", "ord", F.posexplode(tx.pseudo_lines(text)).alias("k", "line"))
    return longs(rows, "ord", "k")


@query(
    """, m AS (SELECT lang, regexp_extract(text, '\\b(shall|should|muss|sollte|doit|devrait)\\b', 1) AS modal FROM fx_nodes)
       SELECT lang, CASE WHEN modal = '' THEN NULL ELSE modal END AS modal, CASE WHEN modal IN ('shall', 'muss', 'doit') THEN 'Requirement' WHEN modal IN ('should', 'sollte', 'devrait') THEN 'Recommendation' END AS role, count(*) AS n
       FROM m GROUP BY ALL""",
    "fx_nodes",
)
def txt11_modal_roles(spark, d):
    """TXT11, TXT12: modal verbs and the role they give, by language."""
    n = fx(spark, d, "fx_nodes").select("lang", F.get(tx.modals(F.col("text"), F.col("lang")), F.lit(0)).alias("modal"), tx.modal_role(F.col("text"), F.col("lang")).alias("role"))
    return n.groupBy("lang", "modal", "role").agg(F.count(F.lit(1)).alias("n"))


_ROLE = """CASE WHEN type = 'section' AND text LIKE '%Scope' AND lang = 'en' THEN 'Scope'
     WHEN regexp_matches(text, '\\b(shall|muss|doit)\\b') THEN 'Requirement' WHEN regexp_matches(text, '\\b(should|sollte|devrait)\\b') THEN 'Recommendation' END"""


@query(f"SELECT lang, {_ROLE} AS role, coalesce({_ROLE} IN ('Scope', 'Requirement'), FALSE) AS normative, count(*) AS n FROM fx_nodes GROUP BY ALL", "fx_nodes")
def txt12_roles(spark, d):
    """TXT12, TXT33: role of a node from heading, admonition or modal; and whether it is normative."""
    t, g = F.col("text"), F.col("lang")
    role = F.coalesce(F.when(F.col("type") == "section", tx.heading_role(t, g)), tx.admonition_role(t, g), tx.modal_role(t, g))
    n = fx(spark, d, "fx_nodes").withColumn("role", role).withColumn("normative", F.coalesce(F.col("role").isin(*lx.NORMATIVE_TYPES), F.lit(False)))
    return n.groupBy("lang", "role", "normative").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang, CASE WHEN lang = 'es' AND k = 2 THEN NULL ELSE lang END AS guess, k::BIGINT AS k, count(*) AS n FROM documents, (SELECT unnest([0, 1, 2]) AS k) WHERE lang IN ('en', 'de', 'fr', 'es') GROUP BY ALL")
def txt13_language(spark, d):
    """TXT13: language by frequent short words; too short or too like another is none."""
    said = {
        "en": ("the test of the unit shall be made", "this is not the limit", "and that is for the unit"),
        "de": ("die Prüfung ist mit dem Gerät", "das ist nicht der Wert", "ein Gerät und eine Leitung"),
        "fr": ("le champ doit être dans les limites", "la tension est une limite", "les essais et des mesures"),
        "es": ("el campo se mide en los puntos", "los valores y las unidades del campo", "de la"),
    }
    texts = F.array(*[F.coalesce(*[F.when(F.col("lang") == g, t[k]) for g, t in said.items()]) for k in range(3)])
    docs = table(spark, d, "documents").filter(F.col("lang").isin(*said)).select("lang", F.posexplode(texts).alias("k", "said"))
    return longs(docs.groupBy("lang", ln.detect(F.col("said")).alias("guess"), "k").agg(F.count(F.lit(1)).alias("n")), "k")


_CELL = """, c AS (SELECT p.*, CASE WHEN text LIKE '%dB' THEN 'dB' WHEN head LIKE 'Limit%' THEN 'V/m' WHEN head LIKE 'Max%' THEN 'dB' END AS unit, replace(replace(text, ' dB', ''), ' ', '') AS value FROM p)
"""


@query(_PATHS + _CELL + "SELECT col::BIGINT AS col, unit, count(*) AS n, count(DISTINCT value) AS vals FROM c WHERE text <> '' GROUP BY ALL", "fx_cells")
def txt14_quantities(spark, d):
    """TXT14: cells that are measurements, with the unit of the cell or its header."""
    c = tb.header_paths(fx(spark, d, "fx_cells"), "edition").withColumn("q", vl.quantity(F.col("text"), F.col("header_path"))).filter("q is not null")
    return longs(c.groupBy("col", F.col("q.unit").alias("unit")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("q.value").alias("vals")), "col")


_PARAMETERS = """, v AS (SELECT *, CASE WHEN text LIKE '%at least %' THEN 'gte' WHEN text LIKE '%at most %' THEN 'lte' END AS comparator, regexp_extract(text, '([0-9]+) (V/m|kHz)$', 1) AS value, regexp_extract(text, '([0-9]+) (V/m|kHz)$', 2) AS unit FROM fx_nodes)
"""


@query(_PARAMETERS + "SELECT lang, unit, comparator, count(*) AS n, sum(value::BIGINT)::BIGINT AS total FROM v WHERE comparator IS NOT NULL GROUP BY ALL", "fx_nodes")
def txt15_parameters(spark, d):
    """TXT15, TXT18: limit values stated in prose."""
    p = ps.prose_parameters(fx(spark, d, "fx_nodes").withColumn("tongue", F.col("lang")), lang="tongue", keep=("lang",))
    return p.groupBy("lang", "unit", "comparator").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("bigint").alias("total"))


@query(_PATHS + _CELL + "SELECT unit, CASE WHEN value LIKE '<%' THEN 'lte' END AS comparator, count(*) AS n, sum(replace(value, '<', '')::BIGINT)::BIGINT AS total FROM c WHERE col > 0 AND text <> '' GROUP BY ALL", "fx_cells")
def txt16_cell_parameters(spark, d):
    """TXT16: limit values of table cells."""
    c = tb.header_paths(fx(spark, d, "fx_cells"), "edition").withColumn("p", vl.cell_parameter(F.col("text"), F.col("header_path"), F.lit("en"))).filter("p is not null")
    return c.groupBy("p.unit", "p.comparator").agg(F.count(F.lit(1)).alias("n"), F.sum("p.value").cast("bigint").alias("total"))


@query("SELECT price % 7 AS k, sum(price::BIGINT)::BIGINT AS total, sum(price::BIGINT)::BIGINT AS local FROM fx_rows GROUP BY 1", "fx_rows")
def txt17_decimals(spark, d):
    """TXT17: thousands in English and decimal commas in German."""
    price = F.col("price")
    en = F.when(price < 1000, price.cast("string")).otherwise(F.concat((F.floor(price / 1000)).cast("string"), F.lit(","), F.lpad((price % 1000).cast("string"), 3, "0")))
    de = F.concat(F.translate(en, ",", "."), F.lit(",0"))
    rows = fx(spark, d, "fx_rows").select((price % 7).alias("k"), vl.decimal(en, F.lit("en")).alias("a"), vl.decimal(de, F.lit("de-DE")).alias("b"))
    return rows.groupBy("k").agg(F.sum("a").cast("bigint").alias("total"), F.sum("b").cast("bigint").alias("local"))


_CANON = """, q AS (SELECT edition, pre, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(latex, '\\$', '', 'g'), '\\\\(left|right)\\b', '', 'g'), '\\\\[,;:!]', ' ', 'g'), '[ \\t\\n]+', ' ', 'g')) AS canon FROM fx_equations)
"""


@query(_CANON + "SELECT canon, regexp_replace(replace(regexp_replace(canon, '\\\\tag *\\{[^{}]*\\}', '', 'g'), '\\text{d}', 'd'), '[ \\t\\n]+', '', 'g') AS form, 'N_{\\text{d}}' AS defines, count(*) AS n FROM q GROUP BY ALL", "fx_equations")
def txt19_equations(spark, d):
    """TXT19-TXT21, TXT25: canonical and comparison form, and what an equation defines."""
    e = fx(spark, d, "fx_equations").withColumn("canon", eq.canonical(F.col("latex")))
    return e.groupBy("canon", eq.compare_form(F.col("latex")).alias("form"), eq.defines(F.col("canon")).alias("defines")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CASE WHEN latex LIKE '%y%' THEN 'N,x,y' ELSE 'N,x,z' END AS symbols, latex LIKE '%right%' AS balanced, count(*) AS n FROM fx_equations GROUP BY ALL", "fx_equations")
def txt22_symbols(spark, d):
    """TXT22, TXT34: symbols of an equation, and whether its brackets match."""
    e = fx(spark, d, "fx_equations").select(
        F.array_join(F.array_remove(eq.symbols(F.regexp_replace("latex", r"\{.text\{d\}\}", "")), ""), ",").alias("symbols"), eq.is_balanced(F.col("latex")).alias("balanced")
    )
    return e.groupBy("symbols", "balanced").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'N' AS surface, count(*) AS n FROM fx_equations WHERE FALSE GROUP BY 1 UNION ALL SELECT 'Nd', count(*) FROM fx_equations", "fx_equations")
def txt23_surfaces(spark, d):
    """TXT23: plain letters of the symbol that an equation defines."""
    return fx(spark, d, "fx_equations").groupBy(eq.surface(eq.defines(eq.canonical(F.col("latex")))).alias("surface")).agg(F.count(F.lit(1)).alias("n")).filter("surface is not null")


_XREFS = """, x AS (SELECT edition, pre, 'clause' AS kind, regexp_extract(text, 'see ([0-9.]+)', 1) AS surface FROM fx_nodes WHERE pre % 3 = 0
  UNION ALL SELECT edition, pre, 'table', 'Table ' || regexp_extract(text, 'Table ([0-9]+)', 1) FROM fx_nodes WHERE pre % 3 = 0
  UNION ALL SELECT edition, pre, 'annex', 'Annex B' FROM fx_nodes WHERE text LIKE '%Annex B')
"""


def xrefs(spark, d):
    n = fx(spark, d, "fx_nodes").select("edition", "pre", F.explode(tx.references(F.col("text"))).alias("x"))
    return n.select("edition", "pre", "x.kind", "x.surface")


@query(_XREFS + "SELECT kind, count(*) AS n, count(DISTINCT surface) AS surfaces FROM x GROUP BY 1", "fx_nodes")
def txt26_xrefs(spark, d):
    """TXT26: references to clauses, tables and annexes."""
    return xrefs(spark, d).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("surface").alias("surfaces"))


@query(f"SELECT source, {_TRIAGE} AS page_class, count(*) AS n, sum(length(text))::BIGINT AS chars FROM documents GROUP BY ALL")
def txt27_triage(spark, d):
    """TXT27: page classes by source."""
    docs = table(spark, d, "documents").select("source", tx.triage(F.col("text"), F.lit(0)).alias("t"))
    return docs.groupBy("source", "t.page_class").agg(F.count(F.lit(1)).alias("n"), F.sum("t.char_count").alias("chars"))


@query(
    """, l AS (SELECT *, arg_max(y0, size * 1000 - ord) OVER (PARTITION BY edition) AS base, max(size) OVER (PARTITION BY edition) AS big FROM fx_words)
       SELECT CASE WHEN size < big AND abs(base - y0) > 0.15 * big THEN CASE WHEN base > y0 THEN 'superscript' ELSE 'subscript' END ELSE 'normal' END AS vertical_align, count(*) AS n FROM l GROUP BY 1""",
    "fx_words",
)
def txt28_vertical(spark, d):
    """TXT28, WIN12: baseline of a line and spans raised or lowered against it."""
    spans = fx(spark, d, "fx_words").withColumnRenamed("y0", "origin_y")
    return cs.line_baseline(spans, "edition").groupBy("vertical_align").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT sum(t)::BIGINT AS top, sum(b)::BIGINT AS bottom FROM (SELECT CASE WHEN y1 > y0 THEN 800 - y1 ELSE y1 END AS t, CASE WHEN y1 > y0 THEN 800 - y0 ELSE y0 END AS b FROM fx_words)", "fx_words")
def txt29_bridge(spark, d):
    """TXT29, UI4: boxes from bottom-left to top-left coordinates."""
    box = cs.to_top_left(F.col("x0"), F.col("y1"), F.col("x1"), F.col("y0"), F.lit(800.0))
    return fx(spark, d, "fx_words").select(box.alias("x")).agg(F.sum("x.t").cast("bigint").alias("top"), F.sum("x.b").cast("bigint").alias("bottom"))


@query("SELECT round(sum(CASE WHEN ord % 2 = 0 THEN least(qty / 50.0, 0.95) ELSE qty / 50.0 END) * 100)::BIGINT AS total FROM fx_rows", "fx_rows")
def txt30_ocr_ceiling(spark, d):
    """TXT30: confidence of OCR texts has a ceiling."""
    c = cs.ocr_ceiling(F.col("qty") / 50.0, F.col("ord") % 2 == 0)
    return fx(spark, d, "fx_rows").agg(F.round(F.sum(c) * 100).cast("bigint").alias("total"))


@query(_CLAUSES + "SELECT clause, count(*) AS n FROM c WHERE clause LIKE '%.%' GROUP BY 1", "fx_nodes")
def txt31_headings(spark, d):
    """TXT31: lines that look like clause headings."""
    n = fx(spark, d, "fx_nodes").filter("type = 'section'").withColumn("clause", mt.heading_candidate(F.col("text")))
    return n.filter("clause is not null").groupBy("clause").agg(F.count(F.lit(1)).alias("n"))


# --- filters and gates --------------------------------------------------------------------------


@query(
    """, r AS (SELECT edition, text, count(DISTINCT page) AS p FROM (SELECT edition, page, regexp_replace(trim(lower(text)), '[ \\t]+', ' ', 'g') AS text FROM fx_lines) WHERE text <> '' GROUP BY ALL HAVING count(DISTINCT page) >= 3),
       y AS (SELECT edition, regexp_replace(trim(lower(text)), '[ \\t]+', ' ', 'g') AS text FROM fx_lines WHERE line_ord % 5 BETWEEN 1 AND 3)
       SELECT y.edition, count(*) AS n FROM y WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.edition = y.edition AND r.text = y.text) GROUP BY 1""",
    "fx_lines",
)
def flt1_furniture(spark, d):
    """FLT1, AGG2: lines outside the margins that do not repeat over pages."""
    lines = rd.text_lines(table(spark, d, "documents"))
    y = (F.col("line_ord") % 5) * 25.0
    lines = lines.withColumns({"y0": y, "y1": y, "horizontal": F.lit(True), "height": F.lit(100.0)}).withColumn("y0", F.when(F.col("line_ord") % 5 == 4, 100.0).otherwise(F.col("y0")))
    return mt.without_furniture(lines, mt.repeated_lines(lines)).groupBy("edition").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT edition, count(*) AS n FROM fx_words WHERE (x0 + x1) / 2 BETWEEN 9 AND 31 AND (y0 + y1) / 2 BETWEEN -1 AND 21 GROUP BY 1", "fx_words")
def flt2_region(spark, d):
    """FLT2, JN2: runs whose centre lies in a region."""
    words = fx(spark, d, "fx_words")
    regions = words.select("edition", "page").distinct().withColumns({"l": F.lit(10.0), "r": F.lit(30.0), "t": F.lit(0.0), "b": F.lit(20.0)})
    return cs.runs_in_regions(words, regions).groupBy("edition").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CASE WHEN pre % 4 = 0 THEN 'text bears digits but has no runs' ELSE 'text not reconstructible from runs' END AS reason, count(*) AS n FROM fx_nodes WHERE pre % 4 = 0 AND regexp_matches(text, '[0-9]') OR pre % 4 = 1 GROUP BY 1", "fx_nodes")
def flt3_run_integrity(spark, d):
    """FLT3, TXT2: gate 2, texts that their runs do not spell out."""
    run = F.array(F.struct(F.when(F.col("pre") % 4 == 1, F.concat("text", F.lit("2"))).otherwise(F.col("text")).alias("text"), F.lit("normal").alias("vertical_align")))
    n = fx(spark, d, "fx_nodes").withColumns({"raw_text": F.lit(None).cast("string"), "runs": F.when(F.col("pre") % 4 != 0, run)})
    return gt.run_integrity(n).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(_PARAMETERS + "SELECT CASE WHEN comparator IS NULL AND unit = 'kHz' THEN 'missing unit; missing comparator' WHEN unit = 'kHz' THEN 'missing unit' ELSE 'missing comparator' END AS reason, count(*) AS n FROM v WHERE unit = 'kHz' OR unit = 'V/m' AND comparator IS NULL GROUP BY 1", "fx_nodes")
def flt4_units(spark, d):
    """FLT4: gate 7, limit values without unit or comparator."""
    n = fx(spark, d, "fx_nodes").filter(F.col("text").rlike("[0-9] (V/m|kHz)$"))
    comparator = F.when(F.contains("text", F.lit("at least ")), "gte").when(F.contains("text", F.lit("at most ")), "lte")
    p = n.select("edition", "pre", F.when(F.contains("text", F.lit("V/m")), "V/m").alias("unit"), F.lit("V/m").alias("raw_unit"), comparator.alias("comparator"), F.lit(None).cast("string").alias("tol_type"))
    return gt.units(p, n.select("edition", "pre", F.col("text").alias("runs"))).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CASE WHEN latex NOT LIKE '%right%' THEN 'unbalanced' ELSE 'symbol not in latex' END AS reason, count(*) AS n FROM fx_equations WHERE latex NOT LIKE '%right%' OR latex NOT LIKE '%y%' GROUP BY 1", "fx_equations")
def flt5_equation_gate(spark, d):
    """FLT5: gate 8, equations that are cut off or lack a symbol."""
    e = fx(spark, d, "fx_equations").withColumn("symbols", F.array(F.lit("x"), F.lit("y")))
    return gt.equations(e).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang, count(*) AS n FROM fx_nodes WHERE regexp_matches(text, '\\b(shall|muss|doit)\\b') AND pre % 2 = 0 GROUP BY 1", "fx_nodes")
def flt6_modal_gate(spark, d):
    """FLT6: gate 6, modal verbs that normalisation changed."""
    changed = F.when(F.col("pre") % 2 == 0, F.regexp_replace("text", r"\b(shall|muss|doit)\b", "X")).otherwise(F.col("text"))
    n = fx(spark, d, "fx_nodes").withColumns({"raw_text": F.col("text"), "normalized_text": changed})
    return gt.modal_verbs(n).join(n.select("edition", "pre", "lang"), ["edition", "pre"]).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT source, bool_or({_TRIAGE} IN ('SCANNED', 'UNCERTAIN')) AS needs_ocr FROM documents GROUP BY 1")
def flt7_needs_ocr(spark, d):
    """FLT7: documents with a page that has no usable text."""
    c = tx.triage(F.col("text"), F.lit(0))["page_class"]
    return table(spark, d, "documents").groupBy("source").agg(F.max(c.isin("SCANNED", "UNCERTAIN")).alias("needs_ocr"))


_DANGLING = _XREFS + """, cl AS (SELECT DISTINCT edition, number AS surface FROM fx_nodes WHERE number IS NOT NULL),
  ca AS (SELECT DISTINCT edition, CAST(pre % 3 AS VARCHAR) AS num FROM fx_nodes WHERE type = 'section'), mx AS (SELECT edition, max(num::INT) AS most FROM ca GROUP BY 1),
  dg AS (SELECT x.edition, x.pre, x.surface FROM x WHERE kind IN ('clause', 'annex') AND NOT EXISTS (SELECT 1 FROM cl WHERE cl.edition = x.edition AND cl.surface = x.surface)
    UNION ALL SELECT x.edition, x.pre, x.surface FROM x LEFT JOIN mx ON mx.edition = x.edition WHERE kind = 'table' AND NOT EXISTS (SELECT 1 FROM ca WHERE ca.edition = x.edition AND 'Table ' || ca.num = x.surface)
       AND NOT coalesce(replace(x.surface, 'Table ', '')::INT > mx.most, FALSE))
"""


def _refs_gate(spark, d):
    n = fx(spark, d, "fx_nodes")
    clauses = n.filter("number is not null").select("edition", F.col("number").alias("clause_id"))
    captions = n.filter("type = 'section'").select("edition", F.lit("table").alias("kind"), (F.col("pre") % 3).cast("string").alias("num"))
    return gt.cross_reference(xrefs(spark, d), clauses, captions)


@query(_DANGLING + "SELECT edition, pre::BIGINT AS pre, 'unresolved ' || string_agg(surface, ',' ORDER BY surface) AS reason FROM dg GROUP BY edition, pre", "fx_nodes")
def jn1_cross_reference(spark, d):
    """JN1: gate 9, references to what the edition lacks."""
    return longs(_refs_gate(spark, d).select("edition", "pre", "reason"), "pre")


@query(
    """, t AS (SELECT edition, 1 AS page, ord AS pre, 2 + disc AS n_rows, 3 AS n_cols FROM fx_rows WHERE flag = 'A'),
       g AS (SELECT edition, 1 AS page, ord AS grid_ord, 2 + tax AS g_rows, 2 + qty % 3 AS g_cols FROM fx_rows WHERE flag <> 'A'),
       m AS (SELECT t.edition, t.pre, g.grid_ord, abs(n_rows - g_rows) + abs(n_cols - g_cols) AS gap FROM t LEFT JOIN g USING (edition, page))
       SELECT edition, pre::BIGINT AS pre, arg_min(grid_ord, gap * 1000 + grid_ord)::BIGINT AS grid_ord, min(gap)::BIGINT AS gap FROM m GROUP BY edition, pre""",
    "fx_rows",
)
def jn3_nearest_grid(spark, d):
    """JN3: the grid of a page that fits a table best."""
    r = fx(spark, d, "fx_rows")
    t = r.filter("flag = 'A'").select("edition", F.lit(1).alias("page"), F.col("ord").alias("pre"), (2 + F.col("disc")).alias("n_rows"), F.lit(3).alias("n_cols"))
    g = r.filter("flag <> 'A'").select("edition", F.lit(1).alias("page"), F.col("ord").alias("grid_ord"), (2 + F.col("tax")).alias("g_rows"), (2 + F.col("qty") % 3).alias("g_cols"))
    return longs(cs.nearest_grid(t, g).select("edition", "pre", "grid_ord", "gap"), "pre", "grid_ord", "gap")


@query("SELECT number AS clause_id, count(DISTINCT lang) AS langs, count(*) AS nodes, 'tg:' || number AS grp FROM (SELECT *, 'x' FROM fx_nodes) WHERE number LIKE 'A%' GROUP BY number HAVING count(DISTINCT lang) >= 2", "fx_nodes")
def jn5_translations(spark, d):
    """JN5: clauses found in several languages."""
    return cs.translation_groups(fx(spark, d, "fx_nodes").filter("number like 'A%'").withColumn("clause_id", F.col("number")))


@query(
    """, p AS (SELECT DISTINCT edition, page, CASE (edition + page) % 4 WHEN 0 THEN 'DIGITAL_CLEAN' WHEN 1 THEN 'DIGITAL_DIRTY' WHEN 2 THEN 'SCANNED' ELSE 'UNCERTAIN' END AS c FROM fx_nodes)
       SELECT c AS page_class, count(*) AS n, round(sum(CASE c WHEN 'DIGITAL_DIRTY' THEN 0.75 WHEN 'SCANNED' THEN 0.5 WHEN 'UNCERTAIN' THEN 0.6 ELSE 0.95 END) * 100)::BIGINT AS total FROM fx_nodes JOIN p USING (edition, page) GROUP BY 1""",
    "fx_nodes",
)
def jn7_downgrade(spark, d):
    """JN7, JN6: confidence of nodes on doubtful pages."""
    n = fx(spark, d, "fx_nodes").withColumn("confidence", F.lit(0.95))
    pick = F.element_at(F.array(*[F.lit(c) for c in lx.PAGE_CLASSES]), ((F.col("edition") + F.col("page")) % 4 + 1).cast("int"))
    got = cs.downgrade(n, n.select("edition", "page").distinct().withColumn("page_class", pick))
    return got.groupBy("page_class").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("confidence") * 100).cast("bigint").alias("total"))


@query(
    """SELECT d.source AS doc, count(*) FILTER (WHERE l.quality = 1 AND length(d.text) >= 2000) AS false_exclusions, count(*) FILTER (WHERE l.quality = 0 AND length(d.text) < 2000) AS false_inclusions, 0::BIGINT AS unmatched
       FROM labels l JOIN documents d USING (doc_id) GROUP BY 1"""
)
def jn9_gold(spark, d):
    """JN9: labels as gold, a length rule as the classifier."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    gold = docs.select(F.col("source").alias("doc"), F.concat(F.lit("#"), F.col("doc_id").cast("string"), F.lit("#")).alias("match"), (F.col("quality") == 1).alias("gold_relevant"))
    sections = docs.select(F.col("source").alias("edition"), F.concat(F.lit("s #"), F.col("doc_id").cast("string"), F.lit("#")).alias("heading"), (F.length("text") < 2000).alias("relevant"))
    return rl.gold_check(gold, sections)


@query(
    """, t AS (SELECT edition, pre, (pre + 1) // 2 AS parent, pre % 2 = 0 AS eq, CASE WHEN length(text) % 3 = 0 THEN 'the N_d value' WHEN length(text) % 3 = 1 THEN 'the N d value' ELSE 'an N_dx or RNd' END AS text, type = 'paragraph' AS normative FROM fx_nodes),
       b AS (SELECT edition, parent, bool_or(normative AND NOT eq AND text LIKE 'the N%') AS hit FROM t GROUP BY ALL)
       SELECT hit AS computes_limit, count(*) AS n FROM t JOIN b USING (edition, parent) WHERE eq GROUP BY 1""",
    "fx_nodes",
)
def jn4_computes_limit(spark, d):
    """JN4: equations whose symbol occurs in normative text beside them."""
    n = F.length("text") % 3
    said = F.when(n == 0, "the N_d value").when(n == 1, "the N d value").otherwise("an N_dx or RNd")
    even = F.col("pre") % 2 == 0
    nodes = fx(spark, d, "fx_nodes").select(
        "edition", "pre", F.floor((F.col("pre") + 1) / 2).alias("parent"), (F.col("type") == "paragraph").alias("normative"),
        F.when(even, "equation").otherwise("paragraph").alias("type"), said.alias("text"), F.when(even, "N_{\\text{d}}").alias("defines"),
    )
    got = eq.computes_limit(nodes).filter("type = 'equation'")
    return got.groupBy("computes_limit").agg(F.count(F.lit(1)).alias("n"))


# --- aggregates and votes -------------------------------------------------------------------------


@query(
    """, l AS (SELECT edition, trim(text) AS line, count(DISTINCT page) AS pages FROM fx_lines WHERE trim(text) <> '' AND len([w FOR w IN string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+') IF w <> '']) <= 12 GROUP BY ALL)
       SELECT edition, line, pages FROM l WHERE pages >= 3""",
    "fx_lines",
)
def agg1_running_headers(spark, d):
    """AGG1: lines on at least three pages of a document."""
    return gt.running_headers(rd.text_lines(table(spark, d, "documents")))


@query(
    """, s AS (SELECT edition, r, c, count(*) AS n FROM (SELECT edition, row AS r, col + k AS c FROM (SELECT *, unnest(range(colspan)) AS k FROM fx_cells)) GROUP BY ALL),
       t AS (SELECT edition, count(*) FILTER (WHERE n > 1) AS twice, (max(r) + 1) * (max(c) + 1) - count(*) AS holes FROM s GROUP BY 1)
       SELECT twice > 0 AS overlap, holes > 0 AS hole, count(*) AS tables, sum(twice)::BIGINT AS n_twice, sum(holes)::BIGINT AS n_holes FROM t GROUP BY ALL""",
    "fx_cells",
)
def agg4_coverage(spark, d):
    """AGG4: gate 4, positions covered twice or not at all."""
    c = tb.coverage(fx(spark, d, "fx_cells"), "edition")
    c = c.select((F.col("overlaps") > 0).alias("overlap"), (F.col("holes") > 0).alias("hole"), "overlaps", F.col("holes").alias("h"))
    return c.groupBy("overlap", "hole").agg(F.count(F.lit(1)).alias("tables"), F.sum("overlaps").alias("n_twice"), F.sum("h").cast("bigint").alias("n_holes"))


@query(_PATHS + "SELECT head AS header, count(*) AS blanks FROM p WHERE text = '' GROUP BY 1", "fx_cells")
def agg4_blank_limits(spark, d):
    """AGG4: blank cells in a limit column."""
    return tb.blank_limits(tb.header_paths(fx(spark, d, "fx_cells"), "edition")).groupBy(F.get("header_path", F.lit(0)).alias("header")).agg(F.count(F.lit(1)).alias("blanks"))


_VOTES = """, w AS (SELECT *, CASE parser WHEN 'pymupdf' THEN 1 WHEN 'surya' THEN 3 ELSE 4 END AS rk, trim(text) AS form FROM fx_candidates WHERE text IS NOT NULL),
  a AS (SELECT edition, arg_min(parser, rk) AS authority, arg_min(form, rk) AS af, bool_or(normative) AS normative, count(*) AS voters FROM w GROUP BY 1),
  z AS (SELECT a.*, (SELECT count(*) FROM w WHERE w.edition = a.edition AND w.form <> a.af) AS against FROM a WHERE voters >= 2)
"""


@query(
    _VOTES + "SELECT authority, voters, CASE WHEN against = 0 THEN 'unanimous' WHEN normative THEN 'quarantined' WHEN 2 * (voters - against) > voters THEN 'majority' ELSE 'quarantined' END AS state, count(*) AS n FROM z GROUP BY ALL",
    "fx_candidates",
)
def agg5_text_votes(spark, d):
    """AGG5, AGG6: states of texts by the vote of their transcriptions."""
    return cs.text_votes(fx(spark, d, "fx_candidates")).groupBy("authority", "voters", "state").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT CASE WHEN ord % 5 = 0 OR disc % 3 <> tax % 3 THEN 'quarantined' WHEN qty % 3 = disc % 3 THEN 'unanimous' ELSE 'majority' END AS state, count(*) AS n FROM fx_rows GROUP BY 1""",
    "fx_rows",
)
def agg7_grid_votes(spark, d):
    """AGG7: states of table grids."""
    r = fx(spark, d, "fx_rows").select(
        F.when(F.col("ord") % 5 != 0, F.col("disc") % 3).alias("l_rows"), F.lit(2).alias("l_cols"), (F.col("tax") % 3).alias("r_rows"), F.lit(2).alias("r_cols"), (F.col("qty") % 3).alias("w_rows"), F.lit(2).alias("w_cols")
    )
    return cs.grid_votes(r).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CASE WHEN count(*) >= 3 AND count(DISTINCT disc % 2) = 1 THEN 'unanimous' ELSE 'quarantined' END AS state, edition FROM fx_rows GROUP BY edition", "fx_rows")
def agg8_strict_votes(spark, d):
    """AGG8: grids that all parsers, three at least, must agree on."""
    g = fx(spark, d, "fx_rows").select("edition", F.concat(F.lit("p"), "ord").alias("parser"), (F.col("disc") % 2).alias("n_rows"), F.lit(1).alias("n_cols"), F.array(F.lit(1)).alias("spans"))
    return cs.strict_grid_votes(g, "edition").select("state", "edition")


@query("SELECT CASE WHEN latex LIKE '%y%' THEN 'quarantined' ELSE 'unanimous' END AS state, CASE WHEN latex LIKE '%y%' THEN 'mineru' ELSE '' END AS dissenters, count(*) AS n FROM fx_equations GROUP BY ALL", "fx_equations")
def agg9_equation_votes(spark, d):
    """AGG9: engines' formulas against the authority's."""
    e = fx(spark, d, "fx_equations")
    other = F.regexp_replace(F.regexp_replace("latex", "y", "v"), r"\\text", r"\\mathrm")
    both = e.select("edition", "pre", F.lit("docling_formula").alias("parser"), "latex").unionByName(e.select("edition", "pre", F.lit("mineru").alias("parser"), other.alias("latex")))
    return cs.equation_votes(both).groupBy("state", "dissenters").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT n_rows, n_cols, count(*) AS n FROM (SELECT edition, max(row + rowspan)::BIGINT AS n_rows, max(col + colspan)::BIGINT AS n_cols FROM fx_cells GROUP BY 1) GROUP BY ALL", "fx_cells")
def agg10_layout_grid(spark, d):
    """AGG10: rows and columns of tables."""
    s = longs(tb.signatures(fx(spark, d, "fx_cells"), "edition"), "n_rows", "n_cols")
    return s.groupBy("n_rows", "n_cols").agg(F.count(F.lit(1)).alias("n"))


@query(
    """, v AS (SELECT edition, (y0 + y1) / 2 AS y, (x0 + x1) / 2 AS x FROM fx_words),
       r AS (SELECT edition, 1 + count(*) FILTER (WHERE g > 1.8) AS n_rows FROM (SELECT edition, y - lag(y) OVER (PARTITION BY edition ORDER BY y) AS g FROM v) GROUP BY 1),
       c AS (SELECT edition, 1 + count(*) FILTER (WHERE g > 3) AS n_cols FROM (SELECT edition, x - lag(x) OVER (PARTITION BY edition ORDER BY x) AS g FROM v) GROUP BY 1)
       SELECT edition, n_rows, n_cols FROM r JOIN c USING (edition)""",
    "fx_words",
)
def agg11_word_grid(spark, d):
    """AGG11: rows and columns from the places of words."""
    return tb.word_grid(fx(spark, d, "fx_words"), "edition")


@query("SELECT edition, arg_max(lang, n * 1000 - f) AS lang FROM (SELECT edition, CASE WHEN pre % 3 = 0 THEN lang ELSE 'x' || (pre % 2) END AS lang, count(*) AS n, min(pre) AS f FROM fx_nodes GROUP BY ALL) GROUP BY 1", "fx_nodes")
def agg12_language(spark, d):
    """AGG12: the most frequent language, the first one on ties."""
    lang = F.when(F.col("pre") % 3 == 0, F.col("lang")).otherwise(F.concat(F.lit("x"), (F.col("pre") % 2).cast("string")))
    return cs.dominant_language(fx(spark, d, "fx_nodes").withColumn("lang", lang))


@query(_DANGLING + "SELECT 'cross_reference' AS gate, count(*) AS quarantine, 0::BIGINT AS repair FROM (SELECT DISTINCT edition, pre FROM dg)", "fx_nodes")
def agg13_gate_counts(spark, d):
    """AGG13, SET1: outcomes by gate and verdict."""
    return gt.summary(gt.union([_refs_gate(spark, d), _refs_gate(spark, d).filter("false")]))


@query(
    "SELECT edition, count(*) AS nodes, count(*) FILTER (WHERE type = 'section') AS sections, count(*) FILTER (WHERE type = 'paragraph') AS paragraphs, count(number) AS clauses, count(DISTINCT lang) AS langs, max(page)::BIGINT AS pages, sum(length(text))::BIGINT AS chars FROM fx_nodes GROUP BY 1",
    "fx_nodes",
)
def agg14_profile(spark, d):
    """AGG14, SET2: profile of each edition."""
    return longs(mt.profile(fx(spark, d, "fx_nodes").withColumn("clause_id", F.col("number"))), "pages")


_COVER = """, a AS (SELECT edition, page, list_distinct(regexp_extract_all(lower(string_agg(text, ' ')), '\\p{L}{3,}')) AS s FROM fx_lines GROUP BY ALL),
  b AS (SELECT edition, page, list_distinct(regexp_extract_all(lower(string_agg(text, ' ')), '\\p{L}{3,}')) AS x FROM fx_lines WHERE line_ord % 3 > 0 GROUP BY ALL),
  c AS (SELECT edition, page, len(s) AS total, len([w FOR w IN s IF NOT coalesce(list_contains(x, w), FALSE)]) AS missed FROM a LEFT JOIN b USING (edition, page))
"""


def _covered(spark, d):
    lines = rd.text_lines(table(spark, d, "documents"))
    bag = lambda df, name: df.groupBy("edition", "page").agg(F.concat_ws(" ", F.collect_list("text")).alias("t")).select("edition", "page", tx.content_words(F.col("t")).alias(name))
    pages = bag(lines, "source").join(bag(lines.filter("line_ord % 3 > 0"), "extracted"), ["edition", "page"], "left")
    return mt.coverage(pages.withColumn("extracted", F.coalesce("extracted", F.array().cast("array<string>"))))


@query(_COVER + "SELECT edition, page::BIGINT AS page, total::BIGINT AS total, missed::BIGINT AS missed FROM c", "fx_lines")
def agg16_coverage(spark, d):
    """AGG15-AGG17, SET3, SET5, MET2: words of a page that the extraction misses."""
    return longs(_covered(spark, d).select("edition", "page", F.size("source").alias("total"), "missed"), "page", "total", "missed")


@query(
    _COVER + """, k AS (SELECT edition, page, row_number() OVER (PARTITION BY edition ORDER BY 1 - missed / greatest(total, 1), page) AS r FROM c WHERE missed > 0)
    SELECT edition, page::BIGINT AS page, r::BIGINT AS rank FROM k WHERE r <= 5""",
    "fx_lines",
)
def srt3_worst_pages(spark, d):
    """SRT3, SRT5: the five pages of a document that miss most."""
    return longs(mt.worst(_covered(spark, d)).select("edition", "page", "rank"), "page", "rank")


@query(
    """, r AS (SELECT source, count(*) AS pages, count(*) FILTER (WHERE length(text) > 500) AS hit, count(*) AS total, bool_or(length(text) < 20) AS alarm FROM documents GROUP BY 1)
       SELECT count(*) AS documents, sum(pages)::BIGINT AS pages, round(sum(hit) / sum(total) * 1000)::BIGINT AS recall, count(*) FILTER (WHERE alarm) AS alarms FROM r""".lstrip(", ").replace("r AS", "WITH r AS", 1)
)
def agg18_pooled(spark, d):
    """AGG18: pooled ratios over the corpus."""
    r = table(spark, d, "documents").groupBy("source").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.length("text") > 500).alias("hit"), F.count(F.lit(1)).alias("total"), F.max(F.length("text") < 20).alias("alarm"), F.lit(1.0).alias("coverage")
    )
    return mt.pooled(r).select("documents", "pages", F.round(F.col("recall") * 1000).cast("bigint").alias("recall"), "alarms")


@query(_DANGLING + "SELECT e.edition, count(DISTINCT dg.pre) AS quarantines, CASE WHEN count(dg.pre) > 0 THEN 2 ELSE 0 END::BIGINT AS status FROM (SELECT DISTINCT edition FROM fx_nodes) e LEFT JOIN dg USING (edition) GROUP BY 1", "fx_nodes")
def agg19_exit_status(spark, d):
    """AGG19: status of each edition."""
    return longs(gt.exit_status(fx(spark, d, "fx_nodes").select("edition").distinct(), _refs_gate(spark, d)), "status")


@query(
    """, r AS (SELECT edition, ord AS pos, row_number() OVER (PARTITION BY edition ORDER BY y0 DESC, ord) AS k FROM fx_words),
       p AS (SELECT a.edition, sum(CASE WHEN b.k > a.k THEN 1 ELSE -1 END) AS s, count(*) AS n FROM r a JOIN r b ON a.edition = b.edition AND a.pos < b.pos GROUP BY 1)
       SELECT e.edition, round(coalesce(s / n, 1.0) * 1000)::BIGINT AS tau FROM (SELECT DISTINCT edition FROM fx_words) e LEFT JOIN p USING (edition)""",
    "fx_words",
)
def agg20_kendall(spark, d):
    """AGG20: reading order against the order on the page."""
    rows = fx(spark, d, "fx_words").select("edition", F.col("ord").alias("pos"), F.col("y0").alias("y"))
    return mt.kendall(rows, "edition").select("edition", F.round(F.col("tau") * 1000).cast("bigint").alias("tau"))


# --- windows ------------------------------------------------------------------------------------------


@query(
    """, s AS (SELECT edition, pre, number, string_split(number, '.') AS p FROM fx_nodes WHERE number NOT LIKE 'A%'),
       w AS (SELECT *, lag(p) OVER (PARTITION BY edition ORDER BY pre) AS q FROM s),
       m AS (SELECT edition, pre, p[1:len(p)-1] AS stem, q[len(q)]::INT AS a, p[len(p)]::INT AS b FROM w WHERE len(p) = len(q) AND p[1:len(p)-1] = q[1:len(q)-1]),
       g AS (SELECT edition, pre, array_to_string(stem, '.') || '.' || k AS missing FROM (SELECT edition, pre, stem, unnest(range(a + 1, b)) AS k FROM m WHERE b > a + 1)),
       x AS (SELECT edition, pre, count(*) AS n FROM g WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.edition = g.edition AND s.number = g.missing) GROUP BY ALL)
       SELECT edition, pre::BIGINT AS pre, 'dropped' AS kind FROM x UNION ALL SELECT edition, pre, 'non-increasing' FROM m WHERE b <= a""",
    "fx_nodes",
)
def win1_numbering(spark, d):
    """WIN1: gate 3, clause numbers that are missing or turn back."""
    n = fx(spark, d, "fx_nodes").select("edition", "pre", F.lit(0).alias("parent"), F.when(~F.col("number").startswith("A"), F.col("number")).alias("clause_id"))
    return longs(gt.numbering(n).select("edition", "pre", F.element_at(F.split("reason", " "), 1).alias("kind")), "pre")


@query(
    """, t AS (SELECT edition, ord, CAST(qty % 2 AS VARCHAR) AS a, CAST(tax % 2 AS VARCHAR) AS b, lag(CAST(qty % 2 AS VARCHAR)) OVER w AS pa, lag(CAST(tax % 2 AS VARCHAR)) OVER w AS pb, lag(ord) OVER w AS po FROM fx_rows WINDOW w AS (PARTITION BY edition ORDER BY ord)),
       v AS (SELECT *, (a = pa)::INT + (b = pb)::INT AS same FROM t WHERE po IS NOT NULL)
       SELECT CASE same WHEN 2 THEN 'repair' ELSE 'quarantine' END AS verdict, 2 * count(*) AS n FROM v WHERE same > 0 GROUP BY 1""",
    "fx_rows",
)
def win2_continuation(spark, d):
    """WIN2: gate 5, neighbouring tables with equal or partly equal headers."""
    t = fx(spark, d, "fx_rows").select("edition", F.col("ord").alias("pre"), F.array((F.col("qty") % 2).cast("string"), (F.col("tax") % 2).cast("string")).alias("signature"), F.lit(True).alias("flagged"))
    return tb.continuation(t).groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


@query(
    """, s AS (SELECT edition, pre, number, qty > 30 AS idx FROM (SELECT n.*, r.qty FROM fx_nodes n JOIN fx_rows r ON r.edition = n.edition AND r.ord = n.pre)),
       b AS (SELECT edition, coalesce(min(CASE WHEN pre = 3 THEN pre END), max(pre) + 1) AS body, coalesce(max(CASE WHEN NOT idx THEN pre END), -1) + 1 AS back FROM s GROUP BY 1)
       SELECT CASE WHEN pre < body THEN 'front' WHEN pre >= greatest(back, body) THEN 'back' ELSE 'body' END AS zone, count(*) AS n FROM s JOIN b USING (edition) GROUP BY 1""",
    "fx_nodes", "fx_rows",
)
def win3_zones(spark, d):
    """WIN3: front, body and back of a document."""
    r = fx(spark, d, "fx_rows").select("edition", "ord", F.when(F.col("ord") == 3, "1").alias("clause_id"), F.when(F.col("qty") > 30, 0.9).otherwise(0.1).alias("index"))
    return rl.zones(r).groupBy("zone").agg(F.count(F.lit(1)).alias("n"))


@query(
    """, s AS (SELECT source, line_ord, doc, regexp_matches(text, '[.\\s]{2,}[0-9]{1,4}\\s*$') AS num FROM (SELECT edition AS doc, source, line_ord, text FROM fx_lines) WHERE trim(text) <> ''),
       p AS (SELECT doc, count(*) AS n, avg(num::INT) AS share FROM s GROUP BY 1)
       SELECT doc AS edition, n, CASE WHEN n >= 8 THEN round(share * 100) ELSE 0 END::BIGINT AS toc FROM p""",
    "fx_lines",
)
def agg3_shapes(spark, d):
    """AGG3: how far the lines of a section look like a table of contents."""
    lines = rd.text_lines(table(spark, d, "documents")).select("edition", F.col("line_ord").alias("ord"), F.col("text").alias("line"))
    return rl.shapes(lines, "edition").select("edition", "n", F.round(F.col("toc") * 100).cast("bigint").alias("toc"))


@query(
    """SELECT CASE WHEN ord > 4 THEN 'normative' WHEN qty % 5 = 0 AND disc > 4 THEN 'toc' WHEN ord = 1 AND price < 20000 THEN 'title_page' WHEN qty % 5 = 1 THEN 'foreword' WHEN qty % 5 = 2 THEN 'preface' ELSE 'normative' END AS role, count(*) AS n FROM (
         SELECT *, CASE WHEN disc > 4 THEN 0.8 ELSE 0 END AS t FROM fx_rows) GROUP BY 1""",
    "fx_rows",
)
def win4_roles(spark, d):
    """WIN4: roles of sections by shape, heading and place."""
    r = fx(spark, d, "fx_rows")
    heading = F.when(F.col("qty") % 5 == 0, "toc").when(F.col("qty") % 5 == 1, "foreword").when(F.col("qty") % 5 == 2, "preface")
    s = r.select(
        F.when(F.col("ord") > 4, "body").otherwise("front").alias("zone"), (F.col("ord") == 1).alias("first"), F.lit(1).alias("page"), F.array_compact(F.array(heading)).alias("heading_roles"),
        F.when((F.col("disc") > 4) & (F.col("qty") % 5 == 0), 1.0).otherwise(0.0).alias("toc"), F.lit(0.0).alias("index"),
        F.when((F.col("price") < 20000) & ~((F.col("disc") > 4) & (F.col("qty") % 5 == 0)), 10).otherwise(1000).alias("chars"),
    )
    return rl.classify(s).groupBy(F.col("section_role").alias("role")).agg(F.count(F.lit(1)).alias("n"))


@query()
def win13_reading_order(spark, d):
    """WIN13: lines by distance to their first baseline."""
    spans = fx(spark, d, "fx_words").withColumn("origin_y", F.col("y0"))
    return cs.reading_lines(spans, "edition").groupBy("edition").agg(F.max("line").alias("lines"), F.max("reading").alias("spans"))


# --- orders, views, streams -------------------------------------------------------------------------------


@query("SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rank FROM documents")
def srt1_discrepancy(spark, d):
    """SRT1: changes by falling score, ties by id."""
    return vw.by_discrepancy(table(spark, d, "documents").select("doc_id", "n_chars"), "n_chars", "doc_id").select("doc_id", "rank")


_STATUS = _VOTES + """, q AS (SELECT edition, CASE WHEN against = 0 THEN 'unanimous' WHEN normative THEN 'quarantined' WHEN 2 * (voters - against) > voters THEN 'majority' ELSE 'quarantined' END AS state FROM z),
  t AS (SELECT edition, CASE WHEN state = 'quarantined' THEN 'critical' WHEN edition % 7 = 0 THEN 'serious' WHEN state = 'majority' THEN 'warning' WHEN edition % 6 = 0 THEN 'excluded' ELSE 'good' END AS status FROM q)
"""


def _status(spark, d):
    v = cs.text_votes(fx(spark, d, "fx_candidates"))
    return v.select("edition", vw.status(F.col("state"), F.col("edition") % 7 == 0, F.col("edition") % 6 != 0).alias("status"))


@query(_STATUS + "SELECT status, count(*) AS n FROM t GROUP BY 1", "fx_candidates")
def ui1_scorecard(spark, d):
    """UI1, UI2: nodes by status."""
    return _status(spark, d).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(_STATUS + "SELECT edition, (SELECT count(*) FROM t WHERE status IN ('critical', 'serious', 'warning')) AS total FROM t WHERE status IN ('critical', 'serious', 'warning') ORDER BY edition % 10, edition LIMIT 300", "fx_candidates")
def srt2_review_queue(spark, d):
    """SRT2: the review queue with its true length."""
    n = _status(spark, d).withColumns({"confidence": F.col("edition") % 10, "pre": F.lit(0)})
    return vw.review_queue(n).select("edition", "total")


@query("SELECT doc_id FROM documents ORDER BY md5('4242:' || doc_id), doc_id LIMIT 20")
def srt4_sample(spark, d):
    """SRT4, SRT6: a seeded sample."""
    return vw.seeded_sample(table(spark, d, "documents").select("doc_id"), "doc_id", 20, 4242)


@query(
    _XREFS + """, l AS (SELECT edition, number, max(pre) AS dst FROM fx_nodes WHERE number IS NOT NULL GROUP BY ALL),
    p AS (SELECT edition, pre, max(CASE WHEN type = 'section' THEN pre END) OVER (PARTITION BY edition ORDER BY pre ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS parent, type FROM fx_nodes),
    g AS (SELECT edition, min(pre) OVER (PARTITION BY edition, lang) AS src, pre FROM fx_nodes WHERE number LIKE 'A%')
    SELECT 'nesting' AS edge, count(*) AS n FROM p WHERE type <> 'section' AND parent IS NOT NULL
    UNION ALL SELECT 'xref', count(*) FROM (SELECT DISTINCT x.edition, x.pre, l.dst FROM x JOIN l ON l.edition = x.edition AND l.number = x.surface WHERE x.pre <> l.dst)
    UNION ALL SELECT 'translation', count(*) FROM g WHERE src <> pre HAVING count(*) > 0""",
    "fx_nodes",
)
def ui3_edges(spark, d):
    """UI3: edges of the document graph."""
    n = fx(spark, d, "fx_nodes").withColumn("clause_id", F.col("number"))
    up = F.max(F.when(F.col("type") == "section", F.col("pre"))).over(tr.before())
    nodes = n.withColumn("parent", F.when(F.col("type") != "section", up))
    none = n.select("edition", F.col("pre").alias("src"), F.col("pre").alias("to")).filter("false")
    groups = n.filter("number like 'A%'").select("edition", "pre", F.col("lang").alias("grp"))
    return vw.edges(nodes, xrefs(spark, d), none, groups).groupBy("edge").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(DISTINCT coalesce(text, '')) AS stored, count(DISTINCT coalesce(text, '')) AS again, 2 * count(DISTINCT coalesce(text, '')) AS with_other_version FROM documents")
def str1_idempotent(spark, d):
    """STR1-STR3, SNK1: the store takes a key once: a second run adds nothing, another version everything."""
    docs = table(spark, d, "documents").select(F.coalesce("text", F.lit("")).alias("text"))
    store, sizes = st.Store(spark, st.scratch(spark, "store")), []
    for version in (st.version(), st.version(), st.version("fast")):
        store.put(docs.select(st.key(F.col("text"), version).alias("key"), F.lit(version).alias("version")))
        sizes.append(store.read().count())
    return spark.createDataFrame([tuple(sizes)], "stored bigint, again bigint, with_other_version bigint")


@query(
    """, i AS (SELECT greatest(tax % 3, 1)::BIGINT AS rowspan, greatest(disc % 4 - 1, 1)::BIGINT AS colspan, coalesce(CASE WHEN ord = 1 THEN TRUE WHEN ord = 2 THEN FALSE END, FALSE) AS header FROM fx_rows)
       SELECT rowspan, colspan, header, count(*) AS cells FROM i GROUP BY ALL""",
    "fx_rows",
)
def tree3_cells(spark, d):
    """TREE3: cells of table items; a span is at least one, a missing header flag is none."""
    i = F.col("ord")
    items = fx(spark, d, "fx_rows").select(
        "edition", i.alias("start_row"), (i + F.col("tax") % 3).alias("end_row"), F.col("disc").alias("start_col"),
        (F.col("disc") + F.col("disc") % 4 - 1).alias("end_col"), F.when(i == 1, True).when(i == 2, False).alias("header"),
    )
    got = tb.cells(items).groupBy("rowspan", "colspan", "header").agg(F.count(F.lit(1)).alias("cells"))
    return longs(got, "rowspan", "colspan")


@query(
    _CLAUSES + ", h AS (SELECT edition, clause FROM c WHERE clause LIKE '%.%'), k AS (SELECT DISTINCT edition, number AS clause FROM fx_nodes)"
    " SELECT count(*) AS total, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM k WHERE k.edition = h.edition AND k.clause = h.clause)) AS hit FROM h",
    "fx_nodes",
)
def jn8_heading_recall(spark, d):
    """JN8: clause headings of the source that the extraction has."""
    n = fx(spark, d, "fx_nodes")
    lines = n.filter("type = 'section'").select("edition", mt.heading_candidate(F.col("text")).alias("clause")).filter("clause is not null")
    known = n.filter("number is not null").select("edition", F.col("number").alias("clause")).distinct().withColumn("known", F.lit(True))
    return lines.join(known, ["edition", "clause"], "left").agg(F.count(F.lit(1)).alias("total"), F.count("known").alias("hit"))


@query()
def assemble_editions(spark, d):
    """The passes of an edition in order: nodes by type and role, with what the gates found."""
    from .assemble import assemble

    n = fx(spark, d, "fx_nodes")
    label = F.when(F.col("type") == "section", "section_header").otherwise("text")
    bundle = assemble(n.select("edition", "pre", "page", label.alias("label"), F.when(F.col("type") == "section", 1).alias("level"), "text", "lang"))
    found = bundle.outcomes.groupBy("edition", "pre").agg(F.count(F.lit(1)).alias("outcomes"))
    return (
        bundle.nodes.join(found, ["edition", "pre"], "left").groupBy("type", "cdm_type")
        .agg(F.count(F.lit(1)).alias("nodes"), F.count("parent").alias("placed"), F.coalesce(F.sum("outcomes"), F.lit(0)).alias("outcomes"))
    )


@query("SELECT page_class, round(avg(q) * 100)::BIGINT AS layout, count(*) FILTER (WHERE q IS NULL)::BIGINT AS unknown FROM (SELECT CASE WHEN qty % 2 = 0 THEN 'even' ELSE 'odd' END AS page_class, CASE WHEN disc = 3 THEN NULL ELSE round(price / 7.0, 4) END AS q FROM fx_rows) GROUP BY 1", "fx_rows")
def src8_confidence(spark, d):
    """SRC8: page confidences to four places, NaN as null."""
    score = F.when(F.col("disc") == 3, F.lit(float("nan"))).otherwise(F.col("price") / 7.0)
    pages = fx(spark, d, "fx_rows").select("edition", F.col("ord").alias("page"), "qty", *[score.alias(c) for c in ("layout", "parse", "table", "ocr")])
    got = mt.page_confidence(pages).join(pages.select("edition", "page", "qty"), ["edition", "page"])
    kind = F.when(F.col("qty") % 2 == 0, "even").otherwise("odd").alias("page_class")
    return got.groupBy(kind).agg(F.round(F.avg("layout") * 100).cast("bigint").alias("layout"), F.count_if(F.col("layout").isNull()).alias("unknown"))


@query("""SELECT edition, page, string_agg(text, ' ' ORDER BY ord) AS text, min(x0) AS x0, max(y1) AS y1, max(size)::BIGINT AS size, min_by(size % 2 = 0, ord) AS horizontal
    FROM fx_words GROUP BY edition, page""", "fx_words")
def src12_lines(spark, d):
    """SRC10, SRC12: lines from spans, with box, type size and direction."""
    flat = F.col("size") % 2 == 0
    spans = fx(spark, d, "fx_words").withColumns({"line": F.lit(1), "dx": F.when(flat, 1.0).otherwise(0.0), "dy": F.when(flat, 0.0).otherwise(-1.0)})
    return longs(mt.source_lines(spans).select("edition", "page", "text", "x0", "y1", "size", "horizontal"), "size")
