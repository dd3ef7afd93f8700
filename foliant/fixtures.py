"""Views that give the driver's tables the shapes of laid-out documents.

Each view is one SQL text that Spark and DuckDB evaluate alike; names in braces are
tables or other views.  ``frame`` builds a view in Spark, ``sql_with`` the common table
expressions of an oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .session import table

VIEWS = {
    # One edition an order, one line an item; the full key makes the order unique.
    "fx_rows": """
        SELECT l_orderkey AS edition, CAST(l_quantity AS INT) AS qty, CAST(floor(l_extendedprice) AS INT) AS price,
               CAST(round(l_discount * 100) AS INT) AS disc, CAST(round(l_tax * 100) AS INT) AS tax, l_returnflag AS flag, l_partkey AS part,
               CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                    l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) AS INT) AS ord
        FROM {lineitem}""",
    "fx_nodes": """
        SELECT edition, ord AS pre, concat(CAST(edition AS STRING), '-', CAST(ord AS STRING)) AS node_id,
               CASE WHEN ord % 3 = 1 THEN 'section' ELSE 'paragraph' END AS type, 1 + ord DIV 4 AS page,
               CASE edition % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'de' ELSE 'fr' END AS lang,
               CASE WHEN qty > 45 THEN NULL WHEN ord % 7 = 6 THEN concat('A.', CAST(ord AS STRING))
                    WHEN ord % 4 = 0 THEN concat(CAST(1 + edition % 3 AS STRING), '.', CAST(ord - 1 AS STRING), '.1')
                    ELSE concat(CAST(1 + edition % 3 AS STRING), '.', CAST(ord AS STRING)) END AS number,
               CASE WHEN ord % 3 = 1 THEN
                        concat(CAST(1 + edition % 3 AS STRING), '.', CAST(ord AS STRING), CASE WHEN qty % 2 = 0 THEN ' Limits of field' ELSE ' Scope' END)
                    WHEN ord % 3 = 2 THEN
                        concat(CASE edition % 3 WHEN 0 THEN 'The field strength ' WHEN 1 THEN 'Die Spannung ' ELSE 'Le champ ' END,
                               CASE edition % 3 WHEN 0 THEN CASE flag WHEN 'A' THEN 'shall be ' WHEN 'R' THEN 'should be ' ELSE 'is ' END
                                                WHEN 1 THEN CASE flag WHEN 'A' THEN 'muss ' WHEN 'R' THEN 'sollte ' ELSE 'ist ' END
                                                ELSE CASE flag WHEN 'A' THEN 'doit ' WHEN 'R' THEN 'devrait ' ELSE 'est ' END END,
                               CASE WHEN qty % 3 = 0 THEN 'at least ' WHEN qty % 3 = 1 THEN 'at most ' ELSE '' END,
                               CAST(qty AS STRING), CASE WHEN tax % 2 = 0 THEN ' V/m' ELSE ' kHz' END)
                    ELSE concat('For details see ', CAST(1 + edition % 3 AS STRING), '.', CAST(ord + 1 AS STRING),
                                ' and Table ', CAST(qty % 4 AS STRING), CASE WHEN qty % 5 = 0 THEN ' or Annex B' ELSE '' END) END AS text
        FROM {fx_rows}""",
    # A table an edition: a header row, one row a line, three columns; cells without tax are holes.
    "fx_cells": """
        SELECT edition, 0 AS row, c.col, 1 AS rowspan, 1 AS colspan, TRUE AS header, c.text
        FROM (SELECT DISTINCT edition FROM {fx_rows}) e CROSS JOIN
             (SELECT 0 AS col, 'Quantity' AS text UNION ALL SELECT 1, 'Limit (V/m)' UNION ALL SELECT 2, 'Max in dB') c
        UNION ALL SELECT edition, ord, 0, 1, CASE WHEN qty = 13 THEN 2 ELSE 1 END, FALSE, CAST(qty AS STRING) FROM {fx_rows}
        UNION ALL SELECT edition, ord, 1, 1, 1, FALSE, CASE WHEN disc = 0 THEN '' ELSE concat('< ', CAST(price AS STRING)) END FROM {fx_rows}
        UNION ALL SELECT edition, ord, 2, 1, 1, FALSE, concat(CAST(disc AS STRING), ' dB') FROM {fx_rows} WHERE tax > 0""",
    # Lines of real texts, five a page.
    "fx_lines": """
        SELECT doc_id AS edition, 1 + pos DIV 5 AS page, pos AS line_ord, line AS text, lang, source
        FROM {exploded}""",
    # Two transcriptions of a text and sometimes a third.
    "fx_candidates": """
        SELECT doc_id AS edition, 'pymupdf' AS parser, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE lang END AS text, doc_id % 4 = 0 AS normative FROM {documents}
        UNION ALL SELECT doc_id, 'surya', CASE WHEN doc_id % 5 = 0 THEN concat(lang, '?') ELSE lang END, doc_id % 4 = 0 FROM {documents}
        UNION ALL SELECT doc_id, 'rapidocr', CASE WHEN doc_id % 3 = 0 THEN concat(lang, '!') ELSE concat(' ', lang, '  ') END, doc_id % 4 = 0
        FROM {documents} WHERE doc_id % 2 = 0""",
    # Layout items with labels and heading levels; words with positions.
    "fx_items": """
        SELECT edition, ord AS pre, 1 + ord DIV 4 AS page,
               CASE WHEN ord % 3 = 1 THEN 'section_header' WHEN qty > 44 THEN 'table' WHEN qty > 38 THEN 'caption' WHEN qty < 4 THEN 'page_header'
                    WHEN qty < 8 THEN 'picture' ELSE 'text' END AS label,
               CASE WHEN ord % 3 = 1 THEN 1 + qty % 3 END AS level,
               CASE WHEN ord % 3 = 1 AND qty % 9 = 0 THEN concat('Table ', CAST(qty AS STRING)) WHEN ord % 3 = 1 AND qty % 9 = 1 THEN 'Legend:'
                    ELSE concat('item ', CAST(qty AS STRING)) END AS text
        FROM {fx_rows}""",
    "fx_equations": """
        SELECT edition, ord AS pre, concat(CASE WHEN qty % 5 = 0 THEN '$' ELSE '' END, 'N_{\\text{d}} = \\left( ', CAST(qty AS STRING), ' \\, x + ',
               CASE WHEN qty % 4 = 0 THEN 'y' ELSE 'z' END, CASE WHEN qty % 7 = 0 THEN '' ELSE ' \\right)' END, CASE WHEN qty % 6 = 0 THEN ' \\tag{2}' ELSE '' END,
               CASE WHEN qty % 5 = 0 THEN '$' ELSE '' END) AS latex
        FROM {fx_rows} WHERE flag = 'A'""",
    "fx_words": """
        SELECT edition, 1 AS page, ord, CAST(qty AS DOUBLE) AS x0, CAST(qty + 2 AS DOUBLE) AS x1, CAST(disc * 4 AS DOUBLE) AS y0,
               CAST(disc * 4 + 3 AS DOUBLE) AS y1, CAST(qty AS STRING) AS text, 8 + tax AS size
        FROM {fx_rows}""",
}


_NAMES = r"\{(fx_[a-z]+|exploded|lineitem|documents)\}"


def needs(name: str) -> list[str]:
    return list(dict.fromkeys(re.findall(_NAMES, VIEWS[name])))


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view (or table) as a DataFrame."""
    if name == "exploded":
        return table(spark, sf_dir, "documents").selectExpr("doc_id", "lang", "source", "posexplode(split(text, '\\n', -1)) AS (pos, line)")
    if name not in VIEWS:
        return table(spark, sf_dir, name)
    # In Spark string literals a backslash is written twice.
    text = VIEWS[name].replace("\\", "\\\\")
    for view in needs(name):
        text = text.replace("{%s}" % view, f"{view}__")
        frame(spark, sf_dir, view).createOrReplaceTempView(f"{view}__")
    return spark.sql(text)


def sql_with(*names: str) -> str:
    """``WITH`` clause that defines the views (and what they need) for DuckDB."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name == "exploded" or name in VIEWS:
            for n in needs(name) if name in VIEWS else []:
                visit(n)
            if name not in order:
                order.append(name)

    for name in names:
        visit(name)
    parts = []
    for name in order:
        if name == "exploded":
            body = "SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line, CAST(unnest(range(len(string_split(text, chr(10))))) AS INT) AS pos FROM documents"
        else:
            body = re.sub(r"(\S+) DIV (\d+)", r"\1 // \2", re.sub(_NAMES, r"\1", VIEWS[name])).replace("STRING", "VARCHAR")
        parts.append(f"{name} AS ({body})")
    return "WITH " + ",\n".join(parts) + "\n"
