"""Readers: files, lines of texts, and layout items of web pages."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.store import key


def binary_files(spark: SparkSession, path: str, glob: str = "*.pdf") -> DataFrame:
    """Files below a folder in path order."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).orderBy("path")


def listing(files: DataFrame, stored: DataFrame, pipeline: str) -> DataFrame:
    """Files (``path, content``) with their key and whether the store has it."""
    keyed = files.select("path", key(F.col("content"), pipeline).alias("key"))
    return keyed.join(stored.select("key").distinct().withColumn("_ready", F.lit(True)), "key", "left").select("path", "key", F.coalesce("_ready", F.lit(False)).alias("ready"))


def text_lines(documents: DataFrame, per_page: int = 5) -> DataFrame:
    """Lines of texts, ``per_page`` to a page."""
    lines = documents.select(F.col("doc_id").alias("edition"), "lang", "source", F.posexplode(F.split("text", "\n", -1)).alias("line_ord", "text"))
    return lines.withColumn("page", (F.floor(F.col("line_ord") / per_page) + 1).cast("int"))


ITEMS = "edition bigint, pre int, label string, level int, text string"
_LABELS = {"p": "paragraph", "li": "list_item", "blockquote": "paragraph", "td": "paragraph", "figcaption": "caption", "caption": "caption"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_FURNITURE = {"nav", "header", "footer", "aside", "form", "script", "style", "head", "title"}


def html_items(pages: DataFrame) -> DataFrame:
    """Layout items of pages (``page_id, html``): headings with levels, paragraphs, list items; menus,
    footers and other furniture are labelled as page headers, which the tree leaves out."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.items, self.text, self.kind, self.furniture = [], [], None, []

        def end(self) -> None:
            text = " ".join("".join(self.text).split())
            if text:
                label, level = self.kind or ("paragraph", None)
                self.items.append(("page_header" if self.furniture else label, level, text))
            self.text = []

        def handle_starttag(self, tag, attrs):
            names = dict(attrs).get("class") or ""
            outermost = tag in _FURNITURE or tag == "div" and "ad" in names.split()
            heading = tag[0] == "h" and tag[1:].isdigit()
            if outermost or heading or tag in _LABELS:
                self.end()
            if (self.furniture or outermost) and tag not in _VOID:
                self.furniture.append(tag)
            if heading:
                self.kind = ("section_header", int(tag[1:]))
            elif tag in _LABELS:
                self.kind = (_LABELS[tag], None)
            elif tag == "br":
                self.text.append(" ")

        def handle_endtag(self, tag):
            if tag in _LABELS or tag in _FURNITURE or tag[0] == "h" and tag[1:].isdigit() or self.furniture[:1] == [tag]:
                self.end()
                self.kind = None
            if tag in self.furniture:
                # What is still open inside an element ends with it.
                while self.furniture.pop() != tag:
                    pass

        def handle_data(self, data):
            self.text.append(data)

    def read(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            for page, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = Reader()
                reader.feed(html or "")
                reader.close()
                reader.end()
                for k, (label, level, text) in enumerate(reader.items):
                    for column, x in zip(out, (page, k, label, level, text), strict=True):
                        column.append(x)
            types = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["edition", "pre", "label", "level", "text"])

    return pages.select("page_id", "html").mapInArrow(read, ITEMS)
