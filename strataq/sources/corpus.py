"""Readers: JSON corpora with explicit schemas, HTML, XML, ZIP and file inventories; a deterministic corpus generator.

Files are read by Spark's own sources wherever there is one; only formats
without one are parsed in Python, file by file, with bad files reported as rows
instead of failing the job.
"""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NORM = "jurisdiction string, slug string, title string, shortTitle string, abbr string, type string, status string, subjects array<string>, keywords array<string>, primarySubject string, initialCitation string, summary string, documentDate date, publicationDate date, effectiveDate date, expiryDate date"
VERSION = "versionId string, simulationValidFrom date, simulationValidTo date, sourceValidFrom date, sourceValidTo date, title string, shortTitle string, abbr string, summary string, citation string, changeNote string, body variant"
HISTORY = "initialVersionId string, entries array<struct<date:date,type:string,title:string,citation:string,note:string,affectingVersionId:string>>"


def _exists(spark: SparkSession, pattern: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def read_json_files(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """One row per JSON file under an explicit schema, with ``path`` and ``corrupt`` (the text of a file that is none). No file at all gives an empty table of that schema."""
    full = f"{schema}, corrupt string"
    if not _exists(spark, pattern):
        return spark.createDataFrame([], full + ", path string")
    rows = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt").json(pattern)
    return rows.withColumn("path", F.col("_metadata.file_path"))


def read_norms(spark: SparkSession, root: str) -> DataFrame:
    """Norm records below root/<jurisdiction>/<slug>/meta.json with ``id`` and ``name_agrees``: whether the record names the folder it lies in."""
    m = read_json_files(spark, f"{root}/*/*/meta.json", NORM)
    parts = F.split("path", "/")
    return m.withColumn("id", F.concat_ws(":", "jurisdiction", "slug")).withColumn("name_agrees", (F.element_at(parts, -3) == F.col("jurisdiction")) & (F.element_at(parts, -2) == F.col("slug")))


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """Versions below root/<jurisdiction>/<slug>/versions/<version>.json with norm_id taken from the folder."""
    v = read_json_files(spark, f"{root}/*/*/versions/*.json", VERSION)
    parts = F.split("path", "/")
    return v.withColumn("norm_id", F.concat_ws(":", F.element_at(parts, -4), F.element_at(parts, -3)))


def has_columns(df: DataFrame, needed: dict[str, str]) -> list[str]:
    """What a foreign table lacks: columns that are missing or of another type, as a list of complaints."""
    have = dict(df.dtypes)
    return [f"{c}: {have.get(c, 'missing')} instead of {t}" for c, t in needed.items() if have.get(c) != t]


# --- HTML -------------------------------------------------------------------

_SKIP, _BLOCK = {"script", "style", "nav", "noscript", "template", "head"}, {"p", "div", "li", "td", "th", "tr", "h1", "h2", "h3", "h4", "h5", "h6", "br", "section", "article", "table", "ul", "ol"}


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.blocks, self.links, self.skip, self.kind, self.buffer, self.in_title = "", [], [], [], "p", [], False

    def _flush(self) -> None:
        text = re.sub(r"\s+", " ", "".join(self.buffer)).strip()
        if text:
            self.blocks.append((self.kind, text))
        self.buffer = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "title":
            self.in_title = True
        if tag in _SKIP:
            self.skip.append(tag)
        if self.skip:
            return
        if tag in _BLOCK:
            self._flush()
            self.kind = tag
        if tag == "a" and dict(attrs).get("href"):
            self.links.append(dict(attrs)["href"])

    def handle_endtag(self, tag: str) -> None:
        if tag == "title":
            self.in_title = False
        if tag in self.skip:
            while self.skip and self.skip.pop() != tag:
                pass
        elif tag in _BLOCK and not self.skip:
            self._flush()
            self.kind = "p"

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title += data
        elif not self.skip:
            self.buffer.append(data)


_PAGE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("blocks", T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("text", T.StringType())]))),
    T.StructField("links", T.ArrayType(T.StringType())),
])


def parse_html(text: str) -> tuple[str, list[tuple[str, str]], list[str]]:
    """Title, text blocks with their element, and links; scripts, styles, navigation and comments are left out."""
    p = _Page()
    p.feed(text)
    p.close()
    p._flush()
    return re.sub(r"\s+", " ", p.title).strip(), p.blocks, p.links


def html_page(c: Column) -> Column:
    """struct<title, blocks, links> of an HTML column; null gives null."""

    @F.pandas_udf(_PAGE)
    def of(s: pd.Series) -> pd.DataFrame:
        pages = [(None, None, None) if x is None else parse_html(x) for x in s]
        return pd.DataFrame(pages, columns=["title", "blocks", "links"], dtype=object)

    return of(c)


# --- XML, ZIP, inventories --------------------------------------------------


def read_xml_rows(spark: SparkSession, pattern: str, row: str, schema: str) -> DataFrame:
    """Elements ``row`` of XML files under an explicit schema, by Spark's XML source; broken elements fail the read."""
    return spark.read.format("xml").option("rowTag", row).option("mode", "FAILFAST").schema(schema).load(pattern)


class _NoDoctype(ElementTree.TreeBuilder):
    """Builds a tree and refuses document types wherever they are declared, so no entity is ever expanded."""

    def doctype(self, name: str, pubid: str | None, system: str | None) -> None:
        raise ValueError("document type declared")


def _tree(content: bytes) -> ElementTree.Element:
    parser = ElementTree.XMLParser(target=_NoDoctype())
    parser.feed(content)
    return parser.close()


def xml_nodes(files: DataFrame) -> DataFrame:
    """path, node (position in document order), parent, tag, text, error of files(path, content): one row per element; a file that is not well-formed, or declares a document type, gives one row with ``error``."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"]):
                try:
                    root = _tree(bytes(content))
                except (ElementTree.ParseError, ValueError) as x:
                    rows.append((path, None, None, None, None, str(x)))
                    continue
                stack, n = [(root, None)], 0
                while stack:
                    e, parent = stack.pop()
                    rows.append((path, n, parent, e.tag, (e.text or "").strip(), None))
                    stack.extend((c, n) for c in reversed(list(e)))
                    n += 1
            yield pd.DataFrame(rows, columns=["path", "node", "parent", "tag", "text", "error"]).astype({"node": "Int32", "parent": "Int32"})

    return files.select("path", "content").mapInPandas(of, "path string, node int, parent int, tag string, text string, error string")


def zip_entries(files: DataFrame, piece_bytes: int = 16_000_000) -> DataFrame:
    """path, entry, piece, pieces, content, error of ZIP files(path, content): entries as pieces of at most ``piece_bytes``, read one at a time, an empty entry as one empty piece; directories are left out, a broken file gives ``error``."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cols = ["path", "entry", "piece", "pieces", "content", "error"]
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(bytes(content))) as z:
                        for i in z.infolist():
                            if i.is_dir():
                                continue
                            pieces = max(1, -(-i.file_size // piece_bytes))
                            with z.open(i) as f:
                                for k in range(pieces):
                                    yield pd.DataFrame([(path, i.filename, k, pieces, f.read(piece_bytes), None)], columns=cols)
                except (zipfile.BadZipFile, zlib.error, RuntimeError, NotImplementedError) as x:
                    yield pd.DataFrame([(path, None, None, None, None, str(x))], columns=cols).astype({"piece": "Int32", "pieces": "Int32"})

    return files.select("path", "content").mapInPandas(of, "path string, entry string, piece int, pieces int, content binary, error string")


def inventory(spark: SparkSession, pattern: str) -> DataFrame:
    """path, length, sha256, media_type, object_key (addressed by content) of every file."""
    name = F.lower(F.substring_index("path", "/", -1))
    kind = F.when(name.endswith(".pdf"), "application/pdf").when(name.endswith(".html"), "text/html").when(name.endswith(".xml"), "application/xml").when(name.endswith(".json"), "application/json").when(name.endswith(".zip"), "application/zip").otherwise("application/octet-stream")
    files = spark.read.format("binaryFile").load(pattern)
    h = F.sha2("content", 256)
    return files.select("path", "length", h.alias("sha256"), kind.alias("media_type"), F.concat_ws("/", F.lit("objects"), F.left(h, F.lit(2)), h).alias("object_key"))


# --- generated corpora ------------------------------------------------------


def scale_corpus(spark: SparkSession, n: int) -> DataFrame:
    """norm_id, version_id, valid_from, valid_to, type, text of n generated norms; every tenth has a second version. Rows depend on their number only, so any partitioning gives the same corpus."""
    word = lambda k: F.concat(F.lit("w"), F.pmod(F.xxhash64(F.col("id"), F.col("v"), k), F.lit(5000)).cast("string"))
    rows = spark.range(n).withColumn("v", F.explode(F.when(F.col("id") % 10 == 9, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    start = F.when(F.col("v") == 0, "2023-12-01").otherwise("2025-07-01").cast("date")
    end = F.when((F.col("id") % 10 == 9) & (F.col("v") == 0), F.lit("2025-06-30").cast("date"))
    kind = F.element_at(F.array(*map(F.lit, ("gesetz", "verordnung", "satzung", "richtlinie"))), (F.col("id") % 4 + 1).cast("int"))
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(40)), word), " ")
    return rows.select(F.concat(F.lit("west:norm-"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("norm_id"), start.cast("string").alias("version_id"), start.alias("valid_from"), end.alias("valid_to"), kind.alias("type"), text.alias("text"))


def mutate_corpus(corpus: DataFrame, changed: int = 7, removed: int = 11) -> DataFrame:
    """The corpus with every ``changed``-th norm's text altered and every ``removed``-th norm gone, by a hash of its id."""
    h = F.pmod(F.xxhash64("norm_id"), F.lit(changed * removed))
    return corpus.where(h % removed != 0).withColumn("text", F.when(h % changed == 0, F.concat("text", F.lit(" neu"))).otherwise(F.col("text")))
