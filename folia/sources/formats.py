"""Page-recognition formats as DataFrames of words, lines and regions.

Text formats are parsed per file in Arrow batches; a file is one page or one document of pages. Fields that a
file leaves out are null, unreadable files give no rows.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.functions.frames import frame

WORD_SCHEMA = "path string, page_id string, region_id string, line_id string, word_no int, x0 double, y0 double, x1 double, y1 double, text string, confidence double"


def files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, content): files under a folder by name pattern, sorted listings are left to the reader."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "content")


def discovered(spark: SparkSession, root: str, pattern: str = "*.[pP][dD][fF]") -> DataFrame:
    """(path, sha256, byte_size, stable): files under a folder with their paths below it.

    ``stable`` is false if a file's content is not as long as its listing said, which a change in between shows.
    """
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    below = F.regexp_replace("path", "^" + re.escape("file:" + root.removeprefix("file://").rstrip("/")).replace("/", "/+") + "/+", "")
    return f.select(below.alias("path"), F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("bigint").alias("byte_size"), (F.octet_length("content") == F.col("length")).alias("stable"))


def fingerprints(spark: SparkSession, root: str, pattern: str = "*.[pP][dD][fF]") -> DataFrame:
    """(sha256, byte_size, aliases, first_path, paths): sources by content with their paths in order."""
    f = discovered(spark, root, pattern)
    return f.groupBy("sha256").agg(F.max("byte_size").alias("byte_size"), F.count(F.lit(1)).alias("aliases"), F.min("path").alias("first_path"), F.array_sort(F.collect_list("path")).alias("paths"))


def verify_fingerprints(current: DataFrame, recorded: DataFrame) -> DataFrame:
    """(path, status): ``same``, ``changed``, ``missing`` or ``new`` of files against recorded digests."""
    j = current.select("path", "sha256").join(recorded.select("path", F.col("sha256").alias("was")), "path", "full")
    return j.select("path", F.when(F.col("was").isNull(), "new").when(F.col("sha256").isNull(), "missing").when(F.col("sha256") == F.col("was"), "same").otherwise("changed").alias("status"))


def read_tsv_words(spark: SparkSession, path: str) -> DataFrame:
    """Word rows (level 5, not blank) of recognition TSV; a negative confidence is unknown, others are hundredths."""
    schema = "level int, page_num int, block_num int, par_num int, line_num int, word_num int, left int, top int, width int, height int, conf double, text string"
    t = spark.read.schema(schema).option("sep", "\t").option("header", "true").option("quote", "").csv(path).withColumn("path", F.input_file_name())
    return t.where("level = 5 and trim(text) <> ''").withColumn("confidence", F.when(F.col("conf") >= 0, F.col("conf") / 100))


def in_micropoints(words: DataFrame, dpi: int) -> DataFrame:
    """TSV words with their boxes in millionths of a point instead of pixels, rounded half to even."""
    scale = lambda c: F.bround(c * F.lit(72_000_000) / F.lit(dpi)).cast("bigint")
    left, top = F.col("left"), F.col("top")
    return words.withColumns({"left": scale(left), "top": scale(top), "width": scale(left + F.col("width")) - scale(left), "height": scale(top + F.col("height")) - scale(top)})


def lines_of_words(words: DataFrame) -> DataFrame:
    """(path, page_id, region_id, line_id, text, x0, y0, x1, y1, confidence): lines of :func:`read_words`.

    The text is the words in order; the box encloses those of the words that have one.
    """
    g = words.groupBy("path", "page_id", "region_id", "line_id").agg(
        F.array_sort(F.collect_list(F.struct("word_no", "text"))).alias("w"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.avg("confidence").alias("confidence")
    )
    return g.select("path", "page_id", "region_id", "line_id", F.array_join(F.transform("w", lambda x: x["text"]), " ").alias("text"), "x0", "y0", "x1", "y1", "confidence")


def words_to_lines(words: DataFrame) -> DataFrame:
    """Lines of TSV words: text joined by blanks in word order, enclosing box, mean known confidence."""
    by = ["path", "page_num", "block_num", "par_num", "line_num"]
    g = words.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("word_num", "text"))).alias("w"),
        F.min("left").alias("x0"), F.min("top").alias("y0"), F.max(F.col("left") + F.col("width")).alias("x1"), F.max(F.col("top") + F.col("height")).alias("y1"), F.avg("confidence").alias("confidence"),
    )
    return g.select(*by, F.array_join(F.col("w.text"), " ").alias("text"), "x0", "y0", "x1", "y1", "confidence")


_DECLARATION = re.compile(rb"<!\s*(?:DOCTYPE|ENTITY)", re.I)


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _number(value: str | None) -> float | None:
    try:
        return None if value is None else float(value)
    except ValueError:
        return None


def _safe_root(data: bytes) -> ET.Element | None:
    if _DECLARATION.search(data):
        return None  # document type declarations are refused wherever they stand
    try:
        return ET.fromstring(data)
    except ET.ParseError:
        return None


def alto_words(data: bytes) -> list[tuple]:
    """Rows of an ALTO file: page, block, line, number, box, text, confidence."""
    root = _safe_root(data)
    rows: list[tuple] = []
    for page in (x for x in root.iter() if _local(x.tag) == "Page") if root is not None else ():
        for block in (x for x in page.iter() if _local(x.tag) == "TextBlock"):
            for n_line, line in enumerate(x for x in block.iter() if _local(x.tag) == "TextLine"):
                for n, w in enumerate(x for x in line if _local(x.tag) == "String"):
                    x0, y0, width, height = (_number(w.get(k)) for k in ("HPOS", "VPOS", "WIDTH", "HEIGHT"))
                    known = None not in (x0, y0, width, height)
                    rows.append((page.get("ID"), block.get("ID"), line.get("ID") or f"line-{n_line}", n, x0, y0, x0 + width if known else None, y0 + height if known else None, w.get("CONTENT"), _number(w.get("WC"))))
    return rows


def page_words(data: bytes) -> list[tuple]:
    """Rows of a PAGE file; boxes are the bounds of ``Coords`` points, null outside of the page; a line with a text is one row, else its words are."""
    root = _safe_root(data)
    rows: list[tuple] = []

    def bounds(e: ET.Element) -> tuple:
        coords = next((x for x in e if _local(x.tag) == "Coords"), None)
        points = [p.split(",") for p in (coords.get("points", "") if coords is not None else "").split()]
        xs, ys = [float(p[0]) for p in points if len(p) == 2], [float(p[1]) for p in points if len(p) == 2]
        return (min(xs), min(ys), max(xs), max(ys)) if xs else (None,) * 4

    def text(e: ET.Element) -> tuple[str | None, float | None]:
        eq = next((x for x in e if _local(x.tag) == "TextEquiv"), None)
        if eq is None:
            return None, None
        u = next((x for x in eq if _local(x.tag) == "Unicode"), None)
        return (u.text or "") if u is not None else None, _number(eq.get("conf"))

    for page in (x for x in root.iter() if _local(x.tag) == "Page") if root is not None else ():
        for region in (x for x in page.iter() if _local(x.tag) == "TextRegion"):
            for n_line, line in enumerate(x for x in region if _local(x.tag) == "TextLine"):
                # A line's own text holds; its words stand in where it has none.
                words = [] if text(line)[0] is not None else [x for x in line if _local(x.tag) == "Word"]
                for n, w in enumerate(words or [line]):
                    box = bounds(w)
                    size = [_number(page.get(k)) for k in ("imageWidth", "imageHeight")]
                    inside = None in box or None in size or box[0] >= 0 and box[1] >= 0 and box[2] <= size[0] and box[3] <= size[1]
                    rows.append((page.get("imageFilename"), region.get("id"), line.get("id") or f"line-{n_line}", n, *(box if inside else (None,) * 4), *text(w)))
    return rows


class _Shown(HTMLParser):
    """The text of a fragment; breaks and ends of blocks are line ends."""

    BLOCKS = frozenset(("div", "li", "p", "pre"))

    def __init__(self) -> None:
        super().__init__()
        self.out: list[str] = []

    def handle_data(self, data: str) -> None:
        self.out.append(data)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.out += ["\n"] * (tag == "br")

    def handle_endtag(self, tag: str) -> None:
        self.out += ["\n"] * (tag in self.BLOCKS)


def html_text(fragment: str) -> str:
    """Text of an HTML fragment with all entities resolved."""
    p = _Shown()
    p.feed(fragment)
    p.close()
    return "".join(p.out)


def json_lines(data: bytes) -> list[tuple]:
    """Lines of engine JSON: blocks with html and bbox, or parallel lists of texts and polygons."""
    try:
        value = json.loads(data)
    except ValueError:
        return []
    pages = value if isinstance(value, list) else [value]
    rows: list[tuple] = []
    for n, page in enumerate(p for p in pages if isinstance(p, dict)):
        body = page.get("res", page)
        order = lambda kb: (kb[1].get("reading_order") is None, kb[1].get("reading_order") or 0, kb[0])
        for k, b in sorted(enumerate(body.get("blocks") or []), key=order):
            box = [float(x) for x in (b.get("bbox") or [])] or [None] * 4
            rows.append((str(page.get("page", n)), f"block-{k}", "line-0", k, *box[:4], html_text(b["html"]) if b.get("html") else b.get("text"), _number(b.get("confidence"))))
        for k, (t, poly) in enumerate(zip(body.get("rec_texts") or [], body.get("dt_polys") or [])):
            xs, ys = [float(p[0]) for p in poly], [float(p[1]) for p in poly]
            rows.append((str(page.get("page", n)), None, f"line-{k}", k, min(xs), min(ys), max(xs), max(ys), t, None))
    return rows


def bbox_words(data: bytes) -> list[tuple]:
    """Words of bounding-box XHTML: pages of ``word`` elements with xMin, yMin, xMax, yMax."""
    root = _safe_root(data)
    rows: list[tuple] = []
    for n, page in enumerate(x for x in root.iter() if _local(x.tag) == "page") if root is not None else ():
        for k, w in enumerate(x for x in page.iter() if _local(x.tag) == "word"):
            rows.append((str(n), None, None, k, *(_number(w.get(a)) for a in ("xMin", "yMin", "xMax", "yMax")), w.text, None))
    return rows


PARSERS = {"alto": alto_words, "page": page_words, "json": json_lines, "bbox": bbox_words}


def read_words(spark: SparkSession, root: str, pattern: str, kind: str) -> DataFrame:
    """Words (or lines) of all files of one format under a folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parse = PARSERS[kind]
        names = [x.split()[0] for x in WORD_SCHEMA.split(", ")]
        for pdf in batches:
            rows = [(path, *r) for path, data in zip(pdf["path"], pdf["content"]) for r in parse(bytes(data))]
            yield frame(rows, names)

    return files(spark, root, pattern).mapInPandas(run, WORD_SCHEMA)


def form_feed_pages(text: Column) -> Column:
    """Array of (pos, text) of the pages of a text export."""
    return F.transform(F.split(text, "\f"), lambda t, i: F.struct(i.alias("pos"), t.alias("text")))
