"""Sinks: content-addressed store, deterministic package, page-recognition export."""

from __future__ import annotations

import hashlib
import io
import zipfile
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folia.functions.frames import frame

#: Time stamp of every package entry (fixed value).
ENTRY_TIME = (1980, 1, 1, 0, 0, 0)
#: Compression level of the entries (fixed value).
LEVEL = 9


def put_artifacts(artifacts: DataFrame, root: str) -> DataFrame:
    """Insert-if-absent into a parquet store keyed by digest; returns the rows that were new.

    Equal content is written once; the store's earlier digests are read by column, without their content.
    """
    spark: SparkSession = artifacts.sparkSession
    keyed = artifacts.withColumn("sha256", F.sha2("content", 256)).withColumn("byte_size", F.octet_length("content").cast("bigint"))
    fresh = keyed.dropDuplicates(["sha256"])
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        fresh = fresh.join(spark.read.parquet(root).select("sha256"), "sha256", "left_anti")
    fresh = fresh.select("sha256", "byte_size", "media_type", "role", "content")
    fresh.write.mode("append").parquet(root)
    return fresh.drop("content")


def verify_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """(sha256, ok): whether stored content still has its digest."""
    return spark.read.parquet(root).select("sha256", (F.sha2("content", 256) == F.col("sha256")).alias("ok"))


def pack(entries: dict[str, bytes], *, mimetype: str = "application/zip") -> bytes:
    """A package of the same bytes for the same entries: mimetype first and stored, names sorted, times fixed."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in [("mimetype", mimetype.encode()), *sorted(entries.items())]:
            info = zipfile.ZipInfo(name, ENTRY_TIME)
            info.external_attr = 0o644 << 16
            info.compress_type = zipfile.ZIP_STORED if name == "mimetype" else zipfile.ZIP_DEFLATED
            z.writestr(info, data, compresslevel=LEVEL)
    return out.getvalue()


def unpack(data: bytes) -> dict[str, bytes]:
    """The entries of a package without its mimetype."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        return {n: z.read(n) for n in z.namelist() if n != "mimetype"}


def read_packages(spark: SparkSession, root: str, pattern: str = "*.zip") -> DataFrame:
    """(path, name, content) of the entries of all package files under a folder."""

    def run(batches):
        for pdf in batches:
            yield frame([(p, n, c) for p, data in zip(pdf["path"], pdf["content"]) for n, c in unpack(bytes(data)).items()], ["path", "name", "content"])

    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return f.select("path", "content").mapInPandas(run, "path string, name string, content binary")


def save_package(path: str, data: bytes) -> bool:
    """Write a package file unless it is there; a different one under its name is an error. Returns whether it was written."""
    try:
        with open(path, "xb") as out:
            out.write(data)
        return True
    except FileExistsError:
        with open(path, "rb") as there:
            if there.read() != data:
                raise ValueError(f"{path} holds a different package") from None
        return False


def write_packages(entries: DataFrame, folder: str) -> DataFrame:
    """One package file per ``package_id`` of (package_id, name, content); returns package_id, path, sha256.

    Every package is packed by one task from its own entries, whose sum is the size of the file due.
    """
    import pandas as pd

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        data = pack({n: bytes(c) for n, c in zip(pdf["name"], pdf["content"])})
        return frame([(key[0], data, hashlib.sha256(data).hexdigest())], ["package_id", "data", "sha256"])

    packed = entries.groupBy("package_id").applyInPandas(run, "package_id string, data binary, sha256 string")
    packed.write.mode("errorifexists").parquet(folder)
    return entries.sparkSession.read.parquet(folder).select("package_id", "sha256")


def alto_document(page_id: str, lines: list[tuple[str, list[tuple]]]) -> str:
    """ALTO of one page; lines are (line_id, [(x0, y0, x1, y1, text, confidence)])."""
    out = [f'<alto xmlns="http://www.loc.gov/standards/alto/ns-v4#"><Layout><Page ID={quoteattr(page_id)}><PrintSpace><TextBlock ID="block-0">']
    for line_id, words in lines:
        out.append(f"<TextLine ID={quoteattr(line_id)}>")
        for x0, y0, x1, y1, text, confidence in words:
            wc = "" if confidence is None else f' WC="{confidence:g}"'
            out.append(f'<String HPOS="{x0:g}" VPOS="{y0:g}" WIDTH="{x1 - x0:g}" HEIGHT="{y1 - y0:g}" CONTENT={quoteattr(text)}{wc}/>')
        out.append("</TextLine>")
    return "".join([*out, "</TextBlock></PrintSpace></Page></Layout></alto>"])


def page_document(image: str, regions: list[tuple[str, list[tuple]]]) -> str:
    """PAGE of one page; regions are (region_id, [(line_id, x0, y0, x1, y1, text)])."""
    out = [f'<PcGts xmlns="http://schema.primaresearch.org/PAGE/gts/pagecontent/2019-07-15"><Page imageFilename={quoteattr(image)}>']
    for region_id, lines in regions:
        out.append(f"<TextRegion id={quoteattr(region_id)}>")
        for line_id, x0, y0, x1, y1, text in lines:
            points = f"{x0:g},{y0:g} {x1:g},{y0:g} {x1:g},{y1:g} {x0:g},{y1:g}"
            out.append(f'<TextLine id={quoteattr(line_id)}><Coords points="{points}"/><TextEquiv><Unicode>{escape(text)}</Unicode></TextEquiv></TextLine>')
        out.append("</TextRegion>")
    return "".join([*out, "</Page></PcGts>"])


#: Elements of the HTML view by kind of block (fixed values); other kinds are paragraphs.
VIEW_TAGS = {"section": "h2", "code": "pre", "list-item": "li", "function": "h3"}


def html_view(blocks: DataFrame) -> DataFrame:
    """(source_path, html) of blocks(source_path, block_no, kind, text): one escaped element for each block, in order."""
    text = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    tag = F.coalesce(F.create_map(*(F.lit(x) for pair in VIEW_TAGS.items() for x in pair))[F.col("kind")], F.lit("p"))
    one = F.concat(F.lit("<"), tag, F.lit(">"), text, F.lit("</"), tag, F.lit(">"))
    rows = F.array_sort(F.collect_list(F.struct("block_no", one.alias("e"))))
    return blocks.groupBy("source_path").agg(F.array_join(F.transform(rows, lambda x: x["e"]), "\n").alias("html"))
