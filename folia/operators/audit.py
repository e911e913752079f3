"""Audits and single decisions: evidence choice, code fidelity, paint order, partitions, inferences, transforms.

Defined results: null values match nothing; pages without any evidence are reported; empty tables give empty
results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def evidence_choice(pages: DataFrame, evidence: DataFrame) -> DataFrame:
    """(page_id, source, n, finding): born-digital pages take the objects of the document, others the recognised layout.

    ``pages`` holds page_id and born_digital, ``evidence`` page_id and source (``pdf-object`` or ``ocr-layout``).
    The other source stands in where the preferred one has nothing.
    """
    n = evidence.groupBy("page_id").agg(F.count_if(F.col("source") == "pdf-object").alias("pdf"), F.count_if(F.col("source") == "ocr-layout").alias("ocr"))
    each = pages.join(n, "page_id", "left").select("page_id", "born_digital", F.coalesce("pdf", F.lit(0)).alias("pdf"), F.coalesce("ocr", F.lit(0)).alias("ocr"))
    mine, other = (F.when(F.col("born_digital"), F.col(a)).otherwise(F.col(b)) for a, b in (("pdf", "ocr"), ("ocr", "pdf")))
    name = lambda first: F.when(F.col("born_digital") == first, "pdf-object").otherwise("ocr-layout")
    finding = F.when(mine > 0, None).when(other > 0, "preferred-layout-evidence-unavailable").otherwise("layout-evidence-missing")
    return each.select("page_id", F.when((mine > 0) | (other == 0), name(True)).otherwise(name(False)).alias("source"), F.when(mine > 0, mine).otherwise(other).alias("n"), finding.alias("finding"))


def code_fidelity(regions: DataFrame, by: str, left: str, right: str) -> DataFrame:
    """(by, faithful, n): whether all code regions of a group have equal texts."""
    same = F.coalesce(F.col(left) == F.col(right), F.lit(False))
    return regions.groupBy(by).agg(F.bool_and(same).alias("faithful"), F.count(F.lit(1)).alias("n"))


def paint_order(objects: DataFrame) -> DataFrame:
    """(page_id, id, position) by z_index, then place in the reading order (behind all of it without one), then id."""
    w = Window.partitionBy("page_id")
    behind = F.coalesce("reading_index", F.count("reading_index").over(w))
    return objects.withColumn("r", behind).select("page_id", "id", (F.row_number().over(w.orderBy("z_index", "r", "id")) - 1).alias("position"))


def partition_states(parts: DataFrame, words: DataFrame, by: str, word: str) -> DataFrame:
    """(by, missing, repeated, unknown): words of a group that no part has, that several have, and that are not its own."""
    n = parts.groupBy(by, word).agg(F.count(F.lit(1)).alias("n"))
    own = words.select(by, word).distinct().withColumn("_own", F.lit(True))
    both = own.join(n, [by, word], "full")
    return both.groupBy(by).agg(F.count_if(F.col("n").isNull()).alias("missing"), F.count_if((F.col("n") > 1) & F.col("_own").isNotNull()).alias("repeated"), F.count_if(F.col("_own").isNull()).alias("unknown"))


def affine(boxes: DataFrame, a: Column, b: Column, c: Column, d: Column, e: Column, f: Column) -> DataFrame:
    """Boxes under (x, y) -> (a x + c y + e, b x + d y + f) as their bounds, with the determinant; integers stay exact."""
    x = [a * F.col(p) + c * F.col(q) + e for p in ("x0", "x1") for q in ("y0", "y1")]
    y = [b * F.col(p) + d * F.col(q) + f for p in ("x0", "x1") for q in ("y0", "y1")]
    whole = lambda v: v.cast("bigint")
    return boxes.select("page_id", "id", whole(F.least(*x)).alias("x0"), whole(F.least(*y)).alias("y0"), whole(F.greatest(*x)).alias("x1"), whole(F.greatest(*y)).alias("y1"), whole(a * d - b * c).alias("determinant"))


def differing_digests(rows: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, digests): keys under which more than one digest is recorded."""
    return rows.where(F.col(key).isNotNull() & F.col(digest).isNotNull()).groupBy(key).agg(F.count_distinct(digest).alias("digests")).where("digests > 1")


def with_severe(sample: DataFrame, severe: DataFrame, *keys: str) -> DataFrame:
    """Pages of a sample and all severe pages, each once, with the reason."""
    both = sample.select(*keys, F.lit(1).alias("s")).unionByName(severe.select(*keys, F.lit(2).alias("s")))
    return both.groupBy(*keys).agg(F.max("s").alias("s")).select(*keys, F.when(F.col("s") == 2, "severe").otherwise("sample").alias("reason"))
