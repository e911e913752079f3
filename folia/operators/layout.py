"""Spatial operators on boxes of pages.

Overlap joins go through a grid: every box is listed in the cells that it touches, boxes meet inside a
cell, and a pair is kept only in the cell that holds the corner of its intersection, so each pair comes
out once without a distinct. A page with a third of all boxes is thereby spread over its cells; the page
alone is never the join key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.functions import boxes as B

#: Side of a grid cell in micropoints.
CELL = 60_000


def _cells(df: DataFrame, prefix: str, cell: int) -> DataFrame:
    span = lambda a, b: F.sequence(F.floor(F.col(prefix + a) / cell), F.floor((F.col(prefix + b) - 1) / cell))
    return df.withColumn("cx", F.explode(span("x0", "x1"))).withColumn("cy", F.explode(span("y0", "y1")))


def _prefixed(df: DataFrame, prefix: str, page: str) -> DataFrame:
    return df.select(F.col(page).alias("page"), *(F.col(c).alias(prefix + c) for c in df.columns if c != page))


def overlapping(left: DataFrame, right: DataFrame, *, page: str = "page_id", cell: int = CELL, where: Column | None = None) -> DataFrame:
    """Pairs of boxes of one page that share area; columns carry the prefixes ``a_`` and ``b_``."""
    a = _cells(_prefixed(left.where("x1 > x0 and y1 > y0"), "a_", page), "a_", cell)
    b = _cells(_prefixed(right.where("x1 > x0 and y1 > y0"), "b_", page), "b_", cell)
    pairs = a.join(b, ["page", "cx", "cy"]).where("a_x0 < b_x1 and b_x0 < a_x1 and a_y0 < b_y1 and b_y0 < a_y1")
    if where is not None:
        pairs = pairs.where(where)
    home = (F.floor(F.greatest("a_x0", "b_x0") / cell) == F.col("cx")) & (F.floor(F.greatest("a_y0", "b_y0") / cell) == F.col("cy"))
    return pairs.where(home).drop("cx", "cy")


def assign_lines(lines: DataFrame, regions: DataFrame, *, page: str = "page_id") -> DataFrame:
    """Every line with the region of the largest shared area (ties: smallest region id), null without one."""
    pairs = overlapping(lines, regions, page=page).withColumn("shared", B.shared_area("a_", "b_"))
    best = pairs.groupBy("page", "a_id").agg(F.min_by(F.struct(F.col("b_id").alias("region_id"), "shared"), F.struct(-F.col("shared"), F.col("b_id"))).alias("best"))
    keys = lines.select(F.col(page).alias("page"), F.col("id").alias("a_id"))
    out = keys.join(best, ["page", "a_id"], "left")
    return out.select(F.col("page").alias("page_id"), F.col("a_id").alias("line_id"), F.col("best.region_id").alias("region_id"), F.coalesce("best.shared", F.lit(0)).cast("bigint").alias("shared_area"))


def iou_pairs(regions: DataFrame, *, threshold_milli: int = 500, page: str = "page_id") -> DataFrame:
    """(page_id, left_id, right_id, iou) of boxes of one kind that overlap by at least the threshold."""
    same = (F.col("a_kind") == F.col("b_kind")) & (F.col("a_id") < F.col("b_id"))
    pairs = overlapping(regions, regions, page=page, where=same).withColumn("iou", B.iou_milli("a_", "b_"))
    return pairs.where(F.col("iou") >= threshold_milli).select(F.col("page").alias("page_id"), F.col("a_id").alias("left_id"), F.col("b_id").alias("right_id"), "iou")


def overlap_findings(regions: DataFrame, *, page: str = "page_id") -> DataFrame:
    """(page_id, id): boxes that share area with a box of a smaller id on their page."""
    # A box is listed once in each of its cells and asks there for one earlier box; no pairs are made.
    boxes = regions.where("x1 > x0 and y1 > y0").select(page, "id", "x0", "y0", "x1", "y1")
    a = _cells(_prefixed(boxes, "a_", page), "a_", CELL)
    b = _cells(_prefixed(boxes, "b_", page), "b_", CELL)
    meet = F.expr("b_id < a_id and a_x0 < b_x1 and b_x0 < a_x1 and a_y0 < b_y1 and b_y0 < a_y1")
    on = (a["page"] == b["page"]) & (a["cx"] == b["cx"]) & (a["cy"] == b["cy"]) & meet
    return a.join(b, on, "left_semi").select(F.col("page").alias("page_id"), F.col("a_id").alias("id")).distinct()


def containing_parents(children: DataFrame, parents: DataFrame, *, page: str = "page_id") -> DataFrame:
    """Per child the number of boxes that contain it, and the parent if there is exactly one."""
    inside = F.expr("b_x0 <= a_x0 and b_y0 <= a_y0 and b_x1 >= a_x1 and b_y1 >= a_y1 and b_id <> a_id")
    found = overlapping(children, parents, page=page, where=inside).groupBy("page", "a_id").agg(F.count(F.lit(1)).alias("n"), F.min("b_id").alias("one"))
    out = children.select(F.col(page).alias("page"), F.col("id").alias("a_id")).join(found, ["page", "a_id"], "left")
    n = F.coalesce("n", F.lit(0)).cast("bigint")
    return out.select(F.col("page").alias("page_id"), F.col("a_id").alias("id"), n.alias("n_candidates"), F.when(n == 1, F.col("one")).alias("parent_id"))


def reading_edges(regions: DataFrame, *, page: str = "page_id") -> DataFrame:
    """(page_id, source_id, target_id, ambiguous): neighbours in reading order (x0, y0, id) of their page."""
    w = Window.partitionBy(page).orderBy("x0", "y0", "id")
    nxt = lambda c: F.lead(c).over(w)
    e = regions.select(F.col(page).alias("page_id"), F.col("id").alias("source_id"), nxt("id").alias("target_id"), "x0", "x1", "y0", "y1", nxt("x0").alias("nx0"), nxt("y0").alias("ny0"), nxt("y1").alias("ny1"))
    ambiguous = (F.col("nx0") < F.col("x1")) & (F.col("ny0") < F.col("y1")) & (F.col("y0") < F.col("ny1"))
    return e.where("target_id is not null").select("page_id", "source_id", "target_id", ambiguous.alias("ambiguous"))


def order_accuracy(regions: DataFrame, *, page: str = "page_id", truth: tuple[str, ...] = ("x0", "y0", "id"), predicted: tuple[str, ...] = ("y0", "x0", "id")) -> DataFrame:
    """(page_id, correct_pairs, total_pairs) of all pairs of a page, counted in n log n.

    A pair is wrong if the ranks invert. At the highest bit in which two predicted ranks differ, the larger
    has a one: per bit, running counts of ones before each zero, in true order and inside the shared prefix,
    add up to all inversions.
    """
    t = F.row_number().over(Window.partitionBy(page).orderBy(*truth)) - 1
    p = F.row_number().over(Window.partitionBy(page).orderBy(*predicted)) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy(page))
    r = regions.select(F.col(page).alias("page_id"), t.alias("t"), p.alias("p"), n.alias("n"))
    sizes = r.select("page_id", "n").distinct()
    # Above the page's own size all prefixes and bits are zero: such levels hold no inversion.
    each = r.where("n > 1").select("page_id", "t", "p", F.explode(F.sequence(F.lit(0), F.length(F.bin(F.col("n") - 1)) - 1)).alias("bit"))
    each = each.select("page_id", "t", "bit", F.expr("shiftright(p, bit + 1)").alias("prefix"), F.expr("shiftright(p, bit) & 1").alias("one"))
    w = Window.partitionBy("page_id", "bit", "prefix").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inversions = each.withColumn("ones", F.sum("one").over(w)).where("one = 0").groupBy("page_id").agg(F.sum("ones").alias("wrong"))
    total = (F.col("n") * (F.col("n") - 1) / 2).cast("bigint")
    return sizes.join(inversions, "page_id", "left").select("page_id", (total - F.coalesce("wrong", F.lit(0))).cast("bigint").alias("correct_pairs"), total.alias("total_pairs"))


def union_boxes(regions: DataFrame, *by: str) -> DataFrame:
    """Enclosing box, number and mean known confidence by group."""
    return regions.groupBy(*by).agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count(F.lit(1)).alias("n_regions"), F.avg("confidence_milli").alias("mean_confidence"))


def union_area(regions: DataFrame, *, page: str = "page_id", cell: int = CELL) -> DataFrame:
    """(page_id, area): area covered by at least one box.

    Boxes are cut at the grid, so the union is the sum of the cells' unions. Inside a cell the edges of all
    boxes make strips; for every strip the covered height is a running-maximum sweep over its intervals.
    """
    c = _cells(_prefixed(regions.select(page, "x0", "y0", "x1", "y1").where("x1 > x0 and y1 > y0"), "", page), "", cell)
    c = c.select("page", "cx", "cy", F.greatest(F.col("x0"), F.col("cx") * cell).alias("x0"), F.least(F.col("x1"), (F.col("cx") + 1) * cell).alias("x1"), F.greatest(F.col("y0"), F.col("cy") * cell).alias("y0"), F.least(F.col("y1"), (F.col("cy") + 1) * cell).alias("y1")).distinct()
    edges = c.select("page", "cx", "cy", F.explode(F.array("x0", "x1")).alias("x")).distinct()
    w = Window.partitionBy("page", "cx", "cy").orderBy("x")
    strips = edges.withColumn("nx", F.lead("x").over(w)).where("nx is not null")
    inside = strips.join(c, ["page", "cx", "cy"]).where("x0 <= x and x1 >= nx")
    v = Window.partitionBy("page", "cx", "cy", "x").orderBy("y0", "y1").rowsBetween(Window.unboundedPreceding, -1)
    sweep = inside.withColumn("reach", F.coalesce(F.max("y1").over(v), F.col("y0")))
    covered = F.greatest(F.col("y1") - F.greatest("reach", "y0"), F.lit(0)) * (F.col("nx") - F.col("x"))
    return sweep.groupBy("page").agg(F.sum(covered).cast("bigint").alias("area")).select(F.col("page").alias("page_id"), "area")


def box_detection(regions: DataFrame, *, threshold: float = 0.5) -> DataFrame:
    """(kind, tp, fp, fn): reference boxes against generated boxes of one region, matched above the overlap threshold."""
    get = lambda c, i: F.col(c)[i]
    lo = lambda i: F.greatest(get("reference_box", i), get("generated_box", i))
    hi = lambda i: F.least(get("reference_box", i) + get("reference_box", i + 2), get("generated_box", i) + get("generated_box", i + 2))
    inter = F.greatest(hi(0) - lo(0), F.lit(0.0)) * F.greatest(hi(1) - lo(1), F.lit(0.0))
    size = lambda c: get(c, 2) * get(c, 3)
    both = F.col("reference_box").isNotNull() & F.col("generated_box").isNotNull()
    hit = F.coalesce(both & (inter >= threshold * (size("reference_box") + size("generated_box") - inter)), F.lit(False))
    return regions.groupBy("kind").agg(
        F.count_if(hit).alias("tp"), F.count_if(F.col("generated_box").isNotNull() & ~hit).alias("fp"), F.count_if(F.col("reference_box").isNotNull() & ~hit).alias("fn")
    )


def coverage(regions: DataFrame) -> DataFrame:
    """(page_id, source_id, n): source regions that more than one proposal of their page accounts for."""
    each = regions.select("page_id", "id", F.explode("source_region_ids").alias("source_id"))
    return each.groupBy("page_id", "source_id").agg(F.count_distinct("id").alias("n")).where("n > 1")
