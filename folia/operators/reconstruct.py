"""Layout reconstruction: physical kinds, parents, columns, the reading graph, coverage and their findings.

A page's proposals never meet outside their page, and boxes meet through the grid of :mod:`layout`, so
a page with many boxes is spread over its cells. Windows run over one page.

Defined results: null boxes have no area and meet nothing; empty tables give empty results; extra columns
are ignored; ties are broken by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.operators.layout import overlapping

# Names and kinds whose results must equal the engine that is reproduced.
ALIASES = {"cell": "table-cell", "code-block": "code", "formula": "equation", "image": "figure", "line": "text", "text-block": "text"}
DIRECT = ("callout", "caption", "code", "column", "equation", "figure", "footer", "header", "list", "list-item", "marginalia", "page-number", "paragraph", "table", "table-cell", "text", "title", "toc")
PARENT_KIND = {"caption": "figure", "list-item": "list", "table-cell": "table"}
RUNNING = ("header", "footer", "page-number")
NO_COLUMN = ("caption", "footer", "header", "marginalia", "page-number", "table-cell", "list-item", "intentional-exclusion")


def physical_kinds(regions: DataFrame) -> DataFrame:
    """(page_id, id, physical_kind, confidence, review): by alias and kind, else by the place on the page.

    ``regions`` holds page_id, id, kind, text, confidence_milli, a box and the page's box (px0, py0, px1, py1).
    """
    name = F.replace(F.lower("kind"), F.lit("_"), F.lit("-"))
    for alias, kind in ALIASES.items():
        name = F.when(name == alias, kind).otherwise(name)
    height, width = F.col("py1") - F.col("py0"), F.col("px1") - F.col("px0")
    placed = name.isin("unknown", "region")
    top = placed & (F.col("y0") <= F.col("py0") + F.floor(height * 7 / 100))
    bottom = placed & (F.col("y1") >= F.col("py1") - F.floor(height * 7 / 100))
    side = placed & ((F.col("x0") <= F.col("px0") + F.floor(width / 10)) | (F.col("x1") >= F.col("px1") - F.floor(width / 10))) & (F.col("x1") - F.col("x0") <= F.floor(width / 5))
    digits = F.coalesce(F.trim("text").rlike(r"^\p{Nd}+$"), F.lit(False))
    rules = [(name.isin(*DIRECT), name, 1000), (top, F.lit("header"), 700), (bottom & digits, F.lit("page-number"), 750), (bottom, F.lit("footer"), 700), (side, F.lit("marginalia"), 650)]
    kind, cap = F.lit("content-region"), F.lit(500)
    for test, value, limit in reversed(rules):
        test = F.coalesce(test, F.lit(False))
        kind, cap = F.when(test, value).otherwise(kind), F.when(test, limit).otherwise(cap)
    return regions.select("page_id", "id", kind.alias("physical_kind"), F.least(cap, F.coalesce("confidence_milli", F.lit(0))).alias("confidence"), (~F.coalesce(name.isin(*DIRECT), F.lit(False))).alias("review"))


def nested_parents(proposals: DataFrame, explicit: str = "parent_id") -> DataFrame:
    """(page_id, id, kind, parent_id, finding) of captions, items and cells.

    The parent is the one named if it is of the right kind, else the only container of that kind around the
    box; otherwise it is null and the finding says which association needs review.
    """
    want = F.create_map(*(F.lit(x) for pair in PARENT_KIND.items() for x in pair))
    children = proposals.where(F.col("kind").isin(*PARENT_KIND)).withColumn("want", want[F.col("kind")])
    named = proposals.select(F.col("page_id"), F.col("id").alias("named"), F.col("kind").alias("want"))
    known = children.select("page_id", "id", "want", F.col(explicit).alias("named")).join(named, ["page_id", "named", "want"], "left_semi").select("page_id", "id", "named")
    boxes = lambda df, kind: df.select("page_id", "id", F.col(kind).alias("kind"), "x0", "y0", "x1", "y1")
    inside = F.expr("a_kind = b_kind and b_x0 <= a_x0 and b_y0 <= a_y0 and b_x1 >= a_x1 and b_y1 >= a_y1")
    found = overlapping(boxes(children, "want"), boxes(proposals.where(F.col("kind").isin(*PARENT_KIND.values())), "kind"), where=inside)
    found = found.groupBy(F.col("page").alias("page_id"), F.col("a_id").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("b_id").alias("one"))
    out = children.select("page_id", "id", "kind").join(known, ["page_id", "id"], "left").join(found, ["page_id", "id"], "left")
    parent = F.coalesce("named", F.when(F.col("n") == 1, F.col("one")))
    return out.select("page_id", "id", "kind", parent.alias("parent_id"), F.when(parent.isNull(), F.concat(F.lit("ambiguous-"), "kind", F.lit("-parent"))).alias("finding"))


def column_proposals(proposals: DataFrame, *, width: int) -> DataFrame:
    """(page_id, column_index, x0, y0, x1, y1, n): two columns of pages whose narrow boxes stand left and right of the middle.

    Both sides need two boxes and a shared range of heights; ``width`` is that of the page, which starts at 0.
    """
    narrow = proposals.where(~F.col("kind").isin(*NO_COLUMN) & (F.col("x1") - F.col("x0") < width * 45 // 100))
    middle = F.floor((F.col("x0") + F.col("x1")) / 2)
    side = F.when(middle < width // 2, 1).when(middle > width // 2, 2)
    each = narrow.withColumn("column_index", side).where("column_index is not null").groupBy("page_id", "column_index").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.count(F.lit(1)).alias("n"))
    page = Window.partitionBy("page_id")
    each = each.withColumns({"sides": F.count(F.lit(1)).over(page), "least": F.min("n").over(page), "top": F.max("y0").over(page), "bottom": F.min("y1").over(page)})
    return each.where("sides = 2 and least >= 2 and top < bottom").select("page_id", "column_index", "x0", "y0", "x1", "y1", "n")


def reading_graph(proposals: DataFrame) -> DataFrame:
    """(page_id, source_id, target_id, relation, confidence): containment, cells, captions and the reading sequence.

    ``proposals`` holds page_id, id, kind, parent_id, treatment, supplied_order and a box. Leaves follow the
    supplied order if all of a page have one and no two share it, else (x of the column or box, y, x, id).
    Neighbours side by side without columns are ``adjacent``, for review.
    """
    parent = proposals.select("page_id", F.col("id").alias("parent_id"), F.col("kind").alias("p_kind"), F.col("x0").alias("p_x0"))
    all_ = proposals.join(parent, ["page_id", "parent_id"], "left")
    held = all_.where("p_kind is not null")
    edge = lambda df, a, b, name, c: df.select("page_id", F.col(a).alias("source_id"), F.col(b).alias("target_id"), F.lit(name).alias("relation"), F.lit(c).alias("confidence"))
    edges = [edge(held, "parent_id", "id", "contains", 1000), edge(held.where("kind = 'table-cell'"), "parent_id", "id", "table-cell", 1000), edge(held.where("kind = 'caption'"), "id", "parent_id", "caption-for", 900)]
    leaves = all_.where(F.col("treatment").isNotNull() & ~F.col("kind").isin(*RUNNING))
    # The page's orders are distinct if no neighbour in order has the same one, which avoids a set of them all.
    ranked = leaves.withColumn("again", (F.col("supplied_order") == F.lag("supplied_order").over(Window.partitionBy("page_id").orderBy("supplied_order", "id"))).cast("int"))
    page = Window.partitionBy("page_id")
    ranked = ranked.withColumn("supplied", (F.count("supplied_order").over(page) == F.count(F.lit(1)).over(page)) & (F.coalesce(F.max("again").over(page), F.lit(0)) == 0))
    in_column = F.col("p_kind") == "column"
    key = [F.when(F.col("supplied"), F.col("supplied_order")).otherwise(F.when(in_column, F.col("p_x0")).otherwise(F.col("x0"))), *(F.when(~F.col("supplied"), F.col(c)) for c in ("y0", "x0")), F.col("id")]
    w = Window.partitionBy("page_id").orderBy(*key)
    cols = ("id", "p_kind", "x0", "y0", "x1", "y1")
    pairs = ranked.select("page_id", "supplied", *cols, *(F.lead(c).over(w).alias("n_" + c) for c in cols)).where("n_id is not null")
    overlap = F.least("y1", "n_y1") - F.greatest("y0", "n_y0")
    apart = (F.col("x1") <= F.col("n_x0")) | (F.col("n_x1") <= F.col("x0"))
    columns = F.coalesce((F.col("p_kind") == "column") & (F.col("n_p_kind") == "column"), F.lit(False))
    doubt = ~columns & apart & (overlap > 0) & (overlap * 2 >= F.least(F.col("y1") - F.col("y0"), F.col("n_y1") - F.col("n_y0")))
    edges.append(pairs.select("page_id", F.col("id").alias("source_id"), F.col("n_id").alias("target_id"), F.when(doubt, "adjacent").otherwise("reading-next").alias("relation"), F.when(doubt, 400).when(F.col("supplied"), 1000).otherwise(800).alias("confidence")))
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out


def coverage_report(evidence: DataFrame, proposals: DataFrame) -> DataFrame:
    """(page_id, source_id, state): treated, excluded, missing or multiple for every piece of evidence.

    ``evidence`` is (page_id, source_id); a proposal accounts for its sources if it has a treatment or a reason to leave them out.
    """
    accounts = proposals.where("treatment is not null or intentional_exclusion_reason is not null").select("page_id", F.explode("source_region_ids").alias("source_id"), F.col("intentional_exclusion_reason").isNotNull().alias("out"))
    counts = accounts.groupBy("page_id", "source_id").agg(F.count(F.lit(1)).alias("n"), F.bool_or("out").alias("out"))
    state = F.when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "multiple").when(F.col("out"), "excluded").otherwise("treated")
    return evidence.select("page_id", "source_id").distinct().join(counts, ["page_id", "source_id"], "left").select("page_id", "source_id", state.alias("state"))


def set_scores(predicted: DataFrame, truth: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """(by..., tp, fp, fn) of two sets of keys."""
    both = predicted.select(*keys).distinct().withColumn("_p", F.lit(1)).join(truth.select(*keys).distinct().withColumn("_t", F.lit(1)), keys, "full")
    return both.groupBy(*by).agg(F.count_if(F.col("_p").isNotNull() & F.col("_t").isNotNull()).alias("tp"), F.count_if(F.col("_t").isNull()).alias("fp"), F.count_if(F.col("_p").isNull()).alias("fn"))


def milli(part: Column, whole: Column) -> Column:
    """Thousandths, rounded down; 1000 of nothing."""
    return F.when(whole == 0, 1000).otherwise(F.floor(part * 1000 / whole)).cast("bigint")


def scores_milli(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 in thousandths of tp, fp, fn."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({"precision": milli(tp, tp + fp), "recall": milli(tp, tp + fn), "f1": milli(2 * tp, 2 * tp + fp + fn)})


def geometry_findings(proposals: DataFrame) -> DataFrame:
    """(page_id, id, finding): boxes that are missing, turned round, or outside of their page's box (px0, py0, px1, py1)."""
    tests = [("missing-box", F.expr("x0 is null or y0 is null or x1 is null or y1 is null")), ("invalid-box", F.expr("x1 <= x0 or y1 <= y0")), ("outside-page", F.expr("x0 < px0 or y0 < py0 or x1 > px1 or y1 > py1"))]
    found = F.filter(F.array(*(F.when(t, F.lit(n)) for n, t in tests)), lambda x: x.isNotNull())
    return proposals.select("page_id", "id", F.explode(found).alias("finding"))


def clipped(boxes: DataFrame) -> DataFrame:
    """Boxes cut to their page (px0, py0, px1, py1), at least one unit wide and high."""
    x0 = F.least(F.greatest("x0", "px0"), F.col("px1") - 1)
    y0 = F.least(F.greatest("y0", "py0"), F.col("py1") - 1)
    return boxes.select("page_id", "id", x0.alias("x0"), y0.alias("y0"), F.greatest(F.least("x1", "px1"), x0 + 1).alias("x1"), F.greatest(F.least("y1", "py1"), y0 + 1).alias("y1"))


def rotated(boxes: DataFrame, *, width: int, height: int) -> DataFrame:
    """Boxes of pages turned by 0, 90, 180 or 270 degrees, with y up, in upright coordinates with y down."""
    r = F.col("rotation")

    def pick(a: str, b: str, c: str, d: str) -> Column:
        return F.when(r == 0, F.expr(a)).when(r == 90, F.expr(b)).when(r == 180, F.expr(c)).when(r == 270, F.expr(d)).cast("bigint")

    w, h = width, height
    return boxes.select("page_id", "id", pick("x0", "y0", f"{w} - x1", f"{h} - y1").alias("x0"), pick(f"{h} - y1", "x0", "y0", f"{w} - x1").alias("y0"), pick("x1", "y1", f"{w} - x0", f"{h} - y0").alias("x1"), pick(f"{h} - y0", "x1", "y1", f"{w} - x0").alias("y1"))


def order_accuracy_with_gaps(ranks: DataFrame) -> DataFrame:
    """(page_id, correct_pairs, total_pairs) of (page_id, t, p): a pair is correct if both have a place and keep their order.

    Pairs without a place are wrong; the others are counted in n log n by :func:`layout.order_accuracy`.
    """
    from folia.operators.layout import order_accuracy

    total = ranks.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    placed = ranks.where("p is not null").select("page_id", "t", "p")
    right = order_accuracy(placed, truth=("t",), predicted=("p",)).select("page_id", "correct_pairs")
    return total.join(right, "page_id", "left").select("page_id", F.coalesce("correct_pairs", F.lit(0)).cast("bigint").alias("correct_pairs"), F.expr("n * (n - 1) div 2").cast("bigint").alias("total_pairs"))
