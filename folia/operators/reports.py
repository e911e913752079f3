"""Reports: grounded engine results, stratified measurements, compositions, page and document classes.

All measures are sums, minima and maxima, so they combine on the map side. Digests of a page are order-free
sums over its regions, so no page is put together in one row.

Defined results: empty strata give null rates; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def page_digests(regions: DataFrame, *parts: str) -> DataFrame:
    """(page_id, regions, digest): a digest of a page's set of regions from the given columns (null as empty).

    Every region gives 48 bits of its own digest; their sum and number do not depend on the order.
    """
    one = F.conv(F.substring(F.md5(F.concat_ws("\x1f", *(F.coalesce(c, F.lit("")) for c in parts)).cast("binary")), 1, 12), 16, 10).cast("decimal(38,0)")
    sums = regions.groupBy("page_id").agg(F.count(F.lit(1)).alias("regions"), F.sum(one).alias("s"))
    return sums.select("page_id", "regions", F.sha2(F.concat_ws(":", F.col("regions").cast("string"), F.col("s").cast("string")), 256).alias("digest"))


def grounded_reports(pages: DataFrame, reports: DataFrame) -> DataFrame:
    """Reports with ``grounded``: the page is known, its digest is that of pages(page_id, digest), and no earlier one has it.

    Of several good reports of one page the first by ``report_id`` holds; the others are ungrounded.
    """
    known = pages.select("page_id", F.col("digest").alias("_d"))
    each = reports.join(known, "page_id", "left").withColumn("_ok", F.coalesce(F.col("digest") == F.col("_d"), F.lit(False)))
    first = each.where("_ok").groupBy("engine", "version", "page_id").agg(F.min("report_id").alias("_first"))
    out = each.join(first, ["engine", "version", "page_id"], "left")
    return out.withColumn("grounded", F.col("_ok") & (F.col("report_id") == F.col("_first"))).drop("_d", "_ok", "_first")


def engine_report(pages: DataFrame, reports: DataFrame) -> DataFrame:
    """Per engine and version: pages that count, miss or are ungrounded, errors and units, also of clean, degraded and code pages.

    Rates are null for an engine with any ungrounded report. ``pages`` holds page_id, digest, tags and has_code.
    """
    total = pages.agg(F.count(F.lit(1)).alias("n"))
    each = grounded_reports(pages, reports).join(pages.select("page_id", "tags", "has_code"), "page_id", "left")
    good = F.col("grounded")
    tagged = lambda t: good & F.coalesce(F.array_contains("tags", t), F.lit(False))
    total_of = lambda test, c: F.coalesce(F.sum(F.when(test, F.col(c))), F.lit(0)).alias
    c = each.groupBy("engine", "version").agg(
        F.count_if(good).alias("selected_pages"), F.count_distinct(F.when(~good, F.col("page_id"))).alias("ungrounded_pages"), total_of(good, "errors")("errors"), total_of(good, "units")("units"),
        total_of(tagged("clean"), "errors")("clean_errors"), total_of(tagged("clean"), "units")("clean_units"), total_of(tagged("degraded"), "errors")("degraded_errors"), total_of(tagged("degraded"), "units")("degraded_units"),
        total_of(good & F.coalesce("has_code", F.lit(False)), "units")("code_units"),
    )
    rate = F.when((F.col("ungrounded_pages") == 0) & (F.col("units") > 0), F.col("errors") / F.col("units"))
    # One row of one number goes to every row of the report.
    return c.crossJoin(F.broadcast(total)).withColumns({"missing_pages": F.col("n") - F.col("selected_pages"), "error_rate": rate}).drop("n")


def missing_pages(pages: DataFrame, reports: DataFrame) -> DataFrame:
    """(engine, version, page_id) of known pages without a grounded report of the engine."""
    good = grounded_reports(pages, reports).where("grounded").select("engine", "version", "page_id")
    engines = reports.select("engine", "version").distinct()
    # Engines are names; their number is checked before every page is listed for each of them.
    names = engines.limit(1001).collect()
    if len(names) > 1000:
        raise ValueError("more than 1000 engines")
    each = F.array(*(F.struct(F.lit(r.engine).alias("engine"), F.lit(r.version).alias("version")) for r in names)) if names else F.array().cast("array<struct<engine: string, version: string>>")
    return pages.select(F.explode(each).alias("e"), "page_id").select("e.engine", "e.version", "page_id").join(good, ["engine", "version", "page_id"], "left_anti")


def stratified(measurements: DataFrame) -> DataFrame:
    """Measures by ``class:`` and ``tag:`` group: every page counts in its class and in each of its tags.

    Rates of nothing are 1; the calibration error is the weighted mean distance of confidence and accuracy
    over the bins, null without any.
    """
    labels = F.concat(F.array(F.concat(F.lit("class:"), "page_class")), F.transform(F.array_distinct(F.coalesce("tags", F.array().cast("array<string>"))), lambda t: F.concat(F.lit("tag:"), t)))
    each = measurements.withColumn("stratum", F.explode(labels))
    bins = lambda f: F.aggregate("bins", F.lit(0.0), lambda acc, b: acc + f(b))
    total = lambda c: F.sum(c).alias(c)
    g = each.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("pages"), total("tp"), total("fp"), total("fn"), total("order_correct"), total("order_total"), total("runtime_ms"), F.max("memory_bytes").alias("memory_bytes"),
        F.sum(bins(lambda b: F.abs(b["confidence"] - b["accuracy"]) * b["n"])).alias("_off"), F.sum(bins(lambda b: b["n"].cast("double"))).alias("_n"),
    )
    share = lambda a, b: F.when(b == 0, 1.0).otherwise(a / b)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rates = {"region_precision": share(tp, tp + fp), "region_recall": share(tp, tp + fn), "region_f1": share(2 * tp, 2 * tp + fp + fn), "order_accuracy": share(F.col("order_correct"), F.col("order_total"))}
    return g.withColumns({**rates, "calibration_error": F.when(F.col("_n") > 0, F.col("_off") / F.col("_n"))}).drop("_off", "_n", "tp", "fp", "fn", "order_correct", "order_total")


def composition(pages: DataFrame, required: dict[str, int]) -> DataFrame:
    """(tag, n, required, missing) of pages(page_key, tags): repeated pages count once, tags that are required appear in any case."""
    counts = pages.select("page_key", F.explode("tags").alias("tag")).where("tag is not null").distinct().groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    want = pages.sparkSession.createDataFrame(sorted(required.items()), "tag string, required bigint")
    both = counts.join(want, "tag", "full")
    n, r = F.coalesce("n", F.lit(0)), F.coalesce("required", F.lit(0))
    return both.select("tag", n.alias("n"), r.alias("required"), F.greatest(r - n, F.lit(0)).alias("missing"))


def page_class(text: Column, coverage: Column, images: Column, bilevel: Column, continuous: Column, landscape: Column, fonts: Column, vectors: Column) -> Column:
    """struct(label, confidence, alternatives) of a page from what was measured of it, by ordered rules."""
    there, sized = text >= 8, F.coalesce(coverage >= 0.6, F.lit(False))
    some = images > 0
    row = lambda label, confidence, *other: F.struct(label.alias("label") if isinstance(label, Column) else F.lit(label).alias("label"), (confidence if isinstance(confidence, Column) else F.lit(confidence)).alias("confidence"), F.concat_ws(",", *(o if isinstance(o, Column) else F.lit(o) for o in other)).alias("alternatives"))
    scan = F.when(bilevel & landscape, row("schematic", "medium", "scan-bilevel")).when(bilevel, row("scan-bilevel", "high")).when(continuous, row("photo-or-illustration-dominant", "medium", "scan-color", "scan-gray")).otherwise(row("ambiguous", "low"))
    return (
        F.when(there & (sized | (some & coverage.isNull())), row("hybrid", F.when(coverage.isNull(), "medium").otherwise("high")))
        .when(sized & ~there, scan)
        .when(there & ((fonts > 0) | F.coalesce(vectors > 0, F.lit(False)) | ~some), row("born-digital", F.when(some, "medium").otherwise("high"), F.when(some, "hybrid")))
        .when(some & coverage.isNull(), row("ambiguous", "low", F.when(there, "hybrid").otherwise("scan-gray")))
        .otherwise(row("ambiguous", "low"))
    )


def image_coverage(placed: Column, area: Column, page_area: Column) -> Column:
    """Share of a page under images: known shares added up to at most 1, else estimated areas over the page's."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)
    known = F.filter(placed, lambda x: x.isNotNull())
    guess = F.filter(area, lambda x: x > 0)
    least = lambda x: F.bround(F.least(x, F.lit(1.0)), 6)
    return F.when(F.size(known) > 0, least(total(known))).when((page_area > 0) & (F.size(guess) > 0), least(total(guess) / page_area))


def document_class(labels: DataFrame, doc: str, label: str) -> DataFrame:
    """(doc, label, confidence, pages): one class of all pages, else hybrid; ambiguous pages only lower the confidence."""
    c = labels.groupBy(doc).agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.coalesce(F.col(label) != "ambiguous", F.lit(False))).alias("clear"), F.min(F.when(F.col(label) != "ambiguous", F.col(label))).alias("low"), F.max(F.when(F.col(label) != "ambiguous", F.col(label))).alias("high"),
        F.coalesce(F.bool_or(F.col(label) == "hybrid"), F.lit(False)).alias("hybrid"), F.coalesce(F.bool_or(F.col(label) == "born-digital"), F.lit(False)).alias("digital"),
    )
    one = (F.col("low") == F.col("high")) & ~F.col("hybrid")
    name = F.when(F.col("clear") == 0, "ambiguous").when(one, F.col("low")).otherwise("hybrid")
    sure = F.when(F.col("clear") == 0, "low").when(one, F.when(F.col("clear") == F.col("pages"), "high").otherwise("medium")).when(F.col("hybrid") | F.col("digital"), "medium").otherwise("low")
    return c.select(doc, name.alias("label"), sure.alias("confidence"), "pages")


def line_break_agreement(texts: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """(key, agreement): lines equal at their place, in thousandths of the longer side's lines; 1000 of two empty ones."""
    a, b = F.split(left, "\n"), F.split(right, "\n")
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), lambda z: z))
    return texts.select(key, F.floor(same * 1000 / F.greatest(F.size(a), F.size(b))).cast("bigint").alias("agreement"))


def otsu(values: DataFrame, by: str, value: str) -> DataFrame:
    """(by, threshold): the value of 0..255 that separates a histogram best, the first of equal ones.

    Counts come first, so a window holds at most 256 rows of one group. Variances are compared as fractions
    of integers: (mean difference)² × weights = (sum·w0 − s0·total)² / (w0·w1).
    """
    h = values.where(F.col(value).isNotNull()).groupBy(by, F.col(value).cast("bigint").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    w, below = Window.partitionBy(by), Window.partitionBy(by).orderBy("v")
    h = h.withColumns({"total": F.sum("n").over(w), "mass": F.sum(F.col("n") * F.col("v")).over(w), "w0": F.sum("n").over(below), "s0": F.sum(F.col("n") * F.col("v")).over(below)})
    top = (F.col("mass") * F.col("w0") - F.col("s0") * F.col("total")).cast("double")
    score = F.when(F.col("w0") < F.col("total"), top * top / (F.col("w0") * (F.col("total") - F.col("w0"))).cast("double")).otherwise(0.0)
    return h.withColumn("score", score).groupBy(by).agg(F.min_by("v", F.struct(-F.col("score"), "v")).alias("threshold"))


def order_digest(files: DataFrame, by: str, path: str, digest: str) -> DataFrame:
    """(by, n, order_digest): digest of the lines ``place<tab>path<tab>digest`` of a group's files in order of their paths."""
    rows = F.array_sort(F.collect_list(F.struct(path, digest)))
    lines = F.transform(rows, lambda x, i: F.concat((i + 1).cast("string"), F.lit("\t"), x[path], F.lit("\t"), x[digest], F.lit("\n")))
    return files.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("order_digest"))
