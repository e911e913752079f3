"""Reconciliation of recognition engines: the routed text is kept, others support or question it.

Lines of all engines meet on their alignment key, so one join serves choice, disagreement and omission.
``lines`` holds page_id, engine, line_key, line_id, line_no, text and confidence (0..1000 or null).

Defined results: a null confidence counts as 0 before calibration; engines without calibration are taken as
they are; ties of confidence go to the greater engine, then the greater line id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.operators.lines import risk_codes

#: Calibrated confidence below which a routed line needs review (fixed value).
LOW_CONFIDENCE = 700
RANK = {"info": 0, "medium": 1, "high": 2}


def calibrated(engine: Column, confidence: Column, calibrations: dict[str, tuple[int, int]]) -> Column:
    """Confidence in thousandths after the engine's scale (in thousandths) and offset, within 0 and 1000."""
    raw = F.coalesce(confidence, F.lit(0))
    out = raw
    for name, (scale, offset) in calibrations.items():
        out = F.when(engine == name, F.floor(raw * scale / 1000) + offset).otherwise(out)
    return F.greatest(F.least(out, F.lit(1000)), F.lit(0)).cast("bigint")


def _met(lines: DataFrame, routed: str, calibrations: dict[str, tuple[int, int]]) -> DataFrame:
    """Every routed line with the aligned lines of all engines as an array, its own among them; there are few engines."""
    each = lines.withColumn("c", calibrated(F.col("engine"), F.col("confidence"), calibrations))
    mine = F.col("engine") == routed
    g = each.groupBy("page_id", "line_key").agg(
        F.max(F.when(mine, F.struct("line_id", "text", "c"))).alias("own"), F.collect_list(F.struct("c", "engine", "line_id", "text")).alias("all")
    )
    return g.where("own is not null")


def selected_lines(lines: DataFrame, routed: str, calibrations: dict[str, tuple[int, int]]) -> DataFrame:
    """(page_id, line_id, text, source_engine, confidence, n_agreeing, n_alternatives) of every routed line.

    The text is that of the routed engine; its source is the engine of the greatest confidence among those
    that agree to the letter.
    """
    g = _met(lines, routed, calibrations)
    agree = F.filter("all", lambda x: x["text"].eqNullSafe(F.col("own.text")))
    best = F.array_max(F.transform(agree, lambda x: F.struct(x["c"].alias("c"), x["engine"].alias("engine"), x["line_id"].alias("line_id"))))
    return g.select("page_id", "own.line_id", "own.text", best["engine"].alias("source_engine"), best["c"].alias("confidence"), F.size(agree).alias("n_agreeing"), (F.size("all") - 1).alias("n_alternatives"))


def findings(lines: DataFrame, routed: str, engines: list[str], calibrations: dict[str, tuple[int, int]], *, low: int = LOW_CONFIDENCE) -> DataFrame:
    """(page_id, subject_id, code, detail, severity): what of the routed lines needs review, and repeated lines of every engine."""
    g = _met(lines, routed, calibrations)
    text = F.col("own.text")
    others = F.filter("all", lambda x: x["engine"] != routed)
    disagree = F.exists(others, lambda x: ~x["text"].eqNullSafe(text))
    plain = F.array(F.when(F.col("own.c") < low, F.lit("LOW_CONFIDENCE")), F.when(disagree, F.lit("ENGINE_DISAGREEMENT")))
    codes = F.transform(F.concat(F.filter(plain, lambda x: x.isNotNull()), risk_codes(F.coalesce(text, F.lit("")))), lambda c: F.struct(c.alias("code"), F.lit("").alias("detail")))
    there = F.transform("all", lambda x: x["engine"])
    absent = F.filter(F.array(*(F.when(~F.array_contains(there, e), F.lit(e)) for e in engines if e != routed)), lambda e: e.isNotNull())
    omitted = F.transform(absent, lambda e: F.struct(F.lit("OMISSION").alias("code"), e.alias("detail")))
    out = g.select("page_id", F.col("own.line_id").alias("subject_id"), F.explode(F.concat(codes, omitted)).alias("f")).select("page_id", "subject_id", "f.code", "f.detail")
    return out.unionByName(duplicates(lines)).withColumn("severity", F.lit("high"))


def duplicates(lines: DataFrame) -> DataFrame:
    """(page_id, subject_id, code, detail): lines that an engine has more than once on a page, at their first place."""
    again = lines.where("text <> ''").groupBy("page_id", "engine", "text").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("line_key", "line_id")).alias("first")).where("n > 1")
    return again.select("page_id", F.col("first.line_id").alias("subject_id"), F.lit("DUPLICATE_LINE").alias("code"), F.concat_ws(":", "engine", F.col("n").cast("string")).alias("detail"))


def review_queue(found: DataFrame, *, minimum: str = "medium", code: str | None = None) -> DataFrame:
    """Findings of at least a severity and, if given, of one code."""
    rank = F.create_map(*(F.lit(x) for pair in RANK.items() for x in pair))[F.col("severity")]
    out = found.where(rank >= RANK[minimum])
    return out if code is None else out.where(F.col("code") == code)
