"""Joins and windows over review ledgers: paragraphs, decisions, approvals, overlays, patches, keys, sets.

Defined results: null keys match nothing; repeated rows count once where the docstring says distinct; empty
tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.functions import text as T
from folia.functions.digests import sha256


def paragraph_groups(regions: DataFrame) -> DataFrame:
    """(page_id, first_id, n, last_id) of runs of at least two prose regions without a gap in reading order.

    ``regions`` holds page_id, id, reading_order and prose.
    """
    w = Window.partitionBy("page_id").orderBy("reading_order", "id")
    goes_on = F.coalesce(F.lag("prose").over(w) & (F.col("reading_order") == F.lag("reading_order").over(w) + 1), F.lit(False))
    each = regions.withColumn("starts", F.when(F.col("prose") & ~goes_on, 1).otherwise(0))
    each = each.withColumn("run", F.sum("starts").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("prose")
    g = each.groupBy("page_id", "run").agg(F.min_by("id", "reading_order").alias("first_id"), F.max_by("id", "reading_order").alias("last_id"), F.count(F.lit(1)).alias("n"))
    return g.where("n >= 2").select("page_id", "first_id", "last_id", "n")


def latest_decisions(decisions: DataFrame, key: str, order: Column, value: str, deciding: tuple[str, ...]) -> DataFrame:
    """(key, decision, n_revisions): the last deciding value of each key; others leave the earlier one as it is."""
    hit = F.col(value).isin(*deciding)
    return decisions.groupBy(key).agg(F.max_by(value, F.when(hit, order)).alias("_v"), F.count_if(hit).alias("_n"), F.count(F.lit(1)).alias("n_revisions")).select(key, F.when(F.col("_n") > 0, F.col("_v")).alias("decision"), "n_revisions")


def merged_spans(spans: DataFrame, by: str, order: str, style: str) -> DataFrame:
    """(by, first, last, style, n): neighbours of one style as one span."""
    w = Window.partitionBy(by).orderBy(order)
    each = spans.withColumn("_starts", F.when(F.lag(style).over(w).eqNullSafe(F.col(style)) & F.lag(order).over(w).isNotNull(), 0).otherwise(1))
    each = each.withColumn("_run", F.sum("_starts").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return each.groupBy(by, "_run", style).agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n")).drop("_run")


def approvals(given: DataFrame, pages: DataFrame, digests: list[str]) -> DataFrame:
    """(page_id, reviewers, stale): distinct reviewers whose approval names all of a page's digests; other approvals are stale."""
    ours = pages.select("page_id", *(F.col(c).alias("_" + c) for c in digests))
    same = F.lit(True)
    for c in digests:
        same = same & F.coalesce(F.col(c) == F.col("_" + c), F.lit(False))
    met = given.join(ours, "page_id").withColumn("_same", same)
    return met.groupBy("page_id").agg(F.count_distinct(F.when(F.col("_same"), F.col("reviewer"))).alias("reviewers"), F.count_if(~F.col("_same")).alias("stale"))


def overlay_states(overlay: DataFrame, subjects: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, state, entries) of every entry and subject: known, once, complete and with an equal digest is ``valid``."""
    o = overlay.groupBy(key).agg(F.count(F.lit(1)).alias("entries"), F.min(digest).alias("low"), F.max(digest).alias("high"))
    s = subjects.select(key, F.col(digest).alias("_d"), F.lit(True).alias("_there"))
    both = o.join(s, key, "full")
    state = F.when(F.col("_there").isNull(), "unknown").when(F.col("entries").isNull(), "missing").when(F.coalesce((F.col("low") != F.col("_d")) | (F.col("high") != F.col("_d")), F.lit(True)), "stale").when(F.col("entries") > 1, "repeated").otherwise("valid")
    return both.select(key, state.alias("state"), F.coalesce("entries", F.lit(0)).alias("entries"))


def patched(patches: DataFrame, targets: DataFrame) -> DataFrame:
    """(page_id, id, status, text) of every target with patches, applied page by page or not at all.

    ``patches`` holds patch_id, id, operation, guard (digest of the text), new_text; ``targets`` holds page_id,
    id, text. A second patch of one target is ``duplicate``, an operation other than replace-text ``refused``,
    a guard that is not the text's digest ``stale``; one such patch holds back all of its page (``held-back``).
    """
    known = patches.join(targets, "id")
    one = known.groupBy("page_id", "id").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("operation", "guard", "new_text"), "patch_id").alias("p"), F.first("text").alias("text"))
    fault = F.when(F.col("n") > 1, "duplicate").when(F.col("p.operation") != "replace-text", "refused").when(~F.coalesce(F.col("p.guard") == sha256(F.col("text")), F.lit(False)), "stale")
    one = one.withColumn("fault", fault)
    pages = one.groupBy("page_id").agg((F.count("fault") > 0).alias("bad"))
    each = one.join(pages, "page_id")
    status = F.coalesce("fault", F.when(F.col("bad"), "held-back").otherwise("applied"))
    return each.select("page_id", "id", status.alias("status"), F.when(status == "applied", F.col("p.new_text")).otherwise(F.col("text")).alias("text"))


def disagreement(left: Column, right: Column) -> Column:
    """Category of two texts: equal, whitespace, section-number (equal but for a number before), span-fragment, other."""
    a, b = T.prose_signature(left), T.prose_signature(right)
    number = lambda c: F.regexp_replace(c, r"^[0-9]+(\.[0-9]+)*\.? +", "")
    return F.when(left == right, "equal").when(a == b, "whitespace").when(number(a) == number(b), "section-number").when((a != "") & (b != "") & (a.contains(b) | b.contains(a)), "span-fragment").otherwise("other")


CATEGORIES = ("equal", "whitespace", "section-number", "span-fragment", "other")


def counted_categories(values: DataFrame, category: str) -> DataFrame:
    """(category, n) of all categories, also of those that do not occur."""
    counts = values.groupBy(F.col(category).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    names = values.sparkSession.createDataFrame([(c,) for c in CATEGORIES], "category string")
    return names.join(counts, "category", "left").select("category", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def set_difference(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(key, side) of keys that only one of two sets has."""
    a, b = expected.select(key).where(F.col(key).isNotNull()).distinct(), actual.select(key).where(F.col(key).isNotNull()).distinct()
    return a.join(b, key, "left_anti").select(key, F.lit("expected").alias("side")).unionByName(b.join(a, key, "left_anti").select(key, F.lit("actual").alias("side")))


def best_ranked(candidates: DataFrame, by: str, order: list[Column], usable: Column) -> DataFrame:
    """The first candidate of each group in order, only among usable ones; by partial aggregation, without a sort."""
    key = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))
    rest = [c for c in candidates.columns if c != by]
    return candidates.where(usable).groupBy(by).agg(F.min_by(F.struct(*rest), key).alias("_b")).select(by, "_b.*")


def normalized(texts: DataFrame, key: str, col: str) -> DataFrame:
    """(key, text) with one line end, composed characters and no final line end; null stays null."""
    import unicodedata
    from collections.abc import Iterator

    import pandas as pd

    from folia.functions.frames import frame

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield frame([(k, None if t is None else unicodedata.normalize("NFC", t)) for k, t in zip(pdf[key], pdf[col])], [key, "text"])

    lf = F.replace(F.replace(F.col(col), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    kind = texts.schema[key].dataType.simpleString()
    done = texts.select(key, F.regexp_replace(lf, "\n\\z", "").alias(col)).mapInPandas(run, f"`{key}` {kind}, text string")
    return done
