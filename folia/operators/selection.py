"""Selection, sampling, frontiers, references and ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folia.functions.digests import sha256

#: Parts that a group is cut into before its own order is needed.
SALTS = 32


def top_per_stratum(df: DataFrame, strata: list[str], order: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of every stratum; ranked in salted parts first, so no stratum is sorted by one task."""
    salt = F.pmod(F.xxhash64(*order), F.lit(SALTS))
    part = Window.partitionBy(*strata, "_salt").orderBy(*order)
    some = df.withColumn("_salt", salt).withColumn("_r", F.row_number().over(part)).where(F.col("_r") <= k)
    whole = Window.partitionBy(*strata).orderBy(*order)
    return some.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k).drop("_salt", "_r")


def second_review_sample(pages: DataFrame, *, group: str, share_percent: int = 10) -> DataFrame:
    """(group, page_key): the first ``ceil(share)`` pages of each group by the digest of group and page."""
    digest = sha256(F.concat(F.col(group), F.lit("\x1f"), F.col("page_key")))
    # Two digits of the digest cut a group into parts that are in order already: whole parts are counted, and
    # places are given inside one part only, so no group is sorted by one task.
    each = pages.select(group, "page_key", digest.alias("digest"), F.substring(digest, 1, 2).alias("part"))
    counts = each.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(group)
    ahead = F.coalesce(F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(group, "part", ahead.alias("ahead"), F.ceil(F.sum("n").over(whole) * share_percent / 100).alias("wanted")).where("ahead < wanted")
    rank = F.row_number().over(Window.partitionBy(group, "part").orderBy("digest", "page_key"))
    return each.join(counts, [group, "part"]).where(F.col("ahead") < F.col("wanted")).withColumn("r", rank).where(F.col("ahead") + F.col("r") <= F.col("wanted")).select(group, "page_key")


def pareto_frontier(df: DataFrame, by: list[str], low: str, high: str) -> DataFrame:
    """(by, low, high): the pairs of measures of each group that no other pair beats in both (smaller is better).

    The least ``high`` of every ``low`` is aggregated first. Salted parts keep their own frontiers next; a
    part's frontier holds every pair that the group's frontier has in it.
    """

    def frontier(d: DataFrame, part: list[str]) -> DataFrame:
        before = Window.partitionBy(*part).orderBy(low).rowsBetween(Window.unboundedPreceding, -1)
        best = d.withColumn("_best", F.min(high).over(before))
        return best.where(F.col("_best").isNull() | (F.col(high) < F.col("_best"))).drop("_best")

    known = df.where(F.col(low).isNotNull() & F.col(high).isNotNull())
    least = known.groupBy(*by, low).agg(F.min(high).alias(high))
    salted = least.withColumn("_salt", F.pmod(F.xxhash64(low), F.lit(SALTS)))
    return frontier(frontier(salted, [*by, "_salt"]).drop("_salt"), by)


def percentiles(df: DataFrame, by: str, value: str, share: float = 0.95) -> DataFrame:
    """Nearest-rank percentile of a value per group, with the number of known values.

    Equal values are counted first; the percentile is read off the running counts, so what is sorted per
    group is its distinct values only.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(by)
    run = counts.withColumn("_run", F.sum("_n").over(w.orderBy(value))).withColumn("n", F.sum("_n").over(w))
    return run.where(F.col("_run") >= F.ceil(F.col("n") * F.lit(share))).groupBy(by).agg(F.min(value).alias("percentile"), F.max("n").alias("n"))


def span_clusters(spans: DataFrame, by: str, start: str, end: str, gap: int = 20) -> DataFrame:
    """(by, cluster, first, last, spans): spans that start within ``gap`` of the furthest end before them."""
    w = Window.partitionBy(by).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("_new", F.when(F.coalesce(F.col(start) - reach > gap, F.lit(True)), 1).otherwise(0))
    numbered = opened.withColumn("cluster", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(by, "cluster").agg(F.min(start).cast("bigint").alias("first"), F.max(end).cast("bigint").alias("last"), F.count(F.lit(1)).alias("spans"))


def runs(df: DataFrame, by: str, order: str, value: str, *, at_least: int = 2) -> DataFrame:
    """(by, value, first, last, n): gaps-and-islands of equal values on consecutive positions."""
    rows = df.select(by, order, value).distinct()
    w = Window.partitionBy(by, value).orderBy(order)
    island = rows.withColumn("_i", F.col(order) - F.row_number().over(w))
    out = island.groupBy(by, value, "_i").agg(F.min(order).cast("bigint").alias("first"), F.max(order).cast("bigint").alias("last"), F.count(F.lit(1)).alias("n"))
    return out.where(F.col("n") >= at_least).drop("_i")


def sequence_findings(df: DataFrame, by: str, order: str) -> DataFrame:
    """(by, pages, duplicates, missing): whether positions are unique and without gaps in each group."""
    each = df.where(F.col(by).isNotNull() & F.col(order).isNotNull()).groupBy(by, order).agg(F.count(F.lit(1)).alias("n"))
    g = each.groupBy(by).agg(F.count(F.lit(1)).alias("pages"), F.sum(F.col("n") - 1).cast("bigint").alias("duplicates"), F.max(order).alias("hi"), F.min(order).alias("lo"))
    return g.select(by, "pages", "duplicates", (F.col("hi") - F.col("lo") + 1 - F.col("pages")).cast("bigint").alias("missing"))


def content_groups(df: DataFrame, key: str, content: str) -> DataFrame:
    """(sha256, copies, first_id, n_bytes, collision): rows of equal content under its digest; unequal lengths give a collision away."""
    rows = df.where(F.col(content).isNotNull())
    return rows.groupBy(sha256(F.col(content)).alias("sha256")).agg(F.count(F.lit(1)).alias("copies"), F.min(key).alias("first_id"), F.max(F.octet_length(content)).cast("bigint").alias("n_bytes"), (F.min(F.octet_length(content)) != F.max(F.octet_length(content))).alias("collision"))


def dangling_references(rows: DataFrame, key: str, target: str, known: DataFrame, known_key: str) -> DataFrame:
    """(target, n): references to rows that do not exist, counted by target."""
    refs = rows.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("target")).agg(F.count_distinct(key).alias("n"))
    return refs.join(known.select(F.col(known_key).alias("target")), "target", "left_anti")


def pending(keys: DataFrame, ledger: DataFrame, on: list[str]) -> DataFrame:
    """Keys without a complete result in the ledger; failed results are tried again."""
    done = ledger.where("status = 'complete'").select(*on).distinct()
    return keys.join(done, on, "left_anti")


def guarded(patches: DataFrame, targets: DataFrame, on: str, guards: dict[str, str]) -> DataFrame:
    """Patches with a status: ``unknown-target``, ``stale`` if a guarded digest differs, else ``applies``."""
    t = targets.select(F.col(on), F.lit(True).alias("_there"), *(F.col(v).alias("_t_" + v) for v in guards.values()))
    same = F.lit(True)
    for ours, theirs in guards.items():
        same = same & F.col(ours).eqNullSafe(F.col("_t_" + theirs))
    status = F.when(F.col("_there").isNull(), "unknown-target").when(~same, "stale").otherwise("applies")
    return patches.join(t, on, "left").withColumn("guard_status", status).drop("_there", *("_t_" + v for v in guards.values()))


def selected_text(selectors: DataFrame, sources: DataFrame) -> DataFrame:
    """(selector_id, span_status, n_lines, span_sha256): the lines that each selector cuts out.

    A span that runs past the file ends with it; a null or reversed one selects nothing.
    """
    cut = selectors.join(sources.select("source_path", F.split("text", "\n").alias("_l")), "source_path", "left")
    a, b = F.col("source_span")[0], F.col("source_span")[1]
    bad = F.col("source_span").isNull() | (a > b) | (a < 1)
    status = F.when(F.col("_l").isNull(), "unknown-source").when(F.col("source_span").isNull(), "no-span").when((a > b) | (a < 1), "bad-span").when(b > F.size("_l"), "overlong").otherwise("whole")
    lines = F.when(~F.coalesce(bad, F.lit(True)) & F.col("_l").isNotNull() & (a <= F.size("_l")), F.slice("_l", a, F.least(b, F.size("_l")) - a + 1))
    text = F.array_join(lines, "\n")
    out = cut.select("selector_id", status.alias("span_status"), F.coalesce(F.size(lines), F.lit(0)).cast("bigint").alias("n_lines"), sha256(text).alias("span_sha256"))
    return out.withColumn("n_lines", F.greatest("n_lines", F.lit(0).cast("bigint"))).distinct()


def wilson_upper(errors: Column, n: Column, z: float = 1.959963984540054) -> Column:
    """Upper bound of the 95 % Wilson interval of a rate; 1 without observations."""
    p, zz = errors / n, z * z
    bound = (p + zz / (2 * n) + z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)
    return F.when(n > 0, F.least(bound, F.lit(1.0))).otherwise(F.lit(1.0))
