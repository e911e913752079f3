"""Text-quality evaluation of engines against ground truth.

All measures are sums of per-region counts, so they combine on the map side; texts are compared region by
region and never leave their row. Truth is joined to predictions by region id; a missing prediction counts
as an empty text, which makes the join a left join, and extra predictions an anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.functions import text as T

#: Names of engines that one evaluation takes at most.
MAX_ENGINES = 1_000


def current_rows(df: DataFrame, key: str, order: Column) -> DataFrame:
    """One row per key, that of the greatest ``order``; partial aggregation, no window sort."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(key, "_r.*")


def _for_each_engine(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every truth row once for each engine: the distinct names, counted in one job, are an array in the row."""
    names = sorted(r.engine for r in predictions.select("engine").distinct().limit(MAX_ENGINES + 1).collect())
    if len(names) > MAX_ENGINES:
        raise ValueError(f"more than {MAX_ENGINES} engines")
    return truth.select(F.explode(F.array(*map(F.lit, names)).cast("array<string>")).alias("engine"), *truth.columns)


def paired(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """truth(region_id, kind, text) left-joined to predictions(engine, region_id, text) for every engine."""
    wanted = _for_each_engine(truth, predictions)
    p = predictions.select("engine", "region_id", F.col("text").alias("predicted"))
    return wanted.join(p, ["engine", "region_id"], "left").withColumn("predicted", F.coalesce("predicted", F.lit("")))


def character_errors(pairs: DataFrame, *by: str) -> DataFrame:
    """Errors, reference units and regions by group, and the micro-averaged error rate (0 without units)."""
    a, b = F.col("text"), F.col("predicted")
    errors = F.when(a == b, 0).otherwise(F.levenshtein(a, b)).cast("bigint")
    return (
        pairs.groupBy(*by)
        .agg(F.sum(errors).alias("errors"), F.sum(F.length(a).cast("bigint")).alias("reference_units"), F.count(F.lit(1)).alias("regions"))
        .withColumn("error_rate", F.when(F.col("reference_units") > 0, F.col("errors") / F.col("reference_units")).otherwise(F.lit(0.0)))
    )


def omissions(truth: DataFrame, predictions: DataFrame, *by: str) -> DataFrame:
    """Truth regions that an engine lacks: their number and characters by group."""
    wanted = _for_each_engine(truth, predictions)
    lost = wanted.join(predictions.select("engine", "region_id"), ["engine", "region_id"], "left_anti")
    return lost.groupBy("engine", *by).agg(F.count(F.lit(1)).alias("omitted"), F.sum(F.length("text").cast("bigint")).alias("omitted_characters"))


def code_tokens(pairs: DataFrame, *by: str) -> DataFrame:
    """Positional equality of white-space tokens: reference, exact, omitted and extra tokens by group."""
    a, b = T.words(F.col("text")), T.words(F.col("predicted"))
    exact = F.size(F.filter(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), lambda z: z))
    n, m = F.size(a), F.size(b)
    return pairs.groupBy(*by).agg(
        F.sum(n.cast("bigint")).alias("reference_tokens"), F.sum(exact.cast("bigint")).alias("exact_tokens"), F.sum(F.greatest(n - m, F.lit(0)).cast("bigint")).alias("omitted_tokens"), F.sum(F.greatest(m - n, F.lit(0)).cast("bigint")).alias("extra_tokens")
    )


def quality_cube(pairs: DataFrame) -> DataFrame:
    """Errors by engine and, as grouping sets, by kind, by document and over all."""
    a, b = F.col("text"), F.col("predicted")
    scored = pairs.select("engine", "kind", "document_id", F.when(a == b, 0).otherwise(F.levenshtein(a, b)).cast("bigint").alias("errors"), F.length(a).cast("bigint").alias("units"))
    return scored.groupingSets([["engine", "kind"], ["engine", "document_id"], ["engine"]], "engine", "kind", "document_id").agg(F.sum("errors").alias("errors"), F.sum("units").alias("reference_units"), F.count(F.lit(1)).alias("regions"))


def projection_matches(pairs: DataFrame) -> DataFrame:
    """Whether two witnesses agree under the policy of the region's kind: prose by collapsed white space, code by
    lines without indentation, all else exactly."""
    a, b, kind = F.col("text"), F.col("predicted"), F.col("kind")
    prose = kind.isin("body", "definition", "section")
    ok = F.when(prose, T.prose_signature(a) == T.prose_signature(b)).when(kind == "code", T.code_signature(a) == T.code_signature(b)).otherwise(a == b)
    policy = F.when(prose, "prose").when(kind == "code", "code").otherwise("exact")
    return pairs.select(policy.alias("policy"), ok.alias("ok")).groupBy("policy").agg(F.count(F.lit(1)).alias("pairs"), F.count_if("ok").alias("matching"))


def macro_f1(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Per label tp, fp, fn and F1 over distinct (region_id, kind) sets; the row without a label holds the mean F1."""
    t = truth.select("region_id", "kind").distinct().withColumn("in_truth", F.lit(1))
    p = found.select("region_id", "kind").distinct().withColumn("in_found", F.lit(1))
    both = t.join(p, ["region_id", "kind"], "full")
    c = both.groupBy("kind").agg(
        F.count_if(F.col("in_truth").isNotNull() & F.col("in_found").isNotNull()).alias("tp"), F.count_if(F.col("in_truth").isNull()).alias("fp"), F.count_if(F.col("in_found").isNull()).alias("fn")
    )
    each = c.withColumn("f1", F.when(2 * F.col("tp") + F.col("fp") + F.col("fn") > 0, 2.0 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).otherwise(F.lit(0.0)))
    mean = each.agg(F.lit(None).cast("string").alias("kind"), F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.avg("f1").alias("f1"))
    return each.unionByName(mean)
