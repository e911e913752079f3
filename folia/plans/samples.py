"""Bounded samples that do not depend on the layout of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts of the hash space that a share is rounded to, and how much more than the bound is let through the filter.
PARTS, SLACK = 1 << 20, 1.2


def bounded_sample(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """At most ``rows`` rows of ``df``, those of the lowest hash of ``keys``.

    A filter on the hash lets through little more than the bound, so what the tasks send to the driver for
    the final top-k does not grow with the table. The result does not depend on partitioning.
    """
    total = df.count()
    h = F.xxhash64(*keys)
    some = df.withColumn("_h", h)
    share = min(1.0, (SLACK * rows + 100) / max(1, total))
    if share < 1.0:
        some = some.where(F.pmod(F.col("_h"), F.lit(PARTS)) < F.lit(max(1, round(share * PARTS))))
    return some.orderBy(F.pmod(F.col("_h"), F.lit(PARTS)), "_h").limit(rows).drop("_h")
