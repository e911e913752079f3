"""Half-open integer boxes ``[x0, y0, x1, y1)`` as four columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def area(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.greatest(x1 - x0, F.lit(0)) * F.greatest(y1 - y0, F.lit(0))


def shared_area(a: str, b: str) -> Column:
    """Area of the intersection of two boxes whose columns carry the prefixes ``a`` and ``b``."""
    w = F.least(F.col(f"{a}x1"), F.col(f"{b}x1")) - F.greatest(F.col(f"{a}x0"), F.col(f"{b}x0"))
    h = F.least(F.col(f"{a}y1"), F.col(f"{b}y1")) - F.greatest(F.col(f"{a}y0"), F.col(f"{b}y0"))
    return F.greatest(w, F.lit(0)) * F.greatest(h, F.lit(0))


def iou_milli(a: str, b: str) -> Column:
    """Intersection over union in thousandths, rounded down; an empty union gives 0."""
    inter = shared_area(a, b)
    union = area(*(F.col(f"{a}{k}") for k in ("x0", "y0", "x1", "y1"))) + area(*(F.col(f"{b}{k}") for k in ("x0", "y0", "x1", "y1"))) - inter
    return F.when(union > 0, F.floor(inter * 1000 / union)).otherwise(0).cast("bigint")
