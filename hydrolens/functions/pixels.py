"""Column expressions on masks and on their overlap counts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EPSILON = 1e-8


def binarise(grey: Column, rule: str = "above_127") -> Column:
    """0/1 truth from a grey mask: 'above_127' (batch scoring) or 'equals_255' (training)."""
    if rule not in ("above_127", "equals_255"):
        raise ValueError(f"not a truth rule: {rule!r}")
    hit = (lambda g: g > 127) if rule == "above_127" else (lambda g: g == 255)
    return F.transform(grey, lambda g: F.when(hit(g), 1).otherwise(0).cast("tinyint"))


def ones(bits: Column) -> Column:
    return F.size(F.filter(bits, lambda b: b == 1)).cast("bigint")


def dice(inter: Column, a: Column, b: Column) -> Column:
    return (inter * 2).cast("double") / ((a + b).cast("double") + EPSILON)


def iou(inter: Column, a: Column, b: Column) -> Column:
    return inter.cast("double") / ((a + b - inter).cast("double") + EPSILON)
