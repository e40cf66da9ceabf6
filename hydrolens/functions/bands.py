"""Value bands of the dashboards. Labels and limits are fixed values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def alert_status(coverage: Column) -> Column:
    return F.when(coverage > 80, "CRITICAL").when(coverage > 60, "WARNING").otherwise("NORMAL")


def confidence_band(confidence: Column) -> Column:
    return (
        F.when(confidence >= 0.9, "90-100%")
        .when(confidence >= 0.8, "80-90%")
        .when(confidence >= 0.7, "70-80%")
        .when(confidence >= 0.6, "60-70%")
        .otherwise("Below 60%")
    )


def price_band(price: Column) -> Column:
    return (
        F.when(price < 100, "Under $100")
        .when(price < 200, "$100-200")
        .when(price < 300, "$200-300")
        .when(price < 400, "$300-400")
        .otherwise("Over $400")
    )


def overflow(coverage: Column, threshold: float = 80) -> Column:
    return coverage > F.lit(float(threshold))


def percent_change(new: Column, old: Column) -> Column:
    """(new - old) / old * 100 as a double; NULL when the base is zero or missing."""
    new, old = new.cast("double"), old.cast("double")
    return F.try_divide(new - old, old) * 100
