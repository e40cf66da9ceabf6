"""Upsert by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest_per_key(updates: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """One row per key: the one with the highest sequence. Combines before the shuffle."""
    rest = [c for c in updates.columns if c not in keys]
    return (
        updates.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*sequence)).alias("_row"))
        .select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])
    )


def upsert_rows(target: DataFrame, updates: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """Target rows whose key is not updated, plus the last update of each key."""
    newest = latest_per_key(updates, keys, sequence).select(*target.columns)
    return target.join(newest.select(*keys), keys, "left_anti").select(*target.columns).unionByName(newest)
