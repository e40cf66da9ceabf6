"""Synthetic prediction rows for trials of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def mock_predictions(spark: SparkSession, n: int, seed: int = 0, start: str = "2024-01-01") -> DataFrame:
    """`n` rows in layout C, one per second. The same seed gives the same rows in any partitioning.

    Draws come from a hash of row number and column, not from a per-partition generator.
    """

    def draw(label: str) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(label), F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))

    def uniform(label: str, low: float, high: float) -> Column:
        return F.round(draw(label) * (high - low) + low, 2)

    def whole(label: str, low: int, high: int) -> Column:
        return (F.floor(draw(label) * (high - low + 1)) + low).cast("int")

    # The generator's ranges, its overflow limit and its locations.
    places = F.array(*[F.lit(p) for p in ("RiverA", "RiverB", "RiverC")])
    coverage = uniform("coverage", 10, 90)
    return spark.range(n).select(
        F.timestamp_seconds(F.unix_timestamp(F.lit(start).cast("timestamp")) + F.col("id")).cast("timestamp_ntz").alias("timestamp"),
        F.concat(F.lit("river_image_"), whole("name", 1000, 9999).cast("string"), F.lit(".jpg")).alias("image_name"),
        coverage.alias("water_coverage_pct"),
        uniform("confidence", 0.5, 1.0).alias("avg_confidence"),
        uniform("iou", 0.3, 0.9).alias("iou_score"),
        uniform("dice", 0.3, 0.9).alias("dice_score"),
        (coverage > 60).alias("overflow_detected"),
        whole("ms", 50, 500).alias("processing_time_ms"),
        F.lit("v1.0").alias("model_version"),
        F.get(places, whole("place", 0, 2)).alias("location"),
    )
