"""Value lists of the dashboard drop-downs. Fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VARIABLES: dict[str, list] = {
    "time_range": ["1h", "6h", "24h", "7d"],
    "water_level_threshold": [60, 70, 80, 90],
    "time_period": ["1 week", "1 month", "3 months", "1 year"],
    "price_threshold": [100, 200, 300, 400],
}


def variable_values(spark: SparkSession, name: str) -> DataFrame:
    """(text, value) rows of one variable."""
    values = VARIABLES[name]
    kind = "int" if isinstance(values[0], int) else "string"
    return spark.createDataFrame([(str(v), v) for v in values], f"text string, value {kind}")
