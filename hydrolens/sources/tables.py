"""Tables: by catalog name, JDBC or path. The schema comes from the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str, jdbc: dict | None = None) -> DataFrame:
    """A JDBC table when connection options are given, a parquet folder for a path, else a catalog table.

    For a large JDBC table pass partitionColumn, lowerBound, upperBound and numPartitions too.
    """
    if jdbc:
        return spark.read.format("jdbc").options(dbtable=name, **jdbc).load()
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def append_rows(df: DataFrame, name: str, jdbc: dict | None = None, partition_by: list[str] | None = None) -> None:
    """Append one or many rows."""
    if jdbc:
        df.write.format("jdbc").options(dbtable=name, **jdbc).mode("append").save()
        return
    writer = df.write.mode("append").format("parquet").partitionBy(*(partition_by or []))
    writer.save(name) if "/" in name else writer.saveAsTable(name)
