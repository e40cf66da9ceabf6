"""Shared steps of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, most: str = "8m") -> None:
    """Texts go to the Python workers in batches of about `most`, however long they are, unless the session names a bound itself.

    A batch lies in the JVM, on the way and in the worker at once, and its buffer doubles as it grows.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, most)


def map_rows(df: DataFrame, rows: Callable[[Iterator[dict]], Iterable[dict]], schema: str, most: int = 512, taken: int = 512) -> DataFrame:
    """`rows` over each task's rows as dictionaries, in Arrow batches and as a stream.

    Only one incoming batch (`taken` rows of it as dictionaries) and `most` outgoing rows are held at a time.
    """
    kind = _parse_datatype_string(schema)
    assert isinstance(kind, StructType)
    bounded_batches(df.sparkSession)
    arrow = to_arrow_schema(kind, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for row in rows(row for batch in batches for row in _rows(batch, taken)):
            held.append(row)
            if len(held) >= most:
                yield pa.RecordBatch.from_pylist(held, schema=arrow)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=arrow)

    return df.mapInArrow(run, kind)


def _rows(batch: pa.RecordBatch, size: int) -> Iterator[dict]:
    names = batch.schema.names
    for start in range(0, batch.num_rows, size):
        columns = [column.to_pylist() for column in batch.slice(start, size).columns]
        for values in zip(*columns):
            yield dict(zip(names, values))
