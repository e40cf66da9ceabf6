"""Publish a folder of images as inline messages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hydrolens.functions.text import UPLOAD_TYPES, iso_text
from hydrolens.operators.ordered import dense_index
from hydrolens.session import stage
from hydrolens.sources.messages import write_messages
from hydrolens.sources.objects import fetch_objects, list_objects


def folder_messages(spark: SparkSession, path: str, date: datetime | Column | None = None) -> DataFrame:
    """(key, filename, image, date, message_id, file_size) of the images directly in a folder, numbered from 0 by name.

    The numbers come from the listing alone, which holds every file, hidden and empty ones too. Each
    task then reads the files whose numbers it got, so file bytes are never exchanged.
    """
    types = r"\.(" + "|".join(UPLOAD_TYPES) + ")$"
    names = list_objects(spark, path).where(~F.contains("key", F.lit("/"))).where(F.rlike("key", F.lit(types)))
    ids = stage(dense_index(names.select("key"), ["key"], "message_id"), "message-ids")
    files = fetch_objects(ids, path, carry="message_id")
    stamp = F.current_timestamp() if date is None else date if isinstance(date, Column) else F.lit(date)
    return files.select(
        F.col("message_id").cast("string").alias("key"),
        F.col("key").alias("filename"),
        F.regexp_replace(F.base64("content"), r"\s", "").alias("image"),
        iso_text(stamp.cast("timestamp_ntz")).alias("date"),
        "message_id",
        F.octet_length("content").cast("bigint").alias("file_size"),
    )


def publish_folder(spark: SparkSession, path: str, sink: dict, date: datetime | Column | None = None) -> None:
    write_messages(folder_messages(spark, path, date), "key", sink)
