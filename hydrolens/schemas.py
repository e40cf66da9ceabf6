"""Fixed schemas of the tables, messages and records."""

from __future__ import annotations

from pyspark.sql import types as T


# Canonical prediction row: the union of the four shapes found in use.
PREDICTIONS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("image_id", T.LongType()),
        T.StructField("filename", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("model_name", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("water_coverage", T.DoubleType()),
        T.StructField("avg_confidence", T.DoubleType()),
        T.StructField("iou_score", T.DoubleType()),
        T.StructField("dice_score", T.DoubleType()),
        T.StructField("overflow_detected", T.BooleanType()),
        T.StructField("processing_time_ms", T.LongType()),
        T.StructField("location", T.StringType()),
    ]
)

# Both message forms in one schema: inline `image` (base64 text) or `image_link` (object key).
MESSAGE = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("image", T.StringType()),
        T.StructField("image_link", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("message_id", T.LongType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("location", T.StringType()),
        T.StructField("processing_time_ms", T.LongType()),
        T.StructField("model_version", T.StringType()),
    ]
)
