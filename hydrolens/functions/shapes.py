"""The four prediction layouts in use, and the canonical one that joins them.

Layout A feeds the dashboards, B is written by the stream job, C by the single-image job and D by
the inference job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hydrolens.schemas import PREDICTIONS

# layout column -> canonical column
SHAPES: dict[str, dict[str, str]] = {
    "A": {
        "timestamp": "timestamp",
        "image_id": "image_id",
        "image_url": "image_url",
        "water_coverage_percent": "water_coverage",
        "confidence_score": "avg_confidence",
        "processing_time_ms": "processing_time_ms",
        "model_version": "model_version",
    },
    "B": {
        "timestamp": "timestamp",
        "model_name": "model_name",
        "filename": "filename",
        "water_coverage": "water_coverage",
        "avg_confidence": "avg_confidence",
        "overflow_detected": "overflow_detected",
        "location": "location",
    },
    "C": {
        "timestamp": "timestamp",
        "image_name": "filename",
        "water_coverage_pct": "water_coverage",
        "avg_confidence": "avg_confidence",
        "iou_score": "iou_score",
        "dice_score": "dice_score",
        "overflow_detected": "overflow_detected",
        "processing_time_ms": "processing_time_ms",
        "model_version": "model_version",
        "location": "location",
    },
}
SHAPES["D"] = {k: v for k, v in SHAPES["C"].items() if k not in ("iou_score", "dice_score")}

# Values written where the layout wants one and the row has none.
PLACEHOLDERS = {
    "B": {"location": "unknown"},
    "C": {
        "iou_score": 0.0,
        "dice_score": 0.0,
        "overflow_detected": False,
        "processing_time_ms": 0,
        "model_version": "unet++",
        "location": "unknown",
    },
    "D": {},
    "A": {},
}


def from_shape(df: DataFrame, shape: str) -> DataFrame:
    """Any layout -> canonical; absent columns are typed NULLs. Columns already canonical pass."""
    source = {canonical: name for name, canonical in SHAPES[shape].items()}
    return df.select(
        *[
            F.col(source[f.name] if f.name in source else f.name).cast(f.dataType).alias(f.name)
            if source.get(f.name, f.name) in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in PREDICTIONS.fields
        ]
    )


def as_shape(df: DataFrame, shape: str) -> DataFrame:
    """Canonical -> one layout, with its placeholders."""
    fill = PLACEHOLDERS[shape]
    return df.select(
        *[
            (F.coalesce(F.col(c), F.lit(fill[name])) if name in fill else F.col(c)).alias(name)
            for name, c in SHAPES[shape].items()
        ]
    )
