"""Statistics, evaluation and reports of scored images."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hydrolens.functions import pixels as px, raster
from hydrolens.functions.bands import overflow
from hydrolens.functions.text import fixed
from hydrolens.operators.imaging import BATCH_SIZE, preprocess, resize_back, result_pictures, truth_mask
from hydrolens.operators.ordered import dense_index
from hydrolens.operators.scoring import Factory, score
from hydrolens.session import staging
from hydrolens.sources.images import attach_truth, read_images
from hydrolens.sources.objects import write_objects


def prediction_stats(scored: DataFrame, threshold: float = 80) -> DataFrame:
    """Add water_coverage (%), avg_confidence (mean probability of all pixels) and overflow_detected."""
    coverage = F.try_divide(F.col("water_pixels"), F.col("pixels")) * 100
    return scored.withColumns(
        {
            "water_coverage": coverage,
            "avg_confidence": F.col("mean_probability"),
            "overflow_detected": overflow(coverage, threshold),
        }
    )


COUNTS = ["_inter", "_pred", "_true", "_equal", "_pixels"]
ARRAYS = {"mask", "truth_mask", "probabilities", "logits", "tensor", "image", "truth"}


def _overlap(scored: DataFrame) -> DataFrame:
    """Replace the pixel arrays by their counts, so that later shuffles carry numbers only.

    A frame that still has its logits is counted from them, which saves passing the mask around.
    """
    source = "logits" if "logits" in scored.columns else "mask"
    bits = (lambda x: raster.water(raster.probabilities(x))) if source == "logits" else (lambda x: np.asarray(x) == 1)

    @F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
    def count(mask: pd.Series, truth: pd.Series) -> pd.DataFrame:
        rows = []
        for m, t in zip(mask, truth):
            if m is None or t is None:
                rows.append([None] * len(COUNTS))
                continue
            m, t = bits(m), np.asarray(t) == 1
            rows.append([int((m & t).sum()), int(m.sum()), int(t.sum()), int((m == t).sum()), m.size])
        return pd.DataFrame(rows, columns=COUNTS, dtype="Int64")

    kept = [c for c in scored.columns if c not in ARRAYS]
    known = F.col("truth_mask").isNotNull().alias("has_ground_truth")
    return scored.select(*kept, known, count(source, "truth_mask").alias("_n")).select(*kept, "has_ground_truth", "_n.*")


def evaluate_images(scored: DataFrame) -> DataFrame:
    """Per image: dice_score, iou_score (NULL without truth) and has_ground_truth."""
    counted = _overlap(scored)
    sides = F.col("_inter"), F.col("_pred"), F.col("_true")
    truth = F.col("has_ground_truth")
    return counted.withColumns(
        {"dice_score": F.when(truth, px.dice(*sides)), "iou_score": F.when(truth, px.iou(*sides))}
    ).drop(*COUNTS)


def evaluation_summary(evaluated: DataFrame) -> DataFrame:
    """Mean Dice and IoU over the images that have truth."""
    return evaluated.agg(
        F.count("*").alias("images"),
        F.count_if("has_ground_truth").alias("images_with_truth"),
        F.avg("dice_score").alias("avg_dice"),
        F.avg("iou_score").alias("avg_iou"),
    )


def evaluate_batches(scored: DataFrame, key: str, batch_size: int = 32) -> DataFrame:
    """Pixel accuracy over all images, and Dice per batch of consecutive keys averaged over batches.

    The batch Dice pools the pixels of a batch, so it differs from the mean over images.
    """
    counted = _overlap(scored.where("truth_mask IS NOT NULL")).select(key, *COUNTS)
    batches = (
        dense_index(counted, [key], "_at", staged=True)
        .groupBy(F.floor(F.col("_at") / batch_size).alias("_batch"))
        .agg(*[F.sum(c).alias(c) for c in COUNTS])
    )
    return batches.agg(
        F.sum("_equal").alias("correct"),
        F.sum("_pixels").alias("pixels"),
        (F.try_divide(F.sum("_equal").cast("double"), F.sum("_pixels")) * 100).alias("accuracy_pct"),
        F.avg(px.dice(F.col("_inter"), F.col("_pred"), F.col("_true"))).alias("dice"),
    )


def split_counts(rows: int, train: float = 0.7, validation: float = 0.16, test: float = 0.14) -> dict[str, int]:
    """Exact sizes of the three parts: the held-out part and the test part round up.

    Plain double arithmetic on purpose: .16 + .14 is slightly above .3, and the sizes follow it.
    """
    held = math.ceil((validation + test) * rows)
    last = math.ceil(test / (validation + test) * held)
    return {"train": rows - held, "validation": held - last, "test": last}


def split_dataset(df: DataFrame, key: str, seed: int = 42, **ratios: float) -> DataFrame:
    """Add `part`: train, validation or test, with exact sizes and a repeatable membership.

    Rows are ordered by the MD5 of key and seed; the position in that order decides. `key` is unique.
    """
    # Only the key is ordered and shuffled; wide rows get their part by a join on it.
    keys = df.select(key).withColumn("_hash", F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))))
    sizes = split_counts(keys.count(), **ratios)
    at = dense_index(keys, ["_hash", key], "_at")
    first, second = sizes["train"], sizes["train"] + sizes["validation"]
    part = F.when(F.col("_at") < first, "train").when(F.col("_at") < second, "validation").otherwise("test")
    parts = at.select(key, part.alias("part"))
    return parts if df.columns == [key] else df.join(parts, key)


# The wording of the report's lines below, which other programs read.


def report_rows(results: DataFrame) -> DataFrame:
    """One text entry per image: (image, text)."""
    lines = [
        F.concat(F.lit("Image: "), F.col("image")),
        F.concat(F.lit("Water Coverage: "), fixed(F.col("water_coverage"), 1), F.lit("%")),
        F.concat(F.lit("Avg Confidence: "), fixed(F.col("avg_confidence"), 3)),
        F.when(F.col("has_ground_truth"), F.concat(F.lit("Dice Score: "), fixed(F.col("dice_score"), 3))),
        F.when(F.col("has_ground_truth"), F.concat(F.lit("IoU Score: "), fixed(F.col("iou_score"), 3))),
    ]
    return results.select("image", F.concat_ws("\n", *lines, F.lit("-" * 30)).alias("text"))


def report_head(results: DataFrame) -> DataFrame:
    """Title and averages as text; a single row. The averages are left out when no image has truth."""
    rule = "=" * 40 + "\n"
    averages = F.concat(
        F.format_string("Overall Performance (on %d images with ground truth):\n", "images_with_truth"),
        F.concat(F.lit("Average Dice Score: "), fixed(F.col("avg_dice"), 3), F.lit("\n")),
        F.concat(F.lit("Average IoU Score: "), fixed(F.col("avg_iou"), 3), F.lit("\n\n" + rule)),
    )
    title = F.lit("Water Segmentation Results Summary\n" + rule)
    return evaluation_summary(results).select(F.concat_ws("\n", title, averages).alias("text"))


def write_report(results: DataFrame, path: str) -> None:
    """results/ and summary/ as parquet, report/ as text: the averages, then one entry per image."""
    results.write.mode("overwrite").parquet(f"{path}/results")
    stored = results.sparkSession.read.parquet(f"{path}/results")
    evaluation_summary(stored).write.mode("overwrite").parquet(f"{path}/summary")
    entries = report_rows(stored).select("text", "image").unionByName(report_head(stored).withColumn("image", F.lit(None)))
    entries.orderBy(F.asc_nulls_first("image")).select("text").write.mode("overwrite").text(f"{path}/report")


# Fixed order in which a folder's files are taken; a later file replaces the results of an earlier one.
FOLDER_ORDER = ["jpg", "JPG", "jpeg", "JPEG", "png", "PNG", "bmp", "BMP", "tiff", "TIFF"]


def _last_of_each_base(scored: DataFrame) -> DataFrame:
    """One row per base name. Names are compared alone, and pixels only move where a name occurs twice."""
    place = F.array_position(F.array(*[F.lit(t) for t in FOLDER_ORDER]), F.substring_index("path", ".", -1))
    names = scored.select("base", "path", place.alias("_place")).groupBy("base")
    last = names.agg(F.count("*").alias("_n"), F.max_by("path", F.struct("_place", "path")).alias("_last")).where("_n > 1")
    if not last.limit(1).count():
        return scored
    return scored.join(last, "base", "left").where("_last IS NULL OR path = _last").drop("_n", "_last")


def score_folder(
    spark: SparkSession,
    folder: str,
    output: str,
    factory: Factory,
    masks: str | None = None,
    size: tuple[int, int] = BATCH_SIZE,
    model: str = "model",
) -> DataFrame:
    """Batch scoring: pictures and a report for every readable image of a folder.

    Results are brought back to each image's own size before the statistics. Of images with one base
    name the last by extension counts (FOLDER_ORDER). Truth, where a mask of the same base name
    exists, adds Dice and IoU. Pictures go to `output`, the report below
    `output`/summary. Returns the per-image results.
    """
    height, width = size
    tensors = preprocess(read_images(spark, folder, valid_only=True), size)
    scored = score(tensors, factory, "tensor", [height, width, 3], model).drop("tensor")
    back = resize_back(scored.withColumns({"height": F.lit(height), "width": F.lit(width)}))
    if masks:
        back = truth_mask(attach_truth(back, read_images(spark, masks)))
    else:
        back = back.withColumn("truth_mask", F.lit(None).cast("array<tinyint>"))
    with staging(spark) as keep:
        # The model runs once; pictures and metrics both read the stored result.
        ready = _last_of_each_base(keep(prediction_stats(back), "scored"))
        write_objects(result_pictures(ready), output)
        results = evaluate_images(ready).select(
            F.col("base").alias("image"), "water_coverage", "avg_confidence", "dice_score", "iou_score", "has_ground_truth"
        )
        write_report(results, f"{output}/summary")
    return spark.read.parquet(f"{output}/summary/results")
