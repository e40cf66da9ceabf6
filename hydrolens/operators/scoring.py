"""Models behind a plug: any function from a batch of inputs to a batch of logits.

A scorer factory is called once per Python worker and returns predict(batch) -> logits, so a model
is loaded once and fed whole batches.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, predict_batch_udf
from pyspark.sql import DataFrame, functions as F, types as T

from hydrolens.functions import raster
from hydrolens.session import stage

Factory = Callable[[], Callable[[np.ndarray], np.ndarray]]


PROBABILITIES, MASK = T.ArrayType(T.FloatType()), T.ArrayType(T.ByteType())
TOTALS = T.StructType(
    [
        T.StructField("pixels", T.LongType()),
        T.StructField("water_pixels", T.LongType()),
        T.StructField("mean_probability", T.DoubleType()),
    ]
)


def score(df: DataFrame, factory: Factory, inputs: str, shape: list[int], model: str, batch: int = 32) -> DataFrame:
    """Add probabilities, mask, the columns of TOTALS and model_name. `shape` is that of one input row.

    Sigmoid, threshold and totals are done beside the model, where the pixels are numpy already.
    """
    maps = T.StructType([T.StructField("probabilities", PROBABILITIES), T.StructField("mask", MASK), *TOTALS.fields])

    def wrapped():
        predict = factory()

        def run(rows: np.ndarray) -> dict[str, np.ndarray]:
            p = raster.probabilities(np.asarray(predict(rows)).reshape(len(rows), -1))
            m = raster.water(p)
            totals = zip(TOTALS.names, (np.full(len(p), p.shape[1]), m.sum(axis=1), p.mean(axis=1)))
            return {"probabilities": p.astype(np.float32), "mask": m.astype(np.int8), **dict(totals)}

        return run

    predict = predict_batch_udf(wrapped, return_type=maps, batch_size=batch, input_tensor_shapes=[shape])
    unpacked = {name: F.col(f"_maps.{name}") for name in maps.names}
    return df.withColumn("_maps", predict(inputs)).withColumns(unpacked).drop("_maps").withColumn("model_name", F.lit(model))


def with_probabilities(df: DataFrame) -> DataFrame:
    """Add probabilities, mask and the columns of TOTALS from stored `logits` of any size.

    Arrow functions and not array expressions, which take several times as long at 512 x 512. Each
    result is a function of its own: what a report does not use is not computed, and a function
    on top of one of them runs in the same Python step.
    """

    @F.pandas_udf(PROBABILITIES)
    def probabilities(logits: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else raster.probabilities(x).astype(np.float32) for x in logits], dtype=object)

    @F.pandas_udf(MASK)
    def mask(logits: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else raster.water(raster.probabilities(x)).astype(np.int8) for x in logits], dtype=object)

    @F.pandas_udf(TOTALS)
    def totals(logits: pd.Series) -> pd.DataFrame:
        rows = []
        for x in logits:
            p = None if x is None else raster.probabilities(x)
            rows.append((None,) * 3 if p is None else (p.size, int(raster.water(p).sum()), float(p.mean())))
        return pd.DataFrame(rows, columns=TOTALS.names)

    added = df.withColumns({"probabilities": probabilities("logits"), "mask": mask("logits"), "_totals": totals("logits")})
    return added.withColumns({name: F.col(f"_totals.{name}") for name in TOTALS.names}).drop("_totals")


def stored_logits() -> Callable[[np.ndarray], np.ndarray]:
    """Scorer for rows that carry their logits already."""
    return lambda batch: batch


def pixel_scorer(weights: list[float], bias: float) -> Factory:
    """Scorer of a fitted per-pixel linear model over normalised RGB tensors, in double precision."""

    def factory():
        w = np.asarray(weights, np.float64)
        return lambda batch: batch.reshape(batch.shape[0], -1, len(w)).astype(np.float64) @ w + bias

    return factory


PIXELS_PER_IMAGE = 16_384


def pixel_rows(pairs: DataFrame, key: str, most: int | None = PIXELS_PER_IMAGE) -> DataFrame:
    """One row per labelled pixel: key, features (vector), label.

    `most` bounds the pixels taken from an image: evenly spaced ones, all if there are no more. None
    takes all.
    """
    channels = F.expr("size(tensor) div size(truth_mask)")
    step = F.lit(1) if most is None else F.greatest(F.lit(1), F.ceil(F.size("truth_mask") / most)).cast("int")
    spots = F.transform(F.sequence(F.lit(0), F.size("truth_mask") - 1, step), lambda i: F.struct(i.alias("at"), F.get("truth_mask", i).alias("label")))
    each = pairs.where("size(truth_mask) > 0").select(key, "tensor", channels.alias("_c"), F.explode(spots).alias("_spot"))
    each = each.select(key, "tensor", "_c", F.col("_spot.at").alias("_at"), F.col("_spot.label").alias("label"))
    features = F.slice("tensor", F.col("_at") * F.col("_c") + 1, F.col("_c"))
    return each.select(key, array_to_vector(features.cast("array<double>")).alias("features"), F.col("label").cast("double"))


def fit_pixel_scorer(train: DataFrame, validation: DataFrame, key: str, grid: list[float], most: int | None = PIXELS_PER_IMAGE) -> dict:
    """Fit a logistic pixel model per regularisation value; keep the best by mean Dice on validation.

    Rows need `tensor` and `truth_mask` of equal pixel count; `most` bounds the labelled pixels that
    each image gives to the fit. They are written once and read for every value. This replaces network
    training by a distributed fit under the same loss; its quality is not that of a network.
    """
    from pyspark.ml.classification import LogisticRegression

    from hydrolens.plans.scoring import evaluate_images

    pixels = stage(pixel_rows(train, key, most), "labelled-pixels")
    best: dict = {"dice": -math.inf}
    for strength in grid:
        model = LogisticRegression(regParam=strength, maxIter=30).fit(pixels)
        weights, bias = [float(w) for w in model.coefficients], float(model.intercept)
        scored = score_pixels(validation, weights, bias)
        got = evaluate_images(scored).agg(F.avg("dice_score").alias("d")).first().d
        if got is not None and got > best["dice"]:
            best = {"dice": got, "reg": strength, "weights": weights, "bias": bias}
    return best


def score_pixels(df: DataFrame, weights: list[float], bias: float) -> DataFrame:
    """A linear pixel model on tensors of any size."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def logits(tensor: pd.Series) -> pd.Series:
        w = np.asarray(weights)
        return pd.Series([None if t is None else np.asarray(t).reshape(-1, len(w)) @ w + bias for t in tensor], dtype=object)

    return with_probabilities(df.withColumn("logits", logits("tensor")))
