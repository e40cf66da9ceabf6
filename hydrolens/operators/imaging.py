"""Pixel work on image rows: preparing, resizing, colouring, augmenting.

Every function adds columns to a frame with Spark `image` structs or flat pixel arrays. The pixel
loops are numpy inside Arrow batches; Arrow batches are limited by bytes, so an image larger than
usual only makes a batch of fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from hydrolens.functions import raster

FLOATS = T.ArrayType(T.FloatType())
BYTES = T.ArrayType(T.ShortType())

# Input sizes of the live and the batch path.
LIVE_SIZE = (512, 512)
BATCH_SIZE = (384, 384)

PART_BYTES = 4_000_000


def _rgb(image: pd.DataFrame) -> list[np.ndarray | None]:
    """Decoded rows as RGB arrays, None for a missing row or one that did not decode."""
    # A batch with missing rows has its sizes as floats.
    columns = zip(image["data"], image["height"], image["width"], image["nChannels"])
    return [raster.from_spark(d, int(h), int(w), int(c)) if d is not None and h > 0 else None for d, h, w, c in columns]


def _grid(flat, height: int, width: int, dtype) -> np.ndarray:
    return np.asarray(flat, dtype).reshape(height, width)


def part_rows(size: tuple[int, int], most: int = PART_BYTES) -> int:
    """Rows whose RGB tensors of a size take about `most` bytes."""
    return max(1, most // (12 * size[0] * size[1]))


def preprocess(images: DataFrame, size=BATCH_SIZE, mean=raster.MEAN, std=raster.STD, name: str = "tensor") -> DataFrame:
    """Add the model input: resized, RGB, scaled to 0..1 and normalised; flat, row by row.

    A batch of small pictures may hold far larger tensors, so these leave in parts of about PART_BYTES.
    """
    most = part_rows(size)

    @F.pandas_udf(FLOATS)
    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            for start in range(0, len(batch), most):
                images = _rgb(batch[start : start + most])
                yield pd.Series([None if x is None else raster.normalise(raster.resize(x, *size), mean, std).ravel() for x in images], dtype=object)

    return images.withColumn(name, prepare("image"))


def resize_back(scored: DataFrame, rethreshold: bool = False) -> DataFrame:
    """Bring `probabilities` and `mask` (height x width) to the size of `image`, with new totals.

    The mask is resized as whole numbers. With `rethreshold` it is cut at one half again, as the
    single-image path does; the batch path does not.
    """
    totals = [T.StructField("pixels", T.LongType()), T.StructField("water", T.LongType()), T.StructField("mean", T.DoubleType())]
    out = T.StructType([T.StructField("p", FLOATS), T.StructField("m", T.ArrayType(T.ByteType())), *totals])

    @F.pandas_udf(out)
    def back(p: pd.Series, m: pd.Series, h: pd.Series, w: pd.Series, th: pd.Series, tw: pd.Series) -> pd.DataFrame:
        rows = []
        for probs, bits, height, width, to_h, to_w in zip(p, m, h, w, th, tw):
            if probs is None or not to_h > 0:
                rows.append((None,) * 5)
                continue
            height, width, to_h, to_w = int(height), int(width), int(to_h), int(to_w)
            probs = raster.resize(_grid(probs, height, width, np.float32), to_h, to_w)
            bits = raster.resize(_grid(bits, height, width, np.uint8), to_h, to_w)
            bits = (bits > 0.5).astype(np.uint8) if rethreshold else bits
            mean = float(probs.mean(dtype=np.float64))
            rows.append((probs.ravel(), bits.astype(np.int8).ravel(), bits.size, int(bits.sum()), mean))
        return pd.DataFrame(rows, columns=out.names)

    both = back("probabilities", "mask", "height", "width", "image.height", "image.width")
    return (
        scored.withColumn("_both", both)
        .withColumns(
            {
                "probabilities": F.col("_both.p"),
                "mask": F.col("_both.m"),
                "pixels": F.col("_both.pixels"),
                "water_pixels": F.col("_both.water"),
                "mean_probability": F.col("_both.mean"),
                "height": F.col("image.height"),
                "width": F.col("image.width"),
            }
        )
        .drop("_both", "logits")  # logits of the old size would no longer belong to the row
    )


# The folders of the four artefacts.
ARTEFACTS = ("originals", "predictions", "confidence_maps", "overlay")


def draw_artefacts(scored: DataFrame, size=LIVE_SIZE, name: str = "png") -> DataFrame:
    """Add the four PNG pictures of an image as one struct.

    originals: the image at model size; predictions: the mask; confidence_maps: the probabilities;
    overlay: 40 % green over the water. Mask and probabilities have that size.
    """
    kinds = T.StructType([T.StructField(k, T.BinaryType()) for k in ARTEFACTS])

    @F.pandas_udf(kinds)
    def draw(image: pd.DataFrame, p: pd.Series, m: pd.Series) -> pd.DataFrame:
        rows = []
        for rgb, probs, bits in zip(_rgb(image), p, m):
            if rgb is None or probs is None:
                rows.append((None,) * 4)
                continue
            base = raster.resize(rgb, *size)
            probs, bits = _grid(probs, *size, np.float32), _grid(bits, *size, np.uint8)
            # The overlay truncates, as integer conversion of the blend does.
            tinted = (base * 0.6 + np.array([0, 255, 0]) * 0.4).astype(np.uint8)
            overlay = np.where(bits[:, :, None] == 1, tinted, base)
            rows.append(
                (raster.png(base), raster.png(bits * 255), raster.png((probs * 255).astype(np.uint8)), raster.png(overlay))
            )
        return pd.DataFrame(rows, columns=kinds.names)

    return scored.withColumn(name, draw("image", "probabilities", "mask"))


def artefact_objects(drawn: DataFrame, name: str = "filename", png: str = "png") -> DataFrame:
    """One object per picture: (key, content, content_type), the key made of folder and file name."""
    items = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{png}.{k}").alias("content")) for k in ARTEFACTS])
    return (
        drawn.select(F.col(name).alias("_name"), F.explode(items).alias("_item"))
        .where("_item.content IS NOT NULL")
        .select(
            F.concat_ws("/", "_item.kind", "_name").alias("key"),
            F.col("_item.content").alias("content"),
            F.lit("image/png").alias("content_type"),
        )
    )


# Overlay styles. A style with truth paints prediction blue, truth red and their
# overlap green at .4; the others tint the predicted water only.
STYLES = {
    "comparison": {"alpha": 0.4},
    "blue": {"alpha": 0.3, "colour": (0, 100, 255)},
    "deep_blue": {"alpha": 0.4, "colour": (0, 0, 255), "black": True},
    "green": {"alpha": 0.3, "colour": (0, 255, 0)},
}


def composite(df: DataFrame, style: str = "comparison", name: str = "composite") -> DataFrame:
    """Add a PNG of `image` with `mask` (and `truth_mask` for 'comparison') drawn over it.

    Masks have the size of the image. A comparison without truth falls back to 'blue'.
    """
    if style not in STYLES:
        raise ValueError(f"style is one of {sorted(STYLES)}, not {style!r}")

    def one(rgb: np.ndarray, bits, truth) -> bytes:
        chosen = "blue" if style == "comparison" and truth is None else style
        spec, water = STYLES[chosen], _grid(bits, *rgb.shape[:2], np.uint8) == 1
        if chosen == "comparison":
            real = _grid(truth, *rgb.shape[:2], np.uint8) == 1
            top = raster.paint(rgb.shape, (water, (0, 0, 255)), (real, (255, 0, 0)), (water & real, (0, 255, 0)))
        elif spec.get("black"):
            top = raster.paint(rgb.shape, (water, spec["colour"]))
        else:
            top = np.where(water[:, :, None], np.array(spec["colour"], np.uint8), rgb)
        return raster.png(raster.blend(rgb, top, spec["alpha"]))

    @F.pandas_udf(T.BinaryType())
    def draw(image: pd.DataFrame, m: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series(
            [None if rgb is None else one(rgb, bits, truth) for rgb, bits, truth in zip(_rgb(image), m, t)], dtype=object
        )

    truth: Column = F.col("truth_mask") if "truth_mask" in df.columns else F.lit(None).cast("array<tinyint>")
    return df.withColumn(name, draw("image", "mask", truth))


def result_pictures(df: DataFrame, base: str = "base") -> DataFrame:
    """Objects of the batch path: {base}_mask.png, {base}_confidence.png, and {base}_comparison.png
    for an image with truth or {base}_overlay.png for one without."""
    kinds = T.StructType([T.StructField(k, T.BinaryType()) for k in ("mask", "confidence")])

    @F.pandas_udf(kinds)
    def draw(p: pd.Series, m: pd.Series, h: pd.Series, w: pd.Series) -> pd.DataFrame:
        rows = [
            (
                raster.png(_grid(bits, height, width, np.uint8) * 255),
                raster.png((_grid(probs, height, width, np.float32) * 255).astype(np.uint8)),
            )
            for probs, bits, height, width in zip(p, m, h, w)
        ]
        return pd.DataFrame(rows, columns=kinds.names)

    known = F.col("truth_mask").isNotNull() if "truth_mask" in df.columns else F.lit(False)
    drawn = composite(df.withColumn("_png", draw("probabilities", "mask", "height", "width")))
    items = F.array(
        F.struct(F.lit("_mask.png").alias("kind"), F.col("_png.mask").alias("content")),
        F.struct(F.lit("_confidence.png").alias("kind"), F.col("_png.confidence").alias("content")),
        F.struct(F.when(known, "_comparison.png").otherwise("_overlay.png").alias("kind"), F.col("composite").alias("content")),
    )
    return drawn.select(F.col(base).alias("_base"), F.explode(items).alias("_item")).select(
        F.concat("_base", "_item.kind").alias("key"), F.col("_item.content").alias("content")
    )


def truth_mask(df: DataFrame, rule: str = "above_127", name: str = "truth_mask") -> DataFrame:
    """Add the 0/1 mask of `truth`, resized to `image`; NULL without truth."""

    @F.pandas_udf(T.ArrayType(T.ByteType()))
    def convert(image: pd.DataFrame, truth: pd.DataFrame) -> pd.Series:
        rows = []
        for rgb, height, width in zip(_rgb(truth), image["height"], image["width"]):
            if rgb is None or height <= 0:
                rows.append(None)
                continue
            shade = raster.resize(raster.grey(rgb), int(height), int(width))
            rows.append((shade > 127 if rule == "above_127" else shade == 255).astype(np.int8).ravel())
        return pd.Series(rows, dtype=object)

    return df.withColumn(name, convert("image", "truth"))


def denormalise(df: DataFrame, tensor: str = "tensor", name: str = "pixels") -> DataFrame:
    """Add the displayable 0..255 RGB values of a normalised tensor (truncated)."""

    @F.pandas_udf(BYTES)
    def undo(t: pd.Series) -> pd.Series:
        return pd.Series(
            [None if x is None else raster.denormalise(np.asarray(x, np.float64).reshape(-1, 3)).astype(np.int16).ravel() for x in t],
            dtype=object,
        )

    return df.withColumn(name, undo(tensor))


# Augmentation chances and limits.
AUGMENT = {
    "rotate": (0.7, 20.0),
    "flip_lr": 0.5,
    "flip_ud": 0.1,
    "light": (0.5, 0.2, 0.2),
    "hue": (0.5, 10, 15, 10),
    "gamma": (0.3, 0.8, 1.2),
    "blur": (0.2, 3),
}


def augment(pairs: DataFrame, key: str, seed: int = 42, copies: int = 1) -> DataFrame:
    """`copies` varied versions of each (image, truth_mask) row, as flat RGB `pixels` and `truth_mask`.

    The random draws of a row depend on its key, the copy number and the seed alone, so a retried
    task and a later run give the same pixels. Image and mask share the geometry; colour changes
    touch the image only.
    """
    out = T.StructType([T.StructField("pixels", BYTES), T.StructField("truth_mask", T.ArrayType(T.ByteType()))])

    @F.pandas_udf(out)
    def vary(image: pd.DataFrame, truth: pd.Series, draw: pd.Series) -> pd.DataFrame:
        rows = []
        for rgb, bits, number in zip(_rgb(image), truth, draw):
            if rgb is None or bits is None:
                rows.append((None, None))
                continue
            grid = _grid(bits, *rgb.shape[:2], np.uint8)
            rgb, grid = vary_one(rgb, grid, np.random.default_rng(number & 0xFFFFFFFFFFFFFFFF))
            rows.append((rgb.astype(np.int16).ravel(), grid.astype(np.int8).ravel()))
        return pd.DataFrame(rows, columns=["pixels", "truth_mask"])

    copied = pairs.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    varied = vary("image", "truth_mask", F.xxhash64(F.col(key).cast("string"), "copy", F.lit(seed)))
    return copied.withColumn("_v", varied).select(
        key, "copy", F.col("image.height").alias("height"), F.col("image.width").alias("width"), "_v.pixels", "_v.truth_mask"
    )


def vary_one(rgb: np.ndarray, bits: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """One random variant. Every draw is made whether used or not, so the chances are independent."""
    draws = rng.random(16)
    chance, limit = AUGMENT["rotate"]
    if draws[0] < chance:
        rgb, bits = rotate(rgb, bits, (draws[1] * 2 - 1) * limit)
    if draws[2] < AUGMENT["flip_lr"]:
        rgb, bits = rgb[:, ::-1], bits[:, ::-1]
    if draws[3] < AUGMENT["flip_ud"]:
        rgb, bits = rgb[::-1], bits[::-1]
    value = rgb.astype(np.float64)
    chance, contrast, brightness = AUGMENT["light"]
    if draws[4] < chance:
        value = value * (1 + (draws[5] * 2 - 1) * contrast) + (draws[6] * 2 - 1) * brightness * 255
    value = value.clip(0, 255)
    chance, hue, saturation, light = AUGMENT["hue"]
    if draws[7] < chance:
        value = shift_colour(value, *[(d * 2 - 1) * lim for d, lim in zip(draws[8:11], (hue, saturation, light))])
    chance, low, high = AUGMENT["gamma"]
    if draws[11] < chance:
        value = (value / 255) ** (low + draws[12] * (high - low)) * 255
    chance, width = AUGMENT["blur"]
    if draws[13] < chance:
        weights = np.ones(width) if draws[14] < 0.5 else np.array([1.0, 2.0, 1.0])
        value = smooth(value, weights / weights.sum())
    return np.rint(value).clip(0, 255).astype(np.uint8), bits


def rotate(rgb: np.ndarray, bits: np.ndarray, degrees: float) -> tuple[np.ndarray, np.ndarray]:
    """Rotate about the centre; pixels from outside are mirrored in. Nearest pixel for both."""
    height, width = bits.shape
    angle = np.deg2rad(degrees)
    y, x = np.mgrid[:height, :width]
    cy, cx = (height - 1) / 2, (width - 1) / 2
    fy = np.rint(cy + (y - cy) * np.cos(angle) - (x - cx) * np.sin(angle)).astype(int)
    fx = np.rint(cx + (y - cy) * np.sin(angle) + (x - cx) * np.cos(angle)).astype(int)
    fy, fx = mirror(fy, height), mirror(fx, width)
    return rgb[fy, fx], bits[fy, fx]


def mirror(at: np.ndarray, size: int) -> np.ndarray:
    """Positions outside 0..size-1 reflected back without repeating the edge."""
    if size == 1:
        return np.zeros_like(at)
    folded = np.abs(at) % (2 * size - 2)
    return np.where(folded < size, folded, 2 * size - 2 - folded)


def smooth(value: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Separable blur with mirrored edges."""
    reach = len(weights) // 2
    for axis in (0, 1):
        size = value.shape[axis]
        value = sum(w * value.take(mirror(np.arange(size) + k - reach, size), axis=axis) for k, w in enumerate(weights))
    return value


def shift_colour(rgb: np.ndarray, hue: float, saturation: float, light: float) -> np.ndarray:
    """Shift hue (half degrees, 0..180), saturation and value (0..255) of an RGB image."""
    top, low = rgb.max(axis=2), rgb.min(axis=2)
    span = top - low
    safe = np.where(span > 0, span, 1)
    r, g, b = np.moveaxis(rgb, 2, 0)
    angle = np.select([top == r, top == g], [(g - b) / safe % 6, (b - r) / safe + 2], (r - g) / safe + 4)
    angle = (np.where(span > 0, angle, 0) + hue / 30) % 6
    sat = (np.where(top > 0, span / np.where(top > 0, top, 1), 0) + saturation / 255).clip(0, 1)
    value = (top + light).clip(0, 255)
    # Each channel falls off with its distance from the hue.
    k = (np.stack([angle + 5, angle + 3, angle + 1], axis=2)) % 6
    return value[:, :, None] * (1 - sat[:, :, None] * np.minimum(k, 4 - k).clip(0, 1))
