"""Scored images: the vectors are 8x8 logit maps, the truth is the sign of the following vector."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hydrolens.catalog.registry import register
from hydrolens.functions import pixels as px, raster
from hydrolens.operators import imaging, scoring
from hydrolens.plans import scoring as s
from hydrolens.session import stage, stage_path
from hydrolens.sources import fixtures as fx
from hydrolens.sources.images import attach_truth
from hydrolens.sources.messages import read_messages
from hydrolens.sources.objects import write_objects
from hydrolens.streaming import jobs

# 8x8 pictures from the vectors: grey level by value, blue brighter and red darker.
PICTURE_SQL = """
, level AS (SELECT key, i, CAST(least(greatest(floor(CAST(x AS DOUBLE) * 400) + 128, 0), 255) AS BIGINT) AS v FROM pixels)
"""


def _level(v):
    return F.least(F.greatest(F.floor(v.cast("double") * 400) + 128, F.lit(0)), F.lit(255))


def _pictures(spark, sf):
    """Images in the layout of Spark's image source (BGR)."""
    hexes = F.transform("logits", lambda v: F.lpad(F.hex(_level(v)), 2, "0"))
    bright = F.transform("logits", lambda v: F.lpad(F.hex(F.least(_level(v) + 20, F.lit(255))), 2, "0"))
    dark = F.transform("logits", lambda v: F.lpad(F.hex(F.greatest(_level(v) - 20, F.lit(0))), 2, "0"))
    join = lambda a, b: F.concat(a, b)
    triples = F.zip_with(F.zip_with(bright, hexes, join), dark, join)
    image = F.struct(
        F.concat(F.lit("mem/img_"), F.col("key").cast("string")).alias("origin"),
        F.lit(8).alias("height"),
        F.lit(8).alias("width"),
        F.lit(3).alias("nChannels"),
        F.lit(16).alias("mode"),
        F.unhex(F.array_join(triples, "")).alias("data"),
    )
    return fx.logit_maps(spark, sf).select("key", "height", "width", "logits", image.alias("image"))


def _scored(spark, sf):
    return scoring.with_probabilities(fx.logit_maps(spark, sf))


def _with_truth(spark, sf):
    truth = fx.truth_maps(spark, sf).select("key", px.binarise(F.col("truth")).alias("truth_mask"))
    return _scored(spark, sf).join(truth, "key", "left")


def _stats_sql(threshold):
    return f"""SELECT key, round(sum(CASE WHEN p > 0.5 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) * 100, 8) AS water_coverage,
  round(sum(p) / count(*), 8) AS avg_confidence,
  sum(CASE WHEN p > 0.5 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) * 100 > {threshold} AS overflow_detected
FROM scored GROUP BY key"""


STATS = ("key", "water_coverage", "avg_confidence", "overflow_detected")


@register("prediction_statistics", _stats_sql(80), ("pixels",))
def _(spark, sf):
    return s.prediction_stats(_scored(spark, sf)).select(*STATS)


@register("prediction_statistics_60", _stats_sql(60), ("pixels",))
def _(spark, sf):
    return s.prediction_stats(_scored(spark, sf), threshold=60).select(*STATS)


@register("scored_by_plugin", _stats_sql(80), ("pixels",))
def _(spark, sf):
    scored = scoring.score(fx.logit_maps(spark, sf), scoring.stored_logits, "logits", [64], "stored", batch=64)
    return s.prediction_stats(scored).select(*STATS)


OVERLAP = """
, sides AS (
  SELECT a.key, CASE WHEN a.p > 0.5 THEN 1 ELSE 0 END AS m, CASE WHEN b.x > 0 THEN 1 ELSE 0 END AS t, b.key IS NOT NULL AS known
  FROM scored a LEFT JOIN pixels b ON b.key = a.key + 1 AND b.i = a.i),
sums AS (
  SELECT key, bool_and(known) AS known, CAST(sum(m * t) AS BIGINT) AS inter, CAST(sum(m) AS BIGINT) AS pm, CAST(sum(t) AS BIGINT) AS tm,
    CAST(sum(CASE WHEN m = t THEN 1 ELSE 0 END) AS BIGINT) AS eq, count(*) AS px
  FROM sides GROUP BY key),
evaluated AS (
  SELECT key, known AS has_ground_truth,
    CASE WHEN known THEN CAST(2 * inter AS DOUBLE) / (CAST(pm + tm AS DOUBLE) + CAST(1e-8 AS DOUBLE)) END AS dice_score,
    CASE WHEN known THEN CAST(inter AS DOUBLE) / (CAST(pm + tm - inter AS DOUBLE) + CAST(1e-8 AS DOUBLE)) END AS iou_score
  FROM sums)
"""


@register(
    "evaluate_images",
    OVERLAP + "SELECT key, has_ground_truth, round(dice_score, 8) AS dice_score, round(iou_score, 8) AS iou_score FROM evaluated",
    ("pixels",),
)
def _(spark, sf):
    return s.evaluate_images(_with_truth(spark, sf)).select("key", "has_ground_truth", "dice_score", "iou_score")


@register(
    "evaluation_summary",
    OVERLAP
    + """SELECT count(*) AS images, count(CASE WHEN has_ground_truth THEN 1 END) AS images_with_truth,
  round(avg(dice_score), 8) AS avg_dice, round(avg(iou_score), 8) AS avg_iou FROM evaluated""",
    ("pixels",),
)
def _(spark, sf):
    return s.evaluation_summary(s.evaluate_images(_with_truth(spark, sf)))


@register(
    "report_entries",
    OVERLAP
    + """, st AS (
  SELECT key, sum(CASE WHEN p > 0.5 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) * 100 AS cover, sum(p) / count(*) AS conf FROM scored GROUP BY key)
SELECT concat('img_', CAST(key AS VARCHAR)) AS image,
  concat('Image: img_', CAST(key AS VARCHAR), chr(10), 'Water Coverage: ', printf('%.1f', cover), '%', chr(10), 'Avg Confidence: ', printf('%.3f', conf),
    CASE WHEN has_ground_truth THEN concat(chr(10), 'Dice Score: ', printf('%.3f', dice_score), chr(10), 'IoU Score: ', printf('%.3f', iou_score)) ELSE '' END,
    chr(10), repeat('-', 30)) AS text
FROM evaluated JOIN st USING (key)""",
    ("pixels",),
)
def _(spark, sf):
    scored = s.prediction_stats(_with_truth(spark, sf))
    image = F.concat(F.lit("img_"), F.col("key").cast("string"))
    return s.report_rows(s.evaluate_images(scored).withColumn("image", image))


@register(
    "evaluate_batches",
    OVERLAP
    + """, batches AS (
  SELECT (row_number() OVER (ORDER BY key) - 1) // 32 AS b, inter, pm, tm, eq, px FROM sums WHERE known),
pooled AS (SELECT b, sum(inter) AS inter, sum(pm + tm) AS both_sides, sum(eq) AS eq, sum(px) AS px FROM batches GROUP BY b)
SELECT CAST(sum(eq) AS BIGINT) AS correct, CAST(sum(px) AS BIGINT) AS pixels,
  round(CAST(sum(eq) AS DOUBLE) / CAST(sum(px) AS DOUBLE) * 100, 8) AS accuracy_pct,
  round(avg(CAST(2 * inter AS DOUBLE) / (CAST(both_sides AS DOUBLE) + CAST(1e-8 AS DOUBLE))), 8) AS dice FROM pooled""",
    ("pixels",),
)
def _(spark, sf):
    return s.evaluate_batches(_with_truth(spark, sf), "key")


@register(
    "binarised_masks",
    """, grey AS (SELECT vec_id AS key, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings)
SELECT key, CAST(sum(CASE WHEN least(greatest(floor(CAST(x AS DOUBLE) * 400) + 128, 0), 255) > 127 THEN 1 ELSE 0 END) AS BIGINT) AS above_127,
  CAST(sum(CASE WHEN least(greatest(floor(CAST(x AS DOUBLE) * 400) + 128, 0), 255) = 255 THEN 1 ELSE 0 END) AS BIGINT) AS equals_255
FROM grey GROUP BY key""",
    ("pixels",),
)
def _(spark, sf):
    grey = F.transform("logits", _level)
    return fx.logit_maps(spark, sf).select(
        "key", *[px.ones(px.binarise(grey, rule)).alias(rule) for rule in ("above_127", "equals_255")]
    )


def _split(spark, sf):
    return s.split_dataset(fx.table(spark, sf, "embeddings").select("vec_id"), "vec_id")


@register(
    "split_sizes",
    """WITH n AS (SELECT count(*) AS n FROM embeddings),
held AS (SELECT n, CAST(ceil(CAST(0.30000000000000004 AS DOUBLE) * n) AS BIGINT) AS h FROM n),
cut AS (SELECT n, h, CAST(ceil(CAST(0.14 AS DOUBLE) / CAST(0.30000000000000004 AS DOUBLE) * h) AS BIGINT) AS t FROM held)
SELECT 'train' AS part, n - h AS count FROM cut UNION ALL SELECT 'validation', h - t FROM cut UNION ALL SELECT 'test', t FROM cut""",
)
def _(spark, sf):
    return _split(spark, sf).groupBy("part").agg(F.count("*").alias("count"))


@register(
    "split_members",
    """WITH n AS (SELECT count(*) AS n FROM embeddings),
held AS (SELECT n, CAST(ceil(CAST(0.30000000000000004 AS DOUBLE) * n) AS BIGINT) AS h FROM n),
cut AS (SELECT n, h, CAST(ceil(CAST(0.14 AS DOUBLE) / CAST(0.30000000000000004 AS DOUBLE) * h) AS BIGINT) AS t FROM held),
placed AS (SELECT vec_id, row_number() OVER (ORDER BY md5(concat(CAST(vec_id AS VARCHAR), ':42')), vec_id) - 1 AS place FROM embeddings)
SELECT vec_id, CASE WHEN place < n - h THEN 'train' WHEN place < n - t THEN 'validation' ELSE 'test' END AS part FROM placed, cut""",
)
def _(spark, sf):
    return _split(spark, sf)


# The two source pixels and the weight of the second for each of 16 target pixels of 8.
TAPS = """taps AS (
  SELECT t, CAST(floor(c) AS INT) AS lo, least(CAST(floor(c) AS INT) + 1, 7) AS hi, c - floor(c) AS w
  FROM (SELECT t, greatest(least((t + CAST(0.5 AS DOUBLE)) / 2 - CAST(0.5 AS DOUBLE), 7), 0) AS c FROM generate_series(0, 15) AS g(t)))"""


def _between(at: str, column: str) -> str:
    """SQL for the weighted sum of the two source pixels of a target pixel."""
    return f"sum(CASE WHEN {at} = lo THEN {column} * (1 - w) ELSE 0 END + CASE WHEN {at} = hi THEN {column} * w ELSE 0 END)"


@register(
    "preprocessed_pixels",
    PICTURE_SQL
    + f""", {TAPS},
channel AS (
  SELECT key, (i - 1) // 8 AS y, (i - 1) % 8 AS x, 0 AS c, greatest(v - 20, 0) AS v FROM level
  UNION ALL SELECT key, (i - 1) // 8, (i - 1) % 8, 1, v FROM level
  UNION ALL SELECT key, (i - 1) // 8, (i - 1) % 8, 2, least(v + 20, 255) FROM level),
wide AS (SELECT key, c, y, t AS tx, {_between("x", "v")} AS v FROM channel JOIN taps ON x = lo OR x = hi GROUP BY ALL),
tall AS (SELECT key, c, tx, t AS ty, floor({_between("y", "v")} + 0.5) AS v FROM wide JOIN taps ON y = lo OR y = hi GROUP BY ALL)
SELECT key, CAST((ty * 16 + tx) * 3 + c AS INT) AS pos, round((v / CAST(255 AS DOUBLE) - [CAST(0.485 AS DOUBLE), CAST(0.456 AS DOUBLE), CAST(0.406 AS DOUBLE)][c + 1])
  / [CAST(0.229 AS DOUBLE), CAST(0.224 AS DOUBLE), CAST(0.225 AS DOUBLE)][c + 1], 5) AS value FROM tall""",
    ("pixels",),
)
def _(spark, sf):
    """The 8x8 pictures at twice their size, normalised."""
    tensors = imaging.preprocess(_pictures(spark, sf), size=(16, 16))
    return tensors.select("key", F.posexplode("tensor").alias("pos", "value")).withColumn(
        "value", F.round(F.col("value").cast("double"), 5)
    )


@register(
    "attached_truth",
    """SELECT a.vec_id AS key, concat('img_', CAST(a.vec_id AS VARCHAR)) AS base,
  CASE WHEN a.vec_id % 4 = 0 THEN concat('truth/img_', CAST(a.vec_id AS VARCHAR), '.png')
       WHEN a.vec_id % 3 = 0 THEN concat('truth/img_', CAST(a.vec_id AS VARCHAR), '.bmp') END AS truth_path FROM embeddings a""",
)
def _(spark, sf):
    """Every second image has a .png mask (every other one broken), every third a .bmp mask."""
    base = F.concat(F.lit("img_"), F.col("key").cast("string"))
    images = _pictures(spark, sf).select("key", base.alias("base"), "image")

    def masks(step, ext, broken):
        height = F.when(F.lit(broken) & (F.col("key") % 4 != 0), -1).otherwise(8)
        return images.where(F.col("key") % step == 0).select(
            F.concat(F.lit("truth/"), "base", F.lit(ext)).alias("path"),
            "base",
            F.col("image").withField("height", height).alias("image"),
        )

    both = masks(2, ".png", True).unionByName(masks(3, ".bmp", False))
    return attach_truth(images, both).select("key", "base", "truth_path")


RESIZED = f""", {TAPS},
small AS (SELECT key, (i - 1) // 8 AS y, (i - 1) % 8 AS x, CAST(CAST(p AS FLOAT) AS DOUBLE) AS p, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS m FROM scored),
wide AS (SELECT key, y, t AS tx, {_between("x", "p")} AS p, {_between("x", "m")} AS m FROM small JOIN taps ON x = lo OR x = hi GROUP BY ALL),
tall AS (SELECT key, tx, t AS ty, {_between("y", "p")} AS p, floor({_between("y", "m")} + 0.5) AS m FROM wide JOIN taps ON y = lo OR y = hi GROUP BY ALL)
SELECT key, round(sum(m) / CAST(256 AS DOUBLE) * 100, 6) AS water_coverage, round(avg(p), 6) AS avg_confidence,
  sum(m) / CAST(256 AS DOUBLE) * 100 > 80 AS overflow_detected, CAST(16 AS INT) AS height, CAST(16 AS INT) AS width
FROM tall GROUP BY key"""


def _resized(spark, sf, rethreshold):
    """Probabilities and masks of the 8x8 maps brought to pictures of twice the size, with statistics."""
    twice = F.col("image").withField("height", F.lit(16)).withField("width", F.lit(16))
    scored = scoring.with_probabilities(_pictures(spark, sf).withColumn("image", twice))
    stats = s.prediction_stats(imaging.resize_back(scored, rethreshold)).select(*STATS, "height", "width")
    return stats.withColumns({c: F.round(c, 6) for c in ("water_coverage", "avg_confidence")})


@register("resized_back", RESIZED, ("pixels",))
def _(spark, sf):
    return _resized(spark, sf, False)


@register("resized_back_rethresholded", RESIZED, ("pixels",))
def _(spark, sf):
    """The mask cut at one half again, as the single-image path does: whole numbers already, so the same counts."""
    return _resized(spark, sf, True)


def _unpacked(content: str):
    """The pixel values of a PNG as this package writes it, for queries that show them."""

    @F.pandas_udf("array<int>")
    def values(blobs: pd.Series) -> pd.Series:
        rows = []
        for blob in blobs:
            width, height = struct.unpack(">II", blob[16:24])
            lines = np.frombuffer(zlib.decompress(blob[41 : 41 + struct.unpack(">I", blob[33:37])[0]]), np.uint8).reshape(height, -1)
            rows.append(lines[:, 1:].astype(np.int32).ravel())
        return pd.Series(rows, dtype=object)

    return values(content)


@register(
    "artefact_objects",
    PICTURE_SQL
    + """, drawn AS (
  SELECT l.key, l.i, [greatest(v - 20, 0), v, least(v + 20, 255)] AS rgb, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS m, CAST(p AS FLOAT) AS q
  FROM level l JOIN scored s ON s.key = l.key AND s.i = l.i),
shown AS (
  SELECT key, 'originals' AS kind, (i - 1) * 3 + c - 1 AS pos, rgb[c] AS value FROM drawn, generate_series(1, 3) AS g(c)
  UNION ALL SELECT key, 'predictions', i - 1, m * 255 FROM drawn
  UNION ALL SELECT key, 'confidence_maps', i - 1, CAST(floor(q * CAST(255 AS FLOAT)) AS BIGINT) FROM drawn
  UNION ALL SELECT key, 'overlay', (i - 1) * 3 + c - 1,
    CASE WHEN m = 1 THEN CAST(floor(rgb[c] * CAST(0.6 AS DOUBLE) + CASE WHEN c = 2 THEN 255 ELSE 0 END * CAST(0.4 AS DOUBLE)) AS BIGINT) ELSE rgb[c] END
  FROM drawn, generate_series(1, 3) AS g(c))
SELECT concat(kind, '/img_', CAST(key AS VARCHAR), '.png') AS key, 'image/png' AS content_type, CAST(pos AS INT) AS pos, CAST(value AS INT) AS value FROM shown""",
    ("pixels",),
)
def _(spark, sf):
    """The four pictures of every image, with the pixel values they hold."""
    scored = scoring.with_probabilities(_pictures(spark, sf))
    named = scored.withColumn("filename", F.concat(F.lit("img_"), F.col("key").cast("string"), F.lit(".png")))
    objects = imaging.artefact_objects(imaging.draw_artefacts(named, (8, 8)))
    return objects.select("key", "content_type", F.posexplode(_unpacked("content")).alias("pos", "value"))


def _pairs(spark, sf):
    truth = fx.truth_maps(spark, sf).select("key", px.binarise(F.col("truth")).alias("truth_mask"))
    return scoring.with_probabilities(_pictures(spark, sf)).join(truth, "key", "left")


@register("comparison_pictures")
def _(spark, sf):
    return imaging.composite(_pairs(spark, sf)).select("key", F.sha2("composite", 256).alias("digest"))


@register("augmented_pictures")
def _(spark, sf):
    varied = imaging.augment(_pairs(spark, sf).where("truth_mask IS NOT NULL"), "key", copies=2)
    return varied.select("key", "copy", F.xxhash64("pixels").alias("pixels"), F.xxhash64("truth_mask").alias("mask"))


@register(
    "denormalised_pixels",
    PICTURE_SQL
    + """, channel AS (
  SELECT key, (i - 1) * 3 AS pos, greatest(v - 20, 0) AS v, CAST(0.485 AS DOUBLE) AS mean, CAST(0.229 AS DOUBLE) AS std FROM level
  UNION ALL SELECT key, (i - 1) * 3 + 1, v, CAST(0.456 AS DOUBLE), CAST(0.224 AS DOUBLE) FROM level
  UNION ALL SELECT key, (i - 1) * 3 + 2, least(v + 20, 255), CAST(0.406 AS DOUBLE), CAST(0.225 AS DOUBLE) FROM level)
SELECT key, CAST(pos AS INT) AS pos,
  CAST(floor(least(greatest(CAST(CAST((v / CAST(255 AS DOUBLE) - mean) / std AS FLOAT) AS DOUBLE) * std + mean, 0), 1) * 255) AS SMALLINT) AS value FROM channel""",
    ("pixels",),
)
def _(spark, sf):
    shown = imaging.denormalise(imaging.preprocess(_pictures(spark, sf), size=(8, 8)))
    return shown.select("key", F.posexplode("pixels").alias("pos", "value"))


# --- whole jobs over picture files -------------------------------------------------------------

# A linear model over normalised RGB; its weights are arbitrary fixed values. Tensors and stored
# probabilities have single precision, all sums double.
WEIGHTS, BIAS = [0.8, 0.5, -0.9], 0.1

MODEL_SQL = (
    PICTURE_SQL
    + """, tensor AS (
  SELECT key, i, CAST(CAST((greatest(v - 20, 0) / CAST(255 AS DOUBLE) - CAST(0.485 AS DOUBLE)) / CAST(0.229 AS DOUBLE) AS FLOAT) AS DOUBLE) AS r,
    CAST(CAST((v / CAST(255 AS DOUBLE) - CAST(0.456 AS DOUBLE)) / CAST(0.224 AS DOUBLE) AS FLOAT) AS DOUBLE) AS g,
    CAST(CAST((least(v + 20, 255) / CAST(255 AS DOUBLE) - CAST(0.406 AS DOUBLE)) / CAST(0.225 AS DOUBLE) AS FLOAT) AS DOUBLE) AS b FROM level),
prob AS (SELECT key, i, CAST(1 AS DOUBLE) / (CAST(1 AS DOUBLE) + exp(-(r * CAST(0.8 AS DOUBLE) + g * CAST(0.5 AS DOUBLE) - b * CAST(0.9 AS DOUBLE) + CAST(0.1 AS DOUBLE)))) AS q FROM tensor),
model AS (SELECT key, sum(CASE WHEN q > 0.5 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) * 100 AS cover, sum(q) / count(*) AS conf,
  sum(CAST(CAST(q AS FLOAT) AS DOUBLE)) / count(*) AS stored_conf FROM prob GROUP BY key)
"""
)


def _png(spark, sf):
    """key and PNG bytes of every picture."""

    @F.pandas_udf("binary")
    def encode(image: pd.DataFrame) -> pd.Series:
        rows = zip(image["data"], image["height"], image["width"])
        return pd.Series([raster.png(raster.from_spark(d, h, w, 3)) for d, h, w in rows], dtype=object)

    return _pictures(spark, sf).select("key", encode("image").alias("png"))


def _file(column="key"):
    return F.concat(F.lit("img_"), F.col(column).cast("string"), F.lit(".png"))


@register(
    "stream_scoring",
    MODEL_SQL
    + """SELECT concat('img_', CAST(key // 3 AS VARCHAR), '.png') AS filename, round(cover, 6) AS water_coverage, round(conf, 6) AS avg_confidence,
  cover > 80 AS overflow_detected, 'unknown' AS location, 'linear' AS model_name, key % 500 AS processing_time_ms,
  CASE WHEN key % 2 = 1 THEN 'unet++' ELSE 'v2' END AS model_version FROM model""",
    ("pixels",),
)
def _(spark, sf):
    """All pictures through the scoring stream in several batches, three of each file name: odd ones inline, even ones as stored objects."""
    root = stage_path(spark, "scoring")
    pictures = _png(spark, sf)
    link = F.concat(F.lit("uploads/"), _file())
    write_objects(pictures.where("key % 2 = 0").select(link.alias("key"), F.col("png").alias("content")), f"{root}/store")
    odd = F.col("key") % 2 == 1
    message = F.struct(
        F.concat(F.lit("img_"), F.expr("key div 3").cast("string"), F.lit(".png")).alias("filename"),
        (F.col("key") % 500).alias("processing_time_ms"),
        F.when(~odd, "v2").alias("model_version"),
        F.when(odd, F.regexp_replace(F.base64("png"), r"\s", "")).alias("image"),
        F.when(~odd, link).alias("image_link"),
        F.lit("2024-01-01T00:00:00").alias("date"),
    )
    pictures.select(F.to_json(message)).repartition(8).write.text(f"{root}/messages")
    conf = jobs.Scoring(
        root=f"{root}/store",
        results=f"{root}/results",
        errors=f"{root}/errors",
        factory=scoring.pixel_scorer(WEIGHTS, BIAS),
        model="linear",
        size=(8, 8),
    )
    stream = read_messages(spark, {"format": "text", "path": f"{root}/messages", "options": {"maxFilesPerTrigger": "4"}})
    jobs.run_scoring(stream, conf, f"{root}/checkpoint").awaitTermination()
    rows = spark.read.parquet(f"{root}/results")
    return rows.select(
        "filename",
        F.round("water_coverage", 6).alias("water_coverage"),
        F.round("avg_confidence", 6).alias("avg_confidence"),
        "overflow_detected",
        "location",
        "model_name",
        "processing_time_ms",
        "model_version",
    )


@register(
    "folder_scoring",
    MODEL_SQL
    + """, sums AS (
  SELECT a.key, count(b.key) > 0 AS known, sum(CASE WHEN a.q > 0.5 AND b.x > 0 THEN 1 ELSE 0 END) AS inter,
    sum(CASE WHEN a.q > 0.5 THEN 1 ELSE 0 END) AS pm, sum(CASE WHEN b.x > 0 THEN 1 ELSE 0 END) AS tm
  FROM prob a LEFT JOIN pixels b ON b.key = a.key + 1 AND b.i = a.i GROUP BY a.key)
SELECT concat('img_', CAST(key AS VARCHAR)) AS image, round(cover, 6) AS water_coverage, round(stored_conf, 6) AS avg_confidence,
  CASE WHEN known THEN round(CAST(2 * inter AS DOUBLE) / (CAST(pm + tm AS DOUBLE) + CAST(1e-8 AS DOUBLE)), 8) END AS dice_score,
  CASE WHEN known THEN round(CAST(inter AS DOUBLE) / (CAST(pm + tm - inter AS DOUBLE) + CAST(1e-8 AS DOUBLE)), 8) END AS iou_score,
  known AS has_ground_truth
FROM sums JOIN model USING (key)""",
    ("pixels",),
)
def _(spark, sf):
    """All pictures as files with mask files, through the batch job."""
    root = stage_path(spark, "folder")
    write_objects(_png(spark, sf).select(_file().alias("key"), F.col("png").alias("content")), f"{root}/in")

    @F.pandas_udf("binary")
    def encode(grey: pd.Series) -> pd.Series:
        return pd.Series([raster.png(imaging._grid(g, 8, 8, "uint8")) for g in grey], dtype=object)

    truth = fx.truth_maps(spark, sf).where("key >= 0").select(_file().alias("key"), encode("truth").alias("content"))
    write_objects(truth, f"{root}/masks")
    results = s.score_folder(
        spark, f"{root}/in", f"{root}/out", scoring.pixel_scorer(WEIGHTS, BIAS), f"{root}/masks", size=(8, 8)
    )
    return results.withColumns(
        {"water_coverage": F.round("water_coverage", 6), "avg_confidence": F.round("avg_confidence", 6)}
    )


@register("fitted_scorer")
def _(spark, sf):
    """A pixel model fitted on the training part, chosen by Dice on the validation part."""
    pairs = imaging.preprocess(_pairs(spark, sf).where("truth_mask IS NOT NULL"), size=(8, 8))
    # The pictures are prepared once; the split, the fits and the test then read them.
    pairs = stage(pairs.select("key", "tensor", "truth_mask"), "pairs")
    parts = s.split_dataset(pairs, "key")
    best = scoring.fit_pixel_scorer(parts.where("part = 'train'"), parts.where("part = 'validation'"), "key", [0.01, 0.1])
    tested = scoring.score_pixels(parts.where("part = 'test'"), best["weights"], best["bias"])
    return s.evaluation_summary(s.evaluate_images(tested)).withColumn("reg", F.lit(best["reg"]))
