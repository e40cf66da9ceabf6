"""Folders of pictures, pixel work, scoring, evaluation and splits."""

import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from hydrolens.functions import pixels as px, raster
from hydrolens.operators import imaging, scoring
from hydrolens.plans import scoring as s
from hydrolens.sources import images as im, objects as ob
from tests.conftest import plan_text, write_png


def decode(png):
    """Pixels of a PNG written without row filters."""
    assert png[:8] == b"\x89PNG\r\n\x1a\n"
    width, height = int.from_bytes(png[16:20], "big"), int.from_bytes(png[20:24], "big")
    channels = {0: 1, 2: 3}[png[25]]
    at, body = 8, b""
    while at < len(png):
        size = int.from_bytes(png[at : at + 4], "big")
        if png[at + 4 : at + 8] == b"IDAT":
            body += png[at + 8 : at + 8 + size]
        assert int.from_bytes(png[at + 8 + size : at + 12 + size], "big") == zlib.crc32(png[at + 4 : at + 8 + size])
        at += 12 + size
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + width * channels)
    assert not rows[:, 0].any()
    return rows[:, 1:].reshape((height, width, 3) if channels == 3 else (height, width))


def picture(height, width, seed=0):
    return np.random.default_rng(seed).integers(0, 256, (height, width, 3)).astype(np.uint8)


@pytest.fixture()
def folder(tmp_path):
    root = str(tmp_path / "in")
    write_png(f"{root}/one.png", picture(6, 8, 1))
    write_png(f"{root}/two words+%20é.PNG", picture(5, 5, 2))
    write_png(f"{root}/grey.bmp", picture(4, 4, 3)[:, :, 0])  # a PNG under another name still decodes
    write_png(f"{root}/Mixed.Png", picture(3, 3, 4))
    with open(f"{root}/broken.jpg", "wb") as out:
        out.write(b"not an image")
    with open(f"{root}/notes.txt", "wb") as out:
        out.write(b"text")
    return root


def test_folder_scan(spark, folder):
    found = {r.name: (r.base, r.image.height) for r in im.read_images(spark, folder).collect()}
    assert found == {"one.png": ("one", 6), "two words+%20é.PNG": ("two words+%20é", 5), "grey.bmp": ("grey", 4), "broken.jpg": ("broken", -1)}
    assert im.read_images(spark, folder, valid_only=True).count() == 3
    assert "Mixed.Png" in {r.name for r in im.read_images(spark, folder, case="any").collect()}
    assert "two words+%20é.PNG" not in {r.name for r in im.read_images(spark, folder, case="lower").collect()}
    paths = {r.path for r in im.read_images(spark, folder).collect()}
    listed = {r.path for r in spark.read.format("binaryFile").load(folder).collect()}
    assert paths <= listed


def test_dataset_pairs(spark, tmp_path):
    for name in ("a.png", "b.JPG", "c.png"):
        write_png(f"{tmp_path}/images/{name}", picture(2, 2))
        if name != "c.png":
            write_png(f"{tmp_path}/masks/{name}", picture(2, 2)[:, :, 0])
    with pytest.raises(ValueError, match="c.png"):
        im.read_dataset(spark, f"{tmp_path}/images", f"{tmp_path}/masks")
    assert sorted(r.name for r in im.read_dataset(spark, f"{tmp_path}/images", f"{tmp_path}/masks", "drop").collect()) == ["a.png", "b.JPG"]


def test_objects(spark, tmp_path):
    root = str(tmp_path / "store")
    blobs = spark.createDataFrame([("uploads/1_a b.png", b"\x01\x02"), ("uploads/2_c.png", b"y"), ("other/x", b"z")], "key string, content binary")
    assert ob.write_objects(blobs, root) == 3
    assert ob.write_objects(blobs.where("key = 'other/x'"), root) == 1  # the same key again
    assert {(r.key, r.size) for r in ob.list_objects(spark, root).collect()} == {("uploads/1_a b.png", 2), ("uploads/2_c.png", 1), ("other/x", 1)}
    assert {r.key for r in ob.list_objects(spark, root, "uploads/1").collect()} == {"uploads/1_a b.png"}
    assert ob.list_objects(spark, "file://" + root).count() == ob.list_objects(spark, "file:" + root, "uploads/").count() + 1 == 3
    keys = spark.createDataFrame([("other/x",), ("other/x",), ("gone",), (None,)], "key string")
    assert ob.existing_objects(keys, "file:" + root).where("found").count() == 1
    got = {r.key: (r.content, r.error) for r in ob.fetch_objects(keys, root).collect()}
    assert got == {"other/x": (bytearray(b"z"), None), "gone": (None, "FileNotFoundError")}
    assert {r.key: r.found for r in ob.existing_objects(keys, root).collect()} == {"other/x": True, "gone": False}
    ob.artefact_table(blobs, str(tmp_path / "table"))
    assert {r.prefix for r in spark.read.parquet(str(tmp_path / "table")).collect()} == {"uploads", "other"}


def test_listing_reads_no_contents(spark, folder):
    text = ob.list_objects(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<key:string,size:bigint,last_modified:timestamp,folder:boolean>" in text and "content" not in text


def test_resize_matches_direct_interpolation():
    image = picture(5, 7).astype(np.float64)
    out = raster.resize(image, 11, 3)
    for y in range(11):
        for x in range(3):
            sy = min(max((y + 0.5) * 5 / 11 - 0.5, 0), 4)
            sx = min(max((x + 0.5) * 7 / 3 - 0.5, 0), 6)
            y0, x0 = int(sy), int(sx)
            y1, x1, fy, fx = min(y0 + 1, 4), min(x0 + 1, 6), sy - y0, sx - x0
            want = (image[y0, x0] * (1 - fx) + image[y0, x1] * fx) * (1 - fy) + (image[y1, x0] * (1 - fx) + image[y1, x1] * fx) * fy
            assert np.allclose(out[y, x], want)
    whole = np.array([[0, 1], [1, 1]], np.uint8)
    assert set(np.unique(raster.resize(whole, 9, 9))) <= {0, 1}


def test_preprocess_and_back(spark, folder):
    df = imaging.preprocess(im.read_images(spark, folder), size=(6, 8)).where("name = 'one.png'")
    tensor = np.array(df.first().tensor).reshape(6, 8, 3)
    want = (picture(6, 8, 1) / 255.0 - np.array(raster.MEAN)) / np.array(raster.STD)
    assert np.allclose(tensor, want, atol=1e-5)
    shown = np.array(imaging.denormalise(df).first().pixels).reshape(6, 8, 3)
    assert np.abs(shown - picture(6, 8, 1)).max() <= 1  # truncation may lose one level
    broken = imaging.preprocess(im.read_images(spark, folder), size=(4, 4)).where("name = 'broken.jpg'").first()
    assert broken.tensor is None


def flat(values):
    return [float(v) for v in np.asarray(values).ravel()]


def scored_frame(spark, folder, size=(4, 4)):
    rng = np.random.default_rng(9)
    valid = im.read_images(spark, folder, valid_only=True)
    logits = spark.createDataFrame([(r.name, flat(rng.normal(0, 1, size))) for r in valid.select("name").orderBy("name").collect()], "name string, logits array<float>")
    df = valid.join(logits, "name").withColumns({"height": F.lit(size[0]), "width": F.lit(size[1])})
    return scoring.with_probabilities(df)


def test_resize_back(spark, folder):
    df = scored_frame(spark, folder)
    before = {r.name: r for r in df.collect()}
    for r in imaging.resize_back(df).collect():
        old = before[r.name]
        want = raster.resize(np.array(old.probabilities, np.float32).reshape(4, 4), r.image.height, r.image.width)
        assert (r.height, r.width) == (r.image.height, r.image.width)
        assert np.allclose(np.array(r.probabilities).reshape(want.shape), want)
        assert set(r["mask"]) <= {0, 1}
    assert imaging.resize_back(df, rethreshold=True).count() == 3


def test_artefacts(spark, folder):
    df = scored_frame(spark, folder, (6, 8)).where("name = 'one.png'")
    row = df.first()
    out = {r.key: (decode(bytes(r.content)), r.content_type) for r in imaging.artefact_objects(imaging.draw_artefacts(df, (6, 8)), "name").collect()}
    assert set(out) == {f"{k}/one.png" for k in ("originals", "predictions", "confidence_maps", "overlay")}
    image, mask = picture(6, 8, 1), np.array(row["mask"]).reshape(6, 8)
    assert np.array_equal(out["originals/one.png"][0], image)
    assert np.array_equal(out["predictions/one.png"][0], mask * 255)
    assert np.array_equal(out["confidence_maps/one.png"][0], (np.array(row.probabilities, np.float32).reshape(6, 8) * 255).astype(np.uint8))
    tint = (image * 0.6 + np.array([0, 255, 0]) * 0.4).astype(np.uint8)
    assert np.array_equal(out["overlay/one.png"][0], np.where(mask[:, :, None] == 1, tint, image))
    assert out["overlay/one.png"][1] == "image/png"


def test_spark_reads_our_png(spark, tmp_path):
    image = picture(7, 5)
    os.makedirs(tmp_path / "p")
    (tmp_path / "p" / "a.png").write_bytes(raster.png(image))
    row = im.read_images(spark, str(tmp_path / "p")).first().image
    assert np.array_equal(raster.from_spark(bytes(row.data), row.height, row.width, row.nChannels), image)


@pytest.mark.parametrize("style", sorted(imaging.STYLES))
def test_composites(spark, folder, style):
    df = scored_frame(spark, folder, (6, 8)).where("name = 'one.png'")
    row = df.first()
    image, mask = picture(6, 8, 1), np.array(row["mask"]).reshape(6, 8) == 1
    truth = np.zeros((6, 8), int)
    truth[:3] = 1
    known = df.withColumn("truth_mask", F.array(*[F.lit(int(v)).cast("tinyint") for v in truth.ravel()]))
    got = decode(bytes(imaging.composite(known, style).first().composite)).astype(int)
    top = np.zeros((6, 8, 3))
    if style == "comparison":
        top[mask], top[truth == 1], top[mask & (truth == 1)] = (0, 0, 255), (255, 0, 0), (0, 255, 0)
    else:
        top = top if style == "deep_blue" else image.astype(float)
        top[mask] = {"blue": (0, 100, 255), "deep_blue": (0, 0, 255), "green": (0, 255, 0)}[style]
    alpha = imaging.STYLES[style]["alpha"]
    assert np.abs(got - (image * (1 - alpha) + top * alpha)).max() <= 0.51
    if style == "comparison":
        assert imaging.composite(df, style).first().composite == imaging.composite(df, "blue").first().composite


def test_truth_by_preference(spark, tmp_path):
    for name, shade in (("a.jpg", 10), ("a.bmp", 200), ("b.tiff", 50)):
        write_png(f"{tmp_path}/m/{name}", np.full((2, 2), shade))
    for name in ("a.png", "b.bmp"):
        with open(f"{tmp_path}/m/{name}", "wb") as out:
            out.write(b"broken")
    for name in ("a.png", "b.png", "c.png"):
        write_png(f"{tmp_path}/i/{name}", picture(4, 4))
    df = im.attach_truth(im.read_images(spark, f"{tmp_path}/i"), im.read_images(spark, f"{tmp_path}/m"))
    got = {r.base: r.truth_path and r.truth_path.rsplit("/", 1)[1] for r in df.collect()}
    assert got == {"a": "a.jpg", "b": "b.tiff", "c": None}
    masks = {r.base: r.truth_mask for r in imaging.truth_mask(df).collect()}
    assert masks == {"a": [0] * 16, "b": [0] * 16, "c": None}


def test_threshold_rules(spark):
    df = spark.sql("SELECT array(0, 127, 128, 254, 255) AS g")
    assert df.select(px.binarise(F.col("g")).alias("m")).first().m == [0, 0, 1, 1, 1]
    assert df.select(px.binarise(F.col("g"), "equals_255").alias("m")).first().m == [0, 0, 0, 0, 1]
    with pytest.raises(ValueError):
        px.binarise(F.col("g"), "other")
    zero = scoring.with_probabilities(spark.sql("SELECT array(0.0f, 0.1f, -0.1f) AS logits")).first()
    assert zero["mask"] == [0, 1, 0] and zero.probabilities[0] == 0.5


def test_evaluation(spark):
    rows = [(1, [1, 1, 0, 0], [1, 0, 1, 0]), (2, [0, 0, 0, 0], [0, 0, 0, 0]), (3, [1, 1, 1, 1], [1, 1, 1, 1]), (4, [1, 0, 0, 0], None)]
    df = spark.createDataFrame(rows, "key int, mask array<tinyint>, truth_mask array<tinyint>").coalesce(1)
    got = {r.key: (r.dice_score, r.iou_score) for r in s.evaluate_images(df).collect()}
    assert got[1] == (2 / (4 + 1e-8), 1 / (3 + 1e-8)) and got[2] == (0.0, 0.0) and got[4] == (None, None)
    assert abs(got[3][0] - 1) < 1e-8
    summary = s.evaluation_summary(s.evaluate_images(df)).first()
    assert (summary.images, summary.images_with_truth) == (4, 3) and abs(summary.avg_dice - 0.5) < 1e-8
    pooled = s.evaluate_batches(df, "key", batch_size=2).first()
    assert (pooled.correct, pooled.pixels) == (10, 12)
    assert abs(pooled.dice - (2 / 4 + 8 / 8) / 2) < 1e-6


def test_statistics_by_plugin(spark, folder):
    df = imaging.preprocess(im.read_images(spark, folder, valid_only=True), size=(4, 4))
    out = scoring.score(df, scoring.pixel_scorer([1.0, 0.0, -1.0], 0.1), "tensor", [4, 4, 3], "linear", batch=2)
    for r in s.prediction_stats(out, threshold=50).collect():
        tensor = np.array(r.tensor, np.float32).reshape(-1, 3)
        p = 1 / (1 + np.exp(-(tensor @ np.array([1.0, 0.0, -1.0]) + 0.1)))
        assert abs(r.water_coverage - (p > 0.5).mean() * 100) < 1e-9 and abs(r.avg_confidence - p.mean()) < 1e-5
        assert r.overflow_detected == (r.water_coverage > 50) and r.model_name == "linear"


def test_split_sizes():
    assert s.split_counts(100) == {"train": 69, "validation": 16, "test": 15}
    for n in range(0, 400):
        assert sum(s.split_counts(n).values()) == n


def test_split_is_repeatable(spark):
    df = spark.range(1000).withColumn("wide", F.lit("x"))
    first = s.split_dataset(df.repartition(7), "id")
    again = s.split_dataset(df.repartition(3), "id")
    assert sorted(map(tuple, first.select("id", "part").collect())) == sorted(map(tuple, again.select("id", "part").collect()))
    assert {r.part: r["count"] for r in first.groupBy("part").count().collect()} == s.split_counts(1000)
    other = s.split_dataset(df, "id", seed=7)
    assert first.where("part = 'test'").join(other.where("part = 'test'"), "id").count() < 100


def test_augment(spark, folder):
    df = im.read_images(spark, folder, valid_only=True)
    masks = {r.name: [int(v) for v in np.random.default_rng(1).integers(0, 2, r.h * r.w)] for r in df.select("name", F.col("image.height").alias("h"), F.col("image.width").alias("w")).collect()}
    pairs = df.join(spark.createDataFrame(list(masks.items()), "name string, truth_mask array<tinyint>"), "name")
    a = sorted(imaging.augment(pairs, "name", copies=4).collect())
    b = sorted(imaging.augment(pairs.repartition(5), "name", copies=4).collect())
    assert a == b and len(a) == 12
    assert a != sorted(imaging.augment(pairs, "name", seed=1, copies=4).collect())
    for r in a:
        assert len(r.pixels) == r.height * r.width * 3 and len(r.truth_mask) == r.height * r.width
        assert min(r.pixels) >= 0 and max(r.pixels) <= 255 and set(r.truth_mask) <= {0, 1}


def test_geometry_moves_image_and_mask_together():
    mask = (np.random.default_rng(2).random((9, 12)) > 0.5).astype(np.uint8)
    rgb = np.repeat(mask[:, :, None] * 200, 3, axis=2).astype(np.uint8)
    turned, bits = imaging.rotate(rgb, mask, 17.0)
    assert np.array_equal(turned[:, :, 0] == 200, bits == 1)
    assert np.array_equal(imaging.rotate(rgb, mask, 0.0)[1], mask)


def test_colour_shift():
    image = picture(6, 6).astype(np.float64)
    assert np.allclose(imaging.shift_colour(image, 0, 0, 0), image)
    red = np.array([[[200.0, 0, 0]]])
    assert np.allclose(imaging.shift_colour(red, 60, 0, 0), [[[0, 200, 0]]])  # 120 degrees: green
    assert np.allclose(imaging.shift_colour(red, 0, 0, 10), [[[210, 0, 0]]])


def test_blur_keeps_flat_areas():
    flat_image = np.full((5, 6, 3), 77.0)
    assert np.allclose(imaging.smooth(flat_image, np.ones(3) / 3), flat_image)


def test_fitted_scorer(spark, tmp_path):
    rng = np.random.default_rng(0)
    for i in range(6):
        image = rng.integers(0, 256, (8, 8, 3)).astype(np.uint8)
        write_png(f"{tmp_path}/i/{i}.png", image)
        write_png(f"{tmp_path}/m/{i}.png", (image[:, :, 2] > 128).astype(np.uint8) * 255)
    pairs = im.attach_truth(im.read_images(spark, f"{tmp_path}/i"), im.read_images(spark, f"{tmp_path}/m"))
    ready = imaging.truth_mask(imaging.preprocess(pairs, size=(8, 8)), rule="equals_255").select("base", "tensor", "truth_mask").cache()
    best = scoring.fit_pixel_scorer(ready.where("base < '4'"), ready.where("base >= '4'"), "base", [0.5, 0.0])
    assert best["dice"] > 0.95 and best["weights"][2] > 5 * abs(best["weights"][0])
    ready.unpersist()


def test_report(spark, tmp_path):
    rows = [("b", 56.25, 0.5, 0.4235, 0.25, True), ("a", 10.0, 0.123, None, None, False)]
    df = spark.createDataFrame(rows, "image string, water_coverage double, avg_confidence double, dice_score double, iou_score double, has_ground_truth boolean")
    s.write_report(df, str(tmp_path / "r"))
    parts = sorted(p for p in os.listdir(tmp_path / "r" / "report") if p.endswith(".txt"))
    text = "".join(open(tmp_path / "r" / "report" / p).read() for p in parts)
    rule = "=" * 40
    assert text == (
        f"Water Segmentation Results Summary\n{rule}\n\n"
        f"Overall Performance (on 1 images with ground truth):\nAverage Dice Score: {0.4235:.3f}\nAverage IoU Score: 0.250\n\n{rule}\n\n"
        f"Image: a\nWater Coverage: 10.0%\nAvg Confidence: 0.123\n{'-' * 30}\n"
        f"Image: b\nWater Coverage: {56.25:.1f}%\nAvg Confidence: 0.500\nDice Score: {0.4235:.3f}\nIoU Score: 0.250\n{'-' * 30}\n"
    )
    assert spark.read.parquet(str(tmp_path / "r" / "summary")).first().images == 2
    s.write_report(df.where("NOT has_ground_truth"), str(tmp_path / "q"))
    text = "".join(open(p).read() for p in sorted(map(str, (tmp_path / "q" / "report").glob("*.txt"))))
    assert "Overall" not in text


def test_folder_scoring(spark, tmp_path):
    dark, half = np.full((6, 4, 3), 2, np.uint8), np.full((4, 4, 3), 2, np.uint8)
    half[:, 2:] = 250
    write_png(f"{tmp_path}/in/dark.png", dark)
    write_png(f"{tmp_path}/in/half.PNG", half)
    with open(f"{tmp_path}/in/broken.bmp", "wb") as out:
        out.write(b"broken")
    write_png(f"{tmp_path}/masks/half.bmp", (half[:, :, 0] > 100).astype(np.uint8) * 255)
    results = s.score_folder(
        spark, f"{tmp_path}/in", f"{tmp_path}/out", scoring.pixel_scorer([1.0, 1.0, 1.0], 0.0), f"{tmp_path}/masks", size=(4, 4)
    )
    got = {r.image: r for r in results.collect()}
    assert set(got) == {"dark", "half"}
    assert got["dark"].water_coverage == 0 and not got["dark"].has_ground_truth
    assert got["half"].water_coverage == 50 and abs(got["half"].dice_score - 1) < 1e-8 and abs(got["half"].iou_score - 1) < 1e-8
    names = {f for f in os.listdir(tmp_path / "out") if f.endswith(".png")}
    assert names == {"dark_mask.png", "dark_confidence.png", "dark_overlay.png", "half_mask.png", "half_confidence.png", "half_comparison.png"}
    assert decode((tmp_path / "out" / "dark_mask.png").read_bytes()).shape == (6, 4)
    mask = decode((tmp_path / "out" / "half_mask.png").read_bytes())
    assert np.array_equal(mask, (half[:, :, 0] > 100) * 255)


def test_tensors_leave_in_parts(spark, monkeypatch):
    """Many small pictures in one batch: parts of bounded size, every row with its own tensor, broken ones without."""
    assert imaging.part_rows((512, 512)) == 1 and imaging.part_rows((16, 16)) == 1302
    monkeypatch.setattr(imaging, "part_rows", lambda size: 7)
    data = F.expr("repeat(char(65 + cast(id % 20 as int)), 12)").cast("binary")
    height = F.when(F.col("id") % 10 == 3, -1).otherwise(2)
    rows = spark.range(0, 100, 1, 2).select("id", F.struct(height.alias("height"), F.lit(2).alias("width"), F.lit(3).alias("nChannels"), data.alias("data")).alias("image"))
    got = imaging.preprocess(rows, (2, 2)).collect()
    assert len(got) == 100
    for r in got:
        want = None if r.id % 10 == 3 else raster.normalise(np.full((2, 2, 3), 65 + r.id % 20, np.uint8)).ravel()
        assert r.tensor is None if want is None else np.array_equal(np.float32(r.tensor), want)


def test_fitted_scorer_prepares_pictures_once(spark, tmp_path, monkeypatch):
    from hydrolens.catalog import images as catalog_images, queries

    staged, plain = [], catalog_images.stage
    monkeypatch.setattr(catalog_images, "stage", lambda df, label: staged.append((label, df.columns)) or plain(df, label))
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=64)]) for i in range(30)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = queries()["fitted_scorer"](spark, str(tmp_path))
    assert staged == [("pairs", ["key", "tensor", "truth_mask"])]
    assert out.first().images > 0 and "vec_id" not in plan_text(out)
