"""Streaming jobs on folders of JSON lines, run to the end of their input."""

import base64
import datetime as dt
import json
import os

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from hydrolens.catalog import jobs as catalog_jobs, queries, uploads as catalog_uploads
from hydrolens.functions import raster
from hydrolens.operators import scoring
from hydrolens.plans import monitoring as m
from hydrolens.session import shared_dir, stage_path
from hydrolens.sources.fixtures import predictions
from hydrolens.sources.messages import normalise_messages, read_messages, stream_messages
from hydrolens.sources.objects import list_objects, qualified_root, write_objects
from hydrolens.streaming import jobs, silence
from tests.conftest import plan_text, write_png


def put_lines(folder, name, messages):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in messages)


def source(folder):
    return {"format": "text", "path": folder, "options": {"maxFilesPerTrigger": "1"}}


def image(shade):
    return np.full((6, 6, 3), shade, np.uint8)


def inline(name, shade, date="2024-01-01T00:00:00"):
    return {"filename": name, "image": base64.b64encode(raster.png(image(shade))).decode(), "date": date, "message_id": 1}


def linked(name, link, date="2024-01-01T00:00:00"):
    return {"filename": name, "image_link": link, "date": date, "file_size": 5, "lat": 1.0, "lon": 2.0}


@pytest.fixture()
def conf(tmp_path):
    return jobs.Scoring(
        root=str(tmp_path / "store"),
        results=str(tmp_path / "results"),
        errors=str(tmp_path / "errors"),
        factory=scoring.pixel_scorer([1.0, 1.0, 1.0], 0.0),
        model="linear",
        size=(8, 8),
    )


def run(spark, tmp_path, conf):
    jobs.run_scoring(read_messages(spark, source(str(tmp_path / "in"))), conf, str(tmp_path / "check")).awaitTermination()
    results = spark.read.parquet(conf.results)
    errors = spark.read.parquet(conf.errors)
    return results, errors


def test_scoring_end_to_end(spark, tmp_path, conf):
    write_png(f"{conf.root}/uploads/1_bright.png", image(250))
    os.makedirs(f"{conf.root}/uploads", exist_ok=True)
    with open(f"{conf.root}/uploads/2_broken.png", "wb") as out:
        out.write(b"broken")
    put_lines(str(tmp_path / "in"), "a.json", [
        linked("bright.png", "uploads/1_bright.png", "2024-01-01T10:00:00"),
        linked("again.png", "uploads/1_bright.png"),
        inline("dark.png", 3),
        linked("lost.png", "uploads/3_lost.png"),
        linked("broken.png", "uploads/2_broken.png"),
        "{not json",
        {"filename": "bad64.png", "image": "***"},
    ])
    results, errors = run(spark, tmp_path, conf)
    got = {r.filename: (r.water_coverage, r.overflow_detected, r.location, r.model_name, r.timestamp) for r in results.collect()}
    noon = dt.datetime(2024, 1, 1)
    assert got == {
        "bright.png": (100.0, True, "unknown", "linear", noon.replace(hour=10)),
        "again.png": (100.0, True, "unknown", "linear", noon),
        "dark.png": (0.0, False, "unknown", "linear", noon),
    }
    assert sorted(r.error for r in errors.collect()) == ["bad base64", "missing object", "not JSON", "undecodable image"]
    for kind in ("originals", "predictions", "confidence_maps", "overlay"):
        assert sorted(os.listdir(f"{conf.root}/{kind}")) == ["again.png", "bright.png", "dark.png"]
    mask = spark.read.format("image").load(f"{conf.root}/predictions/bright.png").first().image
    assert set(bytes(mask.data)) == {255} and (mask.height, mask.width) == (8, 8)
    assert jobs.live_rows(results).columns == ["timestamp", "model_name", "filename", "water_coverage", "avg_confidence", "overflow_detected", "location"]

    # More input: the query goes on where it stopped.
    put_lines(str(tmp_path / "in"), "b.json", [inline("late.png", 250)])
    assert run(spark, tmp_path, conf)[0].count() == 4


def test_replayed_batch_changes_nothing(spark, tmp_path, conf):
    put_lines(str(tmp_path / "in"), "a.json", [inline("x.png", 250), inline("y.png", 3), "junk"])
    raw = spark.read.text(str(tmp_path / "in")).withColumn("source_id", F.sha2("value", 256))
    from hydrolens.sources.messages import parse_messages

    for _ in range(2):
        jobs.score_batch(normalise_messages(parse_messages(raw)), 0, conf)
    assert spark.read.parquet(conf.results).count() == 2
    assert spark.read.parquet(conf.errors).count() == 1


def test_many_files_of_one_object_and_contents(spark, tmp_path, conf):
    write_png(f"{conf.root}/uploads/1_x.png", image(250))
    put_lines(str(tmp_path / "in"), "a.json", [linked(f"f{i}.png", "uploads/1_x.png") for i in range(20)] + [linked("g", "uploads/gone")])
    results, errors = run(spark, tmp_path, conf)
    assert results.count() == 20 and len(os.listdir(f"{conf.root}/overlay")) == 20 and errors.count() == 1
    from hydrolens.sources.messages import parse_messages

    messages = normalise_messages(parse_messages(spark.read.text(str(tmp_path / "in"))))
    found = jobs.linked_contents(messages, conf.root).collect()
    assert sum(r.object is not None for r in found) == 20 and sum(r.object_error is not None for r in found) == 1


def test_repeats_are_scored_once_with_a_horizon(spark, tmp_path, conf):
    from dataclasses import replace

    put_lines(str(tmp_path / "in"), "a.json", [inline("x.png", 250), inline("x.png", 250), "junk", "junk 2"])
    results, errors = run(spark, tmp_path, replace(conf, horizon="1 hour"))
    assert results.count() == 1 and errors.count() == 2


def test_odd_object_names(spark, tmp_path, conf):
    names = ["noext", "a b+%20é.png", "two.dots.jpg", "x[1]{a,b}.png", "st*r?.png", "_hidden.png"]
    for name in names:
        write_png(f"{conf.root}/uploads/{name}", image(250))
    open(f"{conf.root}/uploads/empty.png", "w").close()
    put_lines(str(tmp_path / "in"), "a.json", [linked(n, f"uploads/{n}") for n in [*names, "empty.png"]])
    results, errors = run(spark, tmp_path, conf)
    assert {r.filename for r in results.where("water_coverage = 100").collect()} == set(names) and results.count() == 6
    assert {(r.filename, r.error) for r in errors.collect()} == {("empty.png", "unreadable object")}


def test_nothing_staged_is_left(spark, tmp_path, conf):
    from hydrolens.session import shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    put_lines(str(tmp_path / "in"), "a.json", [inline("x.png", 250)])
    run(spark, tmp_path, conf)
    assert set(os.listdir(folder)) == before


def test_batch_without_any_image(spark, tmp_path, conf):
    put_lines(str(tmp_path / "in"), "a.json", [linked("lost.png", "uploads/none.png"), "junk"])
    results, errors = run(spark, tmp_path, conf)
    assert results.count() == 0 and errors.count() == 2


def test_raw_sink(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "store")
    put_lines(folder, "a.json", [inline("a.png", 1), inline("a.png", 2, "2024-01-02T00:00:00"), inline("b.png", 3), linked("c.png", "k")])
    query = jobs.run_raw_sink(read_messages(spark, source(folder)), root, str(tmp_path / "on"), str(tmp_path / "check"))
    passed = jobs.await_rows(spark, str(tmp_path / "on"), query, 4)
    assert passed.count() == 4
    assert open(f"{root}/images/a.png", "rb").read() == raster.png(image(2))  # the newest wins
    links = [r.image_link for r in passed.where("image_link <> 'k'").collect()]
    assert sorted(open(f"{root}/{k}", "rb").read() for k in links) == sorted(raster.png(image(i)) for i in (1, 2, 3))  # none is lost
    listed = {r.key: r["size"] for r in list_objects(spark, root, "images/").collect()}
    assert set(listed) == {*links, "images/a.png", "images/b.png"}
    with pytest.raises(TimeoutError):
        jobs.await_rows(spark, str(tmp_path / "on"), query, 5)


def test_repeated_messages_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    put_lines(folder, "a.json", [linked("a", "k"), linked("a", "k"), linked("a", "k", "2024-01-01T00:00:01")])
    put_lines(folder, "b.json", [linked("a", "k"), linked("b", "k"), {"filename": "c", "image_link": "k"}, linked("d", "k", "some day")])
    put_lines(folder, "c.json", [{"filename": "e", "image_link": "k"}])
    unique = jobs.without_repeats(normalise_messages(read_messages(spark, source(folder))))
    jobs.append_stream(unique.select("filename", "date"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    names = sorted(r.filename for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert names == ["a", "a", "b", "c", "d", "e"]


def test_different_pictures_of_one_name_and_second_stay(spark, tmp_path, conf):
    from dataclasses import replace

    put_lines(str(tmp_path / "in"), "a.json", [inline("cam.png", 250), inline("cam.png", 3)])
    put_lines(str(tmp_path / "in"), "b.json", [inline("cam.png", 250), {**inline("cam.png", 3), "message_id": 9}, inline("cam.png", 128)])
    results, errors = run(spark, tmp_path, replace(conf, horizon="1 hour"))
    assert sorted(r.water_coverage for r in results.collect()) == [0.0, 100.0, 100.0] and errors.count() == 0
    unique = jobs.without_repeats(normalise_messages(read_messages(spark, source(str(tmp_path / "in")))))
    assert "_picture" not in unique.columns and "content" in unique.columns


def test_published_stream(spark, tmp_path):
    folder = str(tmp_path / "in")
    put_lines(folder, "a.json", [linked("a", "k"), linked("b", "k")])
    df = read_messages(spark, source(folder)).select("filename", "image_link")
    stream_messages(df, "filename", {"format": "json", "path": str(tmp_path / "out")}, str(tmp_path / "check")).awaitTermination()
    rows = spark.read.json(str(tmp_path / "out")).collect()
    assert sorted((r.key, json.loads(r.value)["image_link"]) for r in rows) == [("a", "k"), ("b", "k")]


def test_publish_folder(spark, tmp_path):
    from hydrolens.sources.publish import folder_messages, publish_folder

    for i, name in enumerate(("b.png", "a.png", "c.jpg")):
        write_png(f"{tmp_path}/pics/{name}", image(i))
    write_png(f"{tmp_path}/pics/d.PNG", image(9))  # upper case is not published
    publish_folder(spark, f"{tmp_path}/pics", {"format": "json", "path": str(tmp_path / "out")}, dt.datetime(2024, 1, 1))
    rows = {r.key: json.loads(r.value) for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert {k: v["filename"] for k, v in rows.items()} == {"0": "a.png", "1": "b.png", "2": "c.jpg"}
    first = rows["1"]
    assert base64.b64decode(first["image"]) == open(f"{tmp_path}/pics/b.png", "rb").read()
    assert first["file_size"] == len(base64.b64decode(first["image"])) and first["date"] == "2024-01-01T00:00:00" and first["message_id"] == 1
    assert folder_messages(spark, f"{tmp_path}/pics", dt.datetime(2024, 1, 1)).columns == ["key", "filename", "image", "date", "message_id", "file_size"]


def split_events(spark, folder, parts):
    """The small events table as `parts` files in time order."""
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").orderBy("ts")
    rows = df.collect()
    step = -(-len(rows) // parts)
    for i in range(parts):
        spark.createDataFrame(rows[i * step : (i + 1) * step], df.schema).coalesce(1).write.mode("append").parquet(f"{folder}/{i:02d}")
    return df.schema, len(rows)


def test_buckets_over_several_batches(spark, tmp_path):
    folder = str(tmp_path / "events")
    schema, _ = split_events(spark, folder, 4)
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(folder)
    from hydrolens.sources.fixtures import predictions_from

    preds = predictions_from(raw).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    # Files may arrive in any order, so the lateness covers the whole month.
    buckets = jobs.stream_buckets(preds, "1 hour", "40 days")
    query = buckets.writeStream.outputMode("complete").format("memory").queryName("live").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    got = sorted((r.time, r.images, round(r.error_rate, 9)) for r in spark.table("live").collect())
    batch = predictions(spark, "/root/testdata/sf0.001")
    want = {r.time: r.images_processed for r in m.images_per_hour(batch).collect()}
    rates = {r.time: round(r.error_rate, 9) for r in m.error_rate(batch).collect()}
    assert got == sorted((t, n, rates[t]) for t, n in want.items())


def live_stream(spark, tmp_path, schema, lateness="60 days"):
    from hydrolens.sources.fixtures import predictions_from

    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").option("recursiveFileLookup", "true").parquet(str(tmp_path / "events"))
    preds = predictions_from(raw).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return jobs.live_buckets(preds, str(tmp_path / "table"), str(tmp_path / "check"), "1 hour", lateness)


def test_live_buckets_equal_what_was_read_after_every_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    seen = None
    for part in range(3):  # every bucket is changed by every batch
        some = events.where(F.col("event_id") % 3 == part)
        some.coalesce(1).write.parquet(str(tmp_path / "events" / str(part)))
        seen = some if seen is None else seen.union(some)
        live_stream(spark, tmp_path, events.schema).awaitTermination()
        got = jobs.read_live_buckets(spark, str(tmp_path / "table"))
        from hydrolens.sources.fixtures import predictions_from

        want = jobs.stream_buckets(predictions_from(seen).withColumn("timestamp", F.col("timestamp").cast("timestamp")), "1 hour")
        names = want.columns
        round_all = lambda df: sorted(tuple(round(v, 8) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect())
        assert round_all(got) == round_all(want) and len(names) == 12
        assert got.agg(F.max("batch_id")).first()[0] >= part
    assert got.select("query").distinct().count() == 1


def test_replayed_buckets_and_a_second_query(spark, tmp_path):
    from hydrolens.plans.maintenance import read_chunked, upsert_table

    rows = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23), 1, 0), (dt.datetime(2024, 2, 1), 2, 0)], "time timestamp, images int, batch_id bigint")
    for _ in range(2):
        assert len(upsert_table(spark, str(tmp_path / "t/query=a"), rows, ["time"], ["batch_id"], "time")) == 2
    upsert_table(spark, str(tmp_path / "t/query=b"), rows.limit(1).withColumn("images", F.lit(7)), ["time"], ["batch_id"], "time")
    upsert_table(spark, str(tmp_path / "t/query=a"), rows.limit(1).withColumns({"images": F.lit(5), "batch_id": F.lit(1).cast("bigint")}), ["time"], ["batch_id"], "time")
    assert sorted((r.query, r.images) for r in jobs.read_live_buckets(spark, str(tmp_path / "t")).collect()) == [("a", 2), ("a", 5), ("b", 7)]
    assert jobs.read_live_buckets(spark, str(tmp_path / "t"), "b").first().images == 7
    assert read_chunked(spark, str(tmp_path / "t"), ("2024-02-01", None), "time").count() == 1


SPAN, CELL = 600, 60


def plain_silences(times, floor, now):
    """By trying each moment at which a row leaves the span."""
    out = []
    for t in sorted(set(times)):
        left, held = sum(t < x <= t + SPAN for x in times), times.count(t)
        if left < floor <= left + held and (t // CELL + 1) * CELL + SPAN <= now:
            out.append((t + SPAN, left))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3000), max_size=40), min_size=1, max_size=4), st.integers(1, 4))
def test_thinned_times_raise_the_same_alerts(batches, floor):
    kept, out, top = np.empty(0, np.int64), [], 0
    batches = [sorted(b) for b in np.array_split(sorted(sum(batches, [])), len(batches))]  # in time order, so that none is late
    for batch in [*batches, []]:
        parts = [silence.thinned(np.array(part, np.int64), CELL, floor) for part in (batch[::2], batch[1::2])]
        kept = silence.thinned(np.sort(np.concatenate([kept, *parts])), CELL, floor)
        due = int(np.searchsorted(kept, (top - SPAN) // CELL * CELL))
        out += silence.falls_silent(kept, due, SPAN, floor)
        kept = kept[due:]
        top = max([top, *batch])
    times = [t for b in batches for t in b]
    assert out == plain_silences(times, floor, max(times, default=0))


def at(second, name="a"):
    return (dt.datetime(2024, 1, 1, 12) + dt.timedelta(seconds=second), name)


def put_rows(spark, folder, part, rows):
    spark.createDataFrame(rows, "timestamp timestamp, place string").coalesce(1).write.parquet(f"{folder}/{part}")


def test_a_planted_gap_gives_one_alert(spark, tmp_path):
    folder = str(tmp_path / "rows")
    steady = [at(30 * i) for i in range(40)]  # until 12:19:30
    later = [at(2000 + 30 * i) for i in range(40)]  # from 12:33:20 on
    put_rows(spark, folder, 0, steady[:25])
    put_rows(spark, folder, 1, steady[25:] + [(None, "a")])
    put_rows(spark, folder, 2, later + [at(4000)])
    stream = spark.readStream.schema("timestamp timestamp, place string").option("maxFilesPerTrigger", "1").parquet(f"{folder}/*")
    jobs.append_stream(silence.silence_alerts(stream, floor=1), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    # The gap, and the pause before the last row is over before the watermark, so it does not count yet.
    assert [(r.series, r.time, r.rows) for r in rows] == [("", dt.datetime(2024, 1, 1, 12, 29, 30), 0)]


def test_alerts_by_series_and_bad_settings(spark, tmp_path):
    folder = str(tmp_path / "rows")
    put_rows(spark, folder, 0, [at(0), at(1), at(0, "b"), at(0, None), at(700, "b"), at(5000, "z")])
    stream = spark.readStream.schema("timestamp timestamp, place string").parquet(f"{folder}/*")
    jobs.append_stream(silence.silence_alerts(stream, series="place", floor=2), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    noon = dt.datetime(2024, 1, 1, 12)
    got = {(r.series, r.time, r.rows) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("a", noon + dt.timedelta(seconds=600), 1)}  # the others never had two rows
    for wrong in ({"clock": "wall"}, {"cell": "1 hour"}, {"floor": 0}):
        with pytest.raises(ValueError):
            silence.silence_alerts(stream, **wrong)


def test_silence_is_told_without_any_further_row(spark, tmp_path):
    import time

    folder = str(tmp_path / "rows")
    put_rows(spark, folder, 0, [at(0), at(1), at(2)])
    stream = spark.readStream.schema("timestamp timestamp, place string").parquet(f"{folder}/*")
    alerts = silence.silence_alerts(stream, span="4 seconds", cell="1 second", floor=1, clock="arrival")
    query = jobs.append_stream(alerts, str(tmp_path / "out"), str(tmp_path / "check"), {"processingTime": "1 second"})
    try:
        end = time.time() + 90
        while time.time() < end and not (os.path.isdir(tmp_path / "out") and spark.read.schema(silence.ALERT).parquet(str(tmp_path / "out")).count()):
            time.sleep(1)
    finally:
        query.stop()
    assert [r.rows for r in spark.read.schema(silence.ALERT).parquet(str(tmp_path / "out")).collect()] == [0]


def test_alert_streams(spark, tmp_path):
    events = jobs.event_stream(spark, "/root/testdata/sf0.001")
    for query in jobs.stream_alerts(events, str(tmp_path / "alerts"), str(tmp_path / "check")):
        query.awaitTermination()
    batch = predictions(spark, "/root/testdata/sf0.001")
    critical = spark.read.parquet(str(tmp_path / "alerts" / "critical_level"))
    assert critical.count() == batch.where("water_coverage_percent > 80").count()
    low = spark.read.parquet(str(tmp_path / "alerts" / "degradation"))
    assert low.count() > 0 and low.agg(F.max("value")).first()[0] < 0.7


def test_silence(spark, tmp_path):
    predictions(spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / "r"))
    assert jobs.silence_alert(spark, str(tmp_path / "r")).first().recent_predictions == 0


def test_events_as_a_folder_of_files(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    alerts = jobs.critical_alerts(jobs.event_stream(spark, str(tmp_path)))
    jobs.append_stream(alerts, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    want = predictions(spark, "/root/testdata/sf0.001").where("water_coverage_percent > 80").count()
    assert spark.read.parquet(str(tmp_path / "out")).count() == want


@pytest.mark.parametrize("files", [1, 2, 5])
def test_scores_do_not_depend_on_the_batches(spark, tmp_path, conf, files):
    lines = [inline("cam.png", 250), inline("cam.png", 3, "2024-01-01T00:10:00"), linked("cam.png", "uploads/_x.png"), inline("b.png", 3), "junk"]
    write_png(f"{conf.root}/uploads/_x.png", image(250))
    for i in range(files):
        put_lines(str(tmp_path / "in"), f"{i}.json", lines[i::files])
    results, errors = run(spark, tmp_path, conf)
    got = sorted((r.filename, r.timestamp.minute, r.water_coverage, r.model_version, r.processing_time_ms) for r in results.collect())
    assert got == [("b.png", 0, 0.0, "unet++", 0), ("cam.png", 0, 100.0, "unet++", 0), ("cam.png", 0, 100.0, "unet++", 0), ("cam.png", 10, 0.0, "unet++", 0)]
    assert [r.error for r in errors.collect()] == ["not JSON"]


def test_a_second_query_replaces_nothing(spark, tmp_path, conf):
    put_lines(str(tmp_path / "in"), "a.json", [inline("x.png", 250)])
    run(spark, tmp_path, conf)
    put_lines(str(tmp_path / "more"), "a.json", [inline("y.png", 250), "junk"])
    other = read_messages(spark, source(str(tmp_path / "more")))
    jobs.run_scoring(other, conf, str(tmp_path / "check2")).awaitTermination()
    assert sorted(r.filename for r in spark.read.parquet(conf.results).collect()) == ["x.png", "y.png"]
    assert spark.read.parquet(conf.errors).count() == 1


def test_late_messages_are_kept(spark, tmp_path):
    folder = str(tmp_path / "in")
    put_lines(folder, "a.json", [linked("x", "k", "2024-01-03T00:00:00"), linked("y", "k", "2024-01-03T00:00:00")])
    put_lines(folder, "b.json", [linked("late", "k", "2024-01-01T22:00:00"), linked("x", "k", "2024-01-03T00:00:00")])
    put_lines(folder, "c.json", [linked("later", "k", "2023-01-01T22:00:00")])
    unique = jobs.without_repeats(normalise_messages(read_messages(spark, source(folder))))
    jobs.append_stream(unique.select("filename"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert sorted(r.filename for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["late", "later", "x", "y"]


def test_a_stream_needs_a_bound(spark, tmp_path):
    for bad in ({"format": "text", "path": str(tmp_path)}, {"format": "kafka", "topic": "t", "options": {"maxFilesPerTrigger": "3"}}):
        with pytest.raises(ValueError, match="bound per batch"):
            read_messages(spark, bad)


def test_listing_is_complete(spark, tmp_path):
    root = str(tmp_path / "store")
    keys = ["a.png", "_hidden.png", ".dot", "deep/er/_x/file", "deep/empty", "deep/er.png"]
    blobs = spark.createDataFrame([(k, b"" if k == "deep/empty" else k.encode()) for k in keys], "key string, content binary")
    assert write_objects(blobs, root) == len(keys)
    open(f"{root}/.{'0' * 32}.part", "w").close()  # of a write that did not end
    got = {r.key: r["size"] for r in list_objects(spark, root).collect()}
    assert got == {k: 0 if k == "deep/empty" else len(k) for k in keys}
    assert {r.key for r in list_objects(spark, root, "deep/er").collect()} == {"deep/er/_x/file", "deep/er.png"}
    assert list_objects(spark, str(tmp_path / "none")).count() == 0
    assert qualified_root(spark, root).startswith("file:/")


def test_a_flat_folder_is_listed_in_ranges(spark, tmp_path):
    """400 keys of one folder and some below it, in pages of 16 and ranges of 50: several tasks, and nothing lost or twice."""
    from hydrolens.sources import objects as ob

    root = str(tmp_path / "store")
    keys = [f"images/{i * 7919 % 1000:03d}_ü{i}.png" for i in range(400)] + [f"images/sub/{i}" for i in range(40)] + ["images/_x", "images/.y", "other"]
    write_objects(spark.createDataFrame([(k, k.encode()) for k in keys], "key string, content binary"), root)
    got = list_objects(spark, root, page=16, per_range=50)
    assert sorted((r.key, r["size"]) for r in got.collect()) == sorted((k, len(k.encode())) for k in keys)
    assert sorted(r.key for r in list_objects(spark, root, "images/0", page=16, per_range=50).collect()) == sorted(k for k in keys if k.startswith("images/0"))
    store, base = ob.open_root(root)
    names = sorted(os.listdir(f"{root}/images"))
    cuts = ob._cuts(iter(names), 50)
    assert 6 <= len(cuts) <= 8
    parts = [list(ob.pages(store, base, "images", low, high, 16)) for low, high in zip(["", *cuts], [*cuts, None])]
    assert all(len(page) <= 16 for part in parts for page in part) and all(20 <= sum(map(len, part)) <= 110 for part in parts)
    assert sorted(n for part in parts for page in part for n in page) == names
    assert ob._cuts(iter(["a"] * 3), 2) == [] or ob._cuts(iter(["a"] * 3), 2) == ["a"]
    assert list(ob._names(store, base, "images/_x")) == [] and list(ob._names(store, base, "none")) == []


def test_a_mounted_root_on_a_cluster(spark, monkeypatch):
    """Files below the shared folder are reached by every executor; others of the file system are not."""
    shared, root = shared_dir(spark), stage_path(spark, "store")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://somewhere:7077")
    assert qualified_root(spark, f"{root}/a/") == qualified_root(spark, root) + "/a"
    for other in (f"{shared}-not", f"{root}/../../../own", "/tmp"):
        with pytest.raises(ValueError, match="local to each machine"):
            qualified_root(spark, other)
    assert write_objects(spark.createDataFrame([("a/b", b"x")], "key string, content binary"), root) == 1
    assert [r.key for r in list_objects(spark, root).collect()] == ["a/b"]


@pytest.fixture
def events(spark, tmp_path):
    """A folder with 600 events in twelve files, of four days, and the nations that uploads come from."""
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 576).cast("timestamp_ntz")
    rows = spark.range(0, 600, 1, 12).select(
        F.col("id").alias("event_id"), at.alias("ts"), (F.col("id") % 50).alias("user_id"), F.lit("view").alias("event_type"), F.lit(2.0).alias("value"), F.lit('{"k": 5}').alias("props")
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(0, "N", 0), (1, "M", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    return str(tmp_path)


def batches(checkpoint):
    return len([n for n in os.listdir(f"{checkpoint}/offsets") if n.isdigit()])


def data_files(folder):
    return [n for _, _, names in os.walk(folder) for n in names if n.startswith("part-")]


def test_late_messages_are_written_by_several_tasks(spark, events, monkeypatch):
    """Messages in several files a part, yet three batches (and those that only move the watermark)."""
    monkeypatch.setattr(catalog_jobs, "_messages", lambda s, f: plain(s, f).repartition(12))
    plain, held, append = catalog_uploads._messages, [], jobs.append_stream
    monkeypatch.setattr(jobs, "append_stream", lambda df, path, log: held.append(log) or append(df, path, log))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        got = queries()["late_messages"](spark, events).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(got) == len(set(got)) == 600
    root = held[0].removeprefix("file:").rpartition("/")[0]
    assert len(data_files(f"{root}/messages")) > 6 and batches(f"{root}/checkpoint") <= 4


def test_uploads_are_not_broadcast(spark, events):
    assert "SortMergeJoin [event_id" in plan_text(catalog_uploads._messages(spark, events))


def test_batches_do_not_grow_with_files(spark, tmp_path):
    spark.range(0, 80, 1, 40).select(F.col("id").cast("string")).write.text(f"{tmp_path}/in/x")
    assert catalog_jobs._files_a_batch(spark, f"{tmp_path}/in/*") == 5
    assert catalog_jobs._files_a_batch(spark, f"{tmp_path}/in/x", batches=3, least=1) == 14
    spark.range(0, 8, 1, 2).select(F.col("id").cast("string")).write.text(f"{tmp_path}/few")
    assert catalog_jobs._files_a_batch(spark, f"{tmp_path}/few") == 4


def test_live_buckets_in_three_batches(spark, events, monkeypatch):
    """Events in many files: each bucket is still changed by several batches, of which there are not more for that."""
    held, live = [], jobs.live_buckets
    monkeypatch.setattr(jobs, "live_buckets", lambda preds, path, log, *more: held.append(log) or live(preds, path, log, *more))
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")  # a task for each file
    try:
        rows = queries()["stream_live_buckets"](spark, events).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sum(r.images for r in rows) == 600
    assert 3 <= batches(held[0].removeprefix("file:")) <= 4


def state_files(checkpoint):
    return {os.path.splitext(n)[1] for folder, _, names in os.walk(f"{checkpoint}/state") for n in names if not n.startswith(".") and "_metadata" not in folder} - {".crc"}


def test_state_of_repeats_is_on_disk(spark, events, tmp_path, conf, monkeypatch):
    """No key of the dedup is held in the heap, and the session's own streams stay as they were set."""
    held, append = [], jobs.append_stream
    monkeypatch.setattr(jobs, "append_stream", lambda df, path, log: held.append(log) or append(df, path, log))
    before = {name: spark.conf.get(name, None) for name in jobs.DISK_STATE}
    for name in ("deduplicated_messages", "late_messages"):
        got = queries()[name](spark, events).collect()
        assert len(got) == len(set(got)) == 600
    from dataclasses import replace

    put_lines(str(tmp_path / "in"), "a.json", [inline("x.png", 250), inline("x.png", 250)])
    results, _ = run(spark, tmp_path, replace(conf, horizon="1 hour"))
    assert results.count() == 1
    logs = [log.removeprefix("file:") for log in held] + [str(tmp_path / "check")]
    assert [{".zip"} <= state_files(log) and ".delta" not in state_files(log) for log in logs] == [True] * 3
    assert {name: spark.conf.get(name, None) for name in jobs.DISK_STATE} == before


def test_copies_read_together_take_one_entry(spark, tmp_path):
    put_lines(str(tmp_path / "in"), "a.json", [{**linked("a", "k"), "message_id": i} for i in range(200)])
    unique = jobs.without_repeats(normalise_messages(read_messages(spark, source(str(tmp_path / "in")))))
    with jobs.state_on_disk(spark):
        query = jobs.append_stream(unique.select("filename"), str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination()
    kept = [op.numRowsUpdated for p in query.recentProgress for op in p.stateOperators]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1 and sum(kept) == 2


def test_state_has_no_more_stores_than_cores_use(spark, events, monkeypatch):
    held, append = [], jobs.append_stream
    monkeypatch.setattr(jobs, "append_stream", lambda df, path, log: held.append(log) or append(df, path, log))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        assert queries()["deduplicated_messages"](spark, events).count() == 600
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stores = [n for n in os.listdir(f"{held[0].removeprefix('file:')}/state/0") if n.isdigit()]
    assert len(stores) == 32
