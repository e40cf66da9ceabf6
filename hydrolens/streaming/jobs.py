"""Streaming jobs: raw image sink, scoring, live buckets, alerts.

Each job is a query with its own checkpoint. Batches are replayed after a failure, so every sink
is idempotent: objects go to fixed keys, result rows to a folder named by their query and batch id.
What a message yields does not depend on the batch it falls into.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hydrolens.functions.shapes import as_shape
from hydrolens.functions.time import Range
from hydrolens.operators.imaging import LIVE_SIZE, artefact_objects, draw_artefacts, preprocess
from hydrolens.operators.lookup import lookup_join
from hydrolens.operators.scoring import Factory, score
from hydrolens.operators.upsert import latest_per_key
from hydrolens.plans.maintenance import read_chunked, upsert_table
from hydrolens.plans.scoring import prediction_stats
from hydrolens.schemas import PREDICTIONS
from hydrolens.session import delete_path, parallelism, stage_path, staging
from hydrolens.sources import fixtures
from hydrolens.sources.images import read_images
from hydrolens.sources.messages import normalise_messages
from hydrolens.sources.objects import copy_objects, existing_objects, fetch_objects, qualified_root, write_objects

ONCE = {"availableNow": True}
DEDUP_LANES = 32


# --- sinks -------------------------------------------------------------------------------------


def idempotent_append(batch: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch to its own folder; a replay replaces it.

    The folder carries the id of the running query, which its checkpoint keeps, so another query
    on the same table (or the same one with a new checkpoint) replaces nothing.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    batch.write.mode("overwrite").parquet(f"{path}/query={query}/batch_id={batch_id}")


def append_stream(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append rows to a parquet folder, each exactly once."""
    return (
        df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or ONCE)).start(path)
    )


def each_batch(df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None):
    return df.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE)).start()


def upsert_stream(df: DataFrame, path: str, checkpoint: str, keys: list[str], time: str = "time", trigger: dict | None = None):
    """Keep a chunked table equal to a changing aggregate: the rows a batch has changed replace those of the same key.

    Each query has a part of the table to itself (`query`, the id that its checkpoint keeps), so two of them never
    rewrite one chunk. Rows carry `batch_id`, the batch that gave them their last values. Only the months that a batch
    touches are rewritten, beside the table and then put in place, so a batch that is replayed, or dies half-way and is
    repeated, leaves the same table, and readers find each month old or new.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        upsert_table(batch.sparkSession, f"{path}/query={query}", rows, keys, ["batch_id"], time)

    writer = df.writeStream.outputMode("update").foreachBatch(work).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or ONCE)).start()


# Keys of the state lie in files of the executors; all stores of one executor share this much memory.
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",  # else another lookup for each new key
}


@contextmanager
def state_on_disk(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Queries started here keep their state on disk, for state that grows with the rows, as that of `without_repeats`.

    Spark's default keeps all keys in the executors' heap. A query takes its settings when it starts; one that goes on
    from an older checkpoint keeps the kind of store and the partitions that are noted there. Every partition of the state
    is a store with files and memory of its own, however little it holds, and a store on disk may be large: `partitions`
    sets their number, which otherwise is that of the session's shuffles.
    """
    settings = DISK_STATE | ({"spark.sql.shuffle.partitions": str(partitions)} if partitions else {})
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def without_repeats(messages: DataFrame, horizon: str = "1 hour") -> DataFrame:
    """Drop messages the producer sent again: same file name, date, link and picture within the horizon.

    Inline pictures are told apart by a digest of their bytes, so two pictures that a camera sends under one name in
    one second both stay; the state holds digests and no pictures. The horizon counts from arrival, so a message that comes late is never dropped for that. Records
    with an error all stay. In two steps, so that one message sent very often is thinned out in
    as many tasks as read it, up to DEDUP_LANES, before its last copies meet in one; copies that are read
    together take one entry of the first state. Both states have every message of the horizon, so the query
    is to be started within `state_on_disk`.
    """
    same = ["filename", "date", "image_link", "_picture", "_bad"]
    spread = messages.withColumns(
        {
            "_picture": F.sha2("content", 256),
            "_bad": F.when(F.col("error").isNotNull(), F.col("source_id")),
            "_lane": F.pmod(F.spark_partition_id(), F.lit(DEDUP_LANES)),
            "_arrival": F.current_timestamp(),  # of the batch; a replayed batch keeps it
        }
    )
    once_per_lane = spread.withWatermark("_arrival", horizon).dropDuplicatesWithinWatermark([*same, "_lane"])
    return once_per_lane.dropDuplicatesWithinWatermark(same).drop("_lane", "_bad", "_picture", "_arrival")


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable rows, rows with an error)."""
    return df.where("error IS NULL").drop("error"), df.where("error IS NOT NULL")


# --- raw images --------------------------------------------------------------------------------


def _inline_key(prefix: str) -> Column:
    """Key of an inline image: its content and its name, so two images never share a key."""
    return F.concat_ws("/", F.lit(prefix), F.sha2("content", 256), "filename")


def _newest_per_file(messages: DataFrame) -> DataFrame:
    """One row per file name: the key of the newest. Messages of a batch may repeat a name."""
    rows = messages.select("filename", "key", "event_time", "source_id")
    return latest_per_key(rows, ["filename"], ["event_time", "source_id"])


def run_raw_sink(messages: DataFrame, root: str, passed_on: str, checkpoint: str, prefix: str = "images", trigger: dict | None = None):
    """Store every inline image as an object and pass every message on, with the key of its image.

    Each image has the key `images/{digest}/{filename}`; `images/{filename}` is the newest of the
    last batch with that name.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        with staging(batch.sparkSession) as keep:
            rows = keep(normalise_messages(batch), "raw")
            usable = F.expr("error IS NULL AND content IS NOT NULL")
            rows = rows.withColumn("key", F.when(usable, _inline_key(prefix)))
            inline = rows.where(usable)
            write_objects(inline, root)
            newest = _newest_per_file(inline.select("filename", "key", "event_time", "source_id"))
            copy_objects(newest.select("key", F.concat_ws("/", F.lit(prefix), "filename").alias("target")), root)
            linked = rows.withColumn("image_link", F.coalesce("image_link", "key"))
            idempotent_append(linked.drop("content", "key"), passed_on, batch_id)

    return each_batch(messages, work, checkpoint, trigger)


# --- scoring -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Scoring:
    """Settings of the scoring job. Paths: object root, result table, error table.

    With a `horizon`, messages sent again within that time are scored once. How much one batch holds
    is bounded where the messages are read (`read_messages` insists on it).
    """

    root: str
    results: str
    errors: str
    factory: Factory
    model: str = "model"
    size: tuple[int, int] = LIVE_SIZE
    threshold: float = 80
    images_prefix: str = "images"
    horizon: str | None = None
    trigger: dict = field(default_factory=lambda: dict(ONCE))


def run_scoring(messages: DataFrame, conf: Scoring, checkpoint: str):
    """message -> image -> score -> four artefact objects and one result row per message."""
    rows = normalise_messages(messages)
    rows = without_repeats(rows, conf.horizon) if conf.horizon else rows
    with state_on_disk(rows.sparkSession) if conf.horizon else nullcontext():
        return each_batch(rows, lambda batch, batch_id: score_batch(batch, batch_id, conf), checkpoint, conf.trigger)


def score_batch(batch: DataFrame, batch_id: int, conf: Scoring) -> None:
    """One micro-batch of normalised messages. Artefacts are written first, result rows last; both can be repeated.

    An image is read, scored and drawn once however many messages point at it. Records that cannot
    be used go to the error table and never stop the stream.
    """
    with staging(batch.sparkSession) as keep:
        rows = keep(batch, "messages")
        good, bad = split_errors(rows)

        # Inline images become objects, so that both forms go on by key.
        key = F.when(F.col("content").isNotNull(), _inline_key(conf.images_prefix)).otherwise(F.col("image_link"))
        write_objects(good.where("content IS NOT NULL").withColumn("key", key), conf.root)
        linked = good.withColumn("key", key).drop("content")

        known = keep(existing_objects(linked, conf.root), "objects")
        shown = stage_path(batch.sparkSession, "shown")
        scored = keep(score_objects(known, conf, shown), "scored")
        delete_path(batch.sparkSession, shown)
        stats = scored.drop("png")
        # Spark's listing passes over empty files.
        passed_over = known.where("found").join(stats, "key", "left_anti")
        passed_over = passed_over.select("key", F.lit("unreadable object").alias("error"))
        stats = stats.unionByName(passed_over, allowMissingColumns=True)

        # Artefacts are named after the file; of several images with one name the newest wins.
        drawn = scored.where("error IS NULL").select("key", "png")
        named = lookup_join(linked, drawn.select("key"), "key", "inner")
        write_objects(artefact_objects(lookup_join(_newest_per_file(named), drawn, "key", "inner")), conf.root)

        joined = keep(lookup_join(linked, stats.withColumnRenamed("error", "_error"), "key"), "joined")
        failed = joined.where("_error IS NOT NULL").withColumn("error", F.col("_error"))
        told = ["source_id", "filename", "image_link", "date", "error"]
        idempotent_append(bad.select(*told).unionByName(failed.select(*told)), conf.errors, batch_id)
        idempotent_append(_result_rows(joined.where("_error IS NULL")), conf.results, batch_id)


def _result_rows(done: DataFrame) -> DataFrame:
    """Canonical prediction rows with the identity of their message."""
    rows = done.withColumn("timestamp", F.col("event_time").cast("timestamp_ntz"))
    return rows.select(
        "source_id",
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in PREDICTIONS.fields
        ],
    )


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Let a task look up many paths; by default each path of a long list is a task of its own."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, str(4 * parallelism(spark)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


SCORED = (
    "key string, model_name string, water_coverage double, avg_confidence double, overflow_detected boolean, "
    "png struct<originals binary, predictions binary, confidence_maps binary, overlay binary>, error string"
)


def score_objects(known: DataFrame, conf: Scoring, shown: str) -> DataFrame:
    """Score and draw each object of `known` (key, found): the columns of SCORED, one row per key.

    Only the paths of this batch are read. They pass the driver as text, at most one per message
    of the batch, whose size is bounded where messages are read (BOUNDS); image bytes stay on the
    executors. Spark's listing passes over names that start with '_' or '.', so such objects are read
    from copies with other names in the folder `shown`.
    """
    spark, root = known.sparkSession, qualified_root(known.sparkSession, conf.root)
    nothing = spark.createDataFrame([], SCORED)
    lost = known.where("NOT found").select("key", F.lit("missing object").alias("error"))
    # Characters of path patterns stand for themselves in a key.
    literal = re.compile(r"([\[\]{}*?\\])")
    hidden = F.rlike("key", F.lit(r"(^|/)[_.][^/]*$"))
    present = known.where("found").withColumn("hidden", hidden)
    paths = [literal.sub(r"\\\1", f"{root}/{r.key}") for r in present.where("NOT hidden").select("key").collect()]
    images = None
    if paths:
        bare = re.sub("^[a-z0-9]+:/+", "/", root) if root.startswith("file:") else root.split("://")[-1]
        with few_listing_tasks(spark):
            found = read_images(spark, paths, types=None)
        images = found.select(F.substr("path", F.instr("path", bare) + F.lit(len(bare) + 1)).alias("key"), "image")
    renamed = present.where("hidden").select("key", F.sha2("key", 256).alias("target"))
    if renamed.limit(1).count():
        copy_objects(renamed, root, shown)
        copies = read_images(spark, shown, types=None).withColumnRenamed("name", "target")
        copies = copies.join(renamed, "target").select("key", "image")
        images = copies if images is None else images.unionByName(copies)
    if images is None:
        return nothing.unionByName(lost, allowMissingColumns=True)
    tensors = preprocess(images.where("image.height > 0"), conf.size)
    scored = prediction_stats(score(tensors, conf.factory, "tensor", [*conf.size, 3], conf.model), conf.threshold)
    drawn = draw_artefacts(scored, conf.size).withColumn("error", F.lit(None).cast("string"))
    broken = images.where("image.height <= 0").select("key", F.lit("undecodable image").alias("error"))
    return drawn.select(*nothing.columns).unionByName(broken.unionByName(lost), allowMissingColumns=True)


def linked_contents(messages: DataFrame, root: str) -> DataFrame:
    """Messages with the bytes of their object, or why there are none, for jobs that need the raw file."""
    found = fetch_objects(messages, root, "image_link")
    return messages.join(found.withColumnsRenamed({"key": "image_link", "content": "object", "error": "object_error"}), "image_link", "left")


def live_rows(results: DataFrame) -> DataFrame:
    """Result rows in the layout of the live table."""
    return as_shape(results, "B")


# --- buckets and alerts ------------------------------------------------------------------------


def event_stream(spark: SparkSession, folder: str, options: dict | None = None) -> DataFrame:
    """The events table as a stream of prediction rows with an event time."""
    schema = spark.read.parquet(f"{folder}/events.parquet").schema
    # As a pattern the path may be a file or a folder of files.
    raw = spark.readStream.schema(schema).options(**(options or {})).parquet(f"{folder}/events.parque[t]")
    return fixtures.predictions_from(raw).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def stream_buckets(preds: DataFrame, width: str = "5 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Coverage, confidence, latency, count and error rate per bucket, as the live panels show them.

    Rows later than the watermark are left out. In append mode a bucket appears once it is closed,
    in update mode whenever it changes.
    """
    low = F.count_if(F.col("confidence_score") < 0.5)
    return (
        preds.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", width))
        .agg(
            F.count("*").alias("images"),
            F.avg("water_coverage_percent").alias("avg_water_coverage"),
            F.max("water_coverage_percent").alias("max_water_coverage"),
            F.min("water_coverage_percent").alias("min_water_coverage"),
            F.avg("confidence_score").alias("avg_confidence"),
            F.min("confidence_score").alias("min_confidence"),
            F.max("confidence_score").alias("max_confidence"),
            F.avg("processing_time_ms").alias("avg_processing_time"),
            F.max("processing_time_ms").alias("max_processing_time"),
            (low.cast("double") * 100 / F.count("*")).alias("error_rate"),
        )
        .select(F.col("window.start").alias("time"), F.col("window.end").alias("time_end"), F.col("*"))
        .drop("window")
    )


def live_buckets(preds: DataFrame, path: str, checkpoint: str, width: str = "5 minutes", lateness: str = "10 minutes", trigger: dict | None = None):
    """Keep `stream_buckets` in a table as they change, so that panels need not wait for the watermark (`read_live_buckets`)."""
    return upsert_stream(stream_buckets(preds, width, lateness), path, checkpoint, ["time"], "time", trigger)


def read_live_buckets(spark: SparkSession, path: str, query: str | None = None, rng: Range = None) -> DataFrame:
    """The table of `live_buckets` as it is now, of one query or of all, in a closed range of times."""
    rows = read_chunked(spark, path, rng, "time")
    return rows if query is None else rows.where(F.col("query") == query)


def critical_alerts(preds: DataFrame, limit: float = 80) -> DataFrame:
    """Each row above the critical level, as it arrives."""
    return preds.where(F.col("water_coverage_percent") > limit).select(
        F.lit("critical_level").alias("rule"), F.col("timestamp").alias("time"), F.col("water_coverage_percent").alias("value")
    )


def degradation_alerts(preds: DataFrame, limit: float = 0.7, span: str = "30 minutes", step: str = "5 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Sliding windows whose mean confidence is below the limit, once they are closed."""
    return (
        preds.withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", span, step))
        .agg(F.avg("confidence_score").alias("value"))
        .where(F.round("value", 9) < limit)
        .select(F.lit("degradation").alias("rule"), F.col("window.end").alias("time"), "value")
    )


def silence_alert(spark: SparkSession, results: str, as_of=None, floor: int = 5) -> DataFrame:
    """Too few rows in the last ten minutes, asked on a schedule over the result table.

    `silence.silence_alerts` is the rule as a stream of its own, which speaks up by itself.
    """
    from hydrolens.plans.monitoring import health_alert

    return health_alert(spark.read.parquet(results), as_of, floor)


def stream_alerts(preds: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> list:
    """Start the two alert queries; each writes to its own folder below `path`."""
    rules = {"critical_level": critical_alerts(preds), "degradation": degradation_alerts(preds)}
    return [append_stream(df, f"{path}/{name}", f"{checkpoint}/{name}", trigger) for name, df in rules.items()]


def await_rows(spark: SparkSession, path: str, query, rows: int = 1) -> DataFrame:
    """Let a query process all it has, then return its table; raise when it holds too few rows."""
    query.processAllAvailable() if query.isActive else query.awaitTermination()
    table = spark.read.parquet(path)
    if table.limit(rows).count() < rows:
        raise TimeoutError(f"fewer than {rows} rows in {path}")
    return table
