"""Whole jobs over stored objects, messages and chunks: what was written is read back and shown."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolens.catalog.registry import register
from hydrolens.catalog.maintenance import OHLC
from hydrolens.catalog.uploads import MESSAGE_ROWS, _messages
from hydrolens.functions.time import latest
from hydrolens.operators.scoring import pixel_scorer
from hydrolens.plans import maintenance as mt
from hydrolens.session import parallelism, stage, stage_path
from hydrolens.sources import fixtures as fx
from hydrolens.sources.messages import normalise_messages, parse_messages, read_messages, write_messages
from hydrolens.sources.objects import fetch_objects, list_objects, write_objects
from hydrolens.sources.publish import folder_messages
from hydrolens.streaming import jobs


def _stream(spark, folder, files=4):
    """Files of JSON lines as a stream of several batches."""
    return read_messages(spark, {"format": "text", "path": folder, "options": {"maxFilesPerTrigger": str(files)}})


BATCHES = 8


def _files_a_batch(spark, folder, batches=BATCHES, least=4):
    """Files for each of at most `batches` batches: every batch has tasks for all partitions of the state, however little it holds."""
    return max(least, -(-len(spark.read.text(folder).inputFiles()) // batches))


def _state_partitions(spark):
    """Four for each core, and no more than the session's shuffles have."""
    return min(4 * parallelism(spark), int(spark.conf.get("spark.sql.shuffle.partitions")))


def _doc_name():
    return F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".png"))


@register(
    "raw_image_sink",
    """WITH named AS (SELECT concat('doc_', CAST(doc_id AS VARCHAR), '.png') AS name, text FROM documents),
keys AS (SELECT concat('images/', name) AS key, text FROM named UNION ALL SELECT concat('images/', sha256(text), '/', name), text FROM named)
SELECT key, CAST(octet_length(encode(text)) AS BIGINT) AS size, text AS payload FROM keys""",
)
def _(spark, sf):
    """Document texts as opaque image payloads: published inline, stored by the stream, listed and fetched."""
    root = stage_path(spark, "raw")
    payload = F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"\s", "")
    message = F.struct(_doc_name().alias("filename"), payload.alias("image"), F.lit("2024-01-01T00:00:00").alias("date"))
    fx.table(spark, sf, "documents").select(F.to_json(message)).write.text(f"{root}/messages")
    stream = _stream(spark, f"{root}/messages")
    jobs.run_raw_sink(stream, f"{root}/store", f"{root}/passed", f"{root}/checkpoint").awaitTermination()
    listing = list_objects(spark, f"{root}/store", "images/")
    contents = fetch_objects(listing, f"{root}/store")
    return listing.join(contents, "key").select("key", "size", F.decode("content", "UTF-8").alias("payload"))


@register(
    "published_folder",
    """WITH named AS (SELECT concat('doc_', CAST(doc_id AS VARCHAR), '.png') AS filename, text FROM documents)
SELECT CAST(row_number() OVER (ORDER BY filename) - 1 AS VARCHAR) AS key, filename, to_base64(encode(text)) AS image,
  '2024-01-01T00:00:00' AS date, row_number() OVER (ORDER BY filename) - 1 AS message_id, CAST(octet_length(encode(text)) AS BIGINT) AS file_size
FROM named""",
)
def _(spark, sf):
    """A folder of files as inline messages, numbered by path."""
    root = stage_path(spark, "folder")
    docs = fx.table(spark, sf, "documents")
    write_objects(docs.select(_doc_name().alias("key"), F.encode("text", "UTF-8").alias("content")), root)
    return folder_messages(spark, root, F.lit("2024-01-01").cast("timestamp"))


@register(
    "published_messages",
    MESSAGE_ROWS + "SELECT key, filename, image_link, date, file_size, round(lat, 8) AS lat, round(lon, 8) AS lon FROM messages",
    ("client_ips", "geo_ranges", "upload_log"),
)
def _(spark, sf):
    """Upload messages published as (key, JSON value) and parsed again."""
    path = stage_path(spark, "published")
    write_messages(_messages(spark, sf), "key", {"format": "parquet", "path": path})
    return parse_messages(spark.read.parquet(path)).select("key", "filename", "image_link", "date", "file_size", "lat", "lon")


@register(
    "deduplicated_messages",
    MESSAGE_ROWS + "SELECT DISTINCT filename, image_link, date FROM messages",
    ("client_ips", "geo_ranges", "upload_log"),
)
def _(spark, sf):
    """Upload messages, each sent three times, through the stream's dedup."""
    root = stage_path(spark, "repeated")
    sent = _messages(spark, sf).drop("key").crossJoin(spark.range(3).withColumnRenamed("id", "message_id"))
    sent.select(F.to_json(F.struct("*"))).write.text(f"{root}/messages", compression="gzip")
    stream = normalise_messages(_stream(spark, f"{root}/messages", _files_a_batch(spark, f"{root}/messages")))
    unique = jobs.without_repeats(stream, "1 hour").select("filename", "image_link", "date")
    with jobs.state_on_disk(spark, _state_partitions(spark)):
        jobs.append_stream(unique, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register(
    "distinct_pictures",
    """SELECT DISTINCT concat('cam_', CAST(doc_id % 10 AS VARCHAR), '.png') AS filename, sha256(text) AS picture
FROM documents WHERE text IS NOT NULL""",
)
def _(spark, sf):
    """Texts as inline pictures of ten cameras, all of one second and each sent twice: every different picture stays, once."""
    root = stage_path(spark, "cameras")
    camera = F.concat(F.lit("cam_"), (F.col("doc_id") % 10).cast("string"), F.lit(".png"))
    payload = F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"\s", "")
    docs = fx.table(spark, sf, "documents").where("text IS NOT NULL")
    sent = docs.select(camera.alias("filename"), payload.alias("image"), F.lit("2024-01-01T00:00:00").alias("date"), F.explode(F.array(F.lit(1), F.lit(2))).alias("message_id"))
    sent.select(F.to_json(F.struct("*"))).write.text(f"{root}/messages")
    stream = normalise_messages(_stream(spark, f"{root}/messages", _files_a_batch(spark, f"{root}/messages")))
    unique = jobs.without_repeats(stream, "1 hour")
    with jobs.state_on_disk(spark, _state_partitions(spark)):
        jobs.append_stream(unique.select("filename", F.sha2("content", 256).alias("picture")), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register(
    "stream_errors",
    """WITH sent AS (SELECT doc_id, concat('doc_', CAST(doc_id AS VARCHAR), '.png') AS name, doc_id % 7 AS kind FROM documents)
SELECT CASE kind WHEN 0 THEN 'unknown' ELSE name END AS filename,
  CASE kind WHEN 3 THEN concat('a/../', name) WHEN 4 THEN concat('uploads/', name) WHEN 5 THEN concat('stored/', name) WHEN 6 THEN concat('stored/_', name) END AS image_link,
  CASE kind WHEN 0 THEN NULL ELSE '2024-01-01T00:00:00' END AS date,
  CASE kind WHEN 0 THEN 'not JSON' WHEN 1 THEN 'bad base64' WHEN 2 THEN 'no image' WHEN 3 THEN 'path outside the store' WHEN 4 THEN 'missing object'
    ELSE 'undecodable image' END AS error
FROM sent""",
)
def _(spark, sf):
    """Records that cannot be used, in seven ways, through the scoring stream: none is lost and none stops it."""
    root = stage_path(spark, "errors")
    kind, name = F.col("doc_id") % 7, _doc_name()
    link = (
        F.when(kind == 3, F.concat(F.lit("a/../"), name)).when(kind == 4, F.concat(F.lit("uploads/"), name))
        .when(kind == 5, F.concat(F.lit("stored/"), name)).when(kind == 6, F.concat(F.lit("stored/_"), name))
    )
    docs = fx.table(spark, sf, "documents")
    broken = docs.where(kind >= 5).select(link.alias("key"), F.encode(F.concat(F.lit("no picture"), "text"), "UTF-8").alias("content"))
    write_objects(broken, f"{root}/store")
    fields = F.struct(name.alias("filename"), F.when(kind == 1, "***").alias("image"), link.alias("image_link"), F.lit("2024-01-01T00:00:00").alias("date"))
    docs.select(F.when(kind == 0, F.concat(F.lit("{broken "), name)).otherwise(F.to_json(fields))).write.text(f"{root}/messages")
    conf = jobs.Scoring(f"{root}/store", f"{root}/results", f"{root}/errors", pixel_scorer([1.0, 1.0, 1.0], 0.0), "linear", (8, 8))
    jobs.run_scoring(_stream(spark, f"{root}/messages"), conf, f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/errors").select("filename", "image_link", "date", "error")


@register(
    "stored_listing",
    """SELECT concat('uploads/', CASE WHEN doc_id % 4 = 0 THEN '_' WHEN doc_id % 4 = 1 THEN '.' ELSE concat(CAST(doc_id % 10 AS VARCHAR), '/') END, 'doc_', CAST(doc_id AS VARCHAR), '.png') AS key,
  CASE WHEN doc_id % 3 = 0 THEN 0 ELSE CAST(octet_length(encode(text)) AS BIGINT) END AS size FROM documents""",
)
def _(spark, sf):
    """Objects in folders, every third one empty and every second one with a hidden name, listed from the store."""
    root = stage_path(spark, "listing")
    start = F.when(F.col("doc_id") % 4 == 0, "_").when(F.col("doc_id") % 4 == 1, ".").otherwise(F.concat((F.col("doc_id") % 10).cast("string"), F.lit("/")))
    docs = fx.table(spark, sf, "documents").withColumn("content", F.encode(F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("text")), "UTF-8"))
    for folder in ("uploads/", "other/"):
        write_objects(docs.select(F.concat(F.lit(folder), start, _doc_name()).alias("key"), "content"), root)
    return list_objects(spark, root, "uploads/").select("key", "size")


@register("late_messages", MESSAGE_ROWS + "SELECT DISTINCT filename, image_link, date FROM messages", ("client_ips", "geo_ranges", "upload_log"))
def _(spark, sf):
    """Upload messages that arrive newest first, day by day and each twice, through the stream's dedup: none is lost for being late."""
    root = stage_path(spark, "late")
    messages = stage(_messages(spark, sf).drop("key"), "messages")
    sent = messages.crossJoin(spark.range(2).withColumnRenamed("id", "message_id"))  # two constant rows
    days = sorted((r[0] for r in sent.select(F.substring("date", 1, 10)).distinct().collect()), reverse=True)
    for part, day in enumerate((days[: len(days) // 3], days[len(days) // 3 : 2 * len(days) // 3], days[2 * len(days) // 3 :])):
        rows = sent.where(F.substring("date", 1, 10).isin(day))
        rows.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(f"{root}/messages/{part}")
    # The files of one part in each batch, the oldest files, which hold the newest days, first.
    stream = _stream(spark, f"{root}/messages/*", _files_a_batch(spark, f"{root}/messages/*", batches=3, least=1))
    unique = jobs.without_repeats(normalise_messages(stream), "1 hour").select("filename", "image_link", "date")
    with jobs.state_on_disk(spark, _state_partitions(spark)):
        jobs.append_stream(unique, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@register("compacted_chunks", f"SELECT date, {OHLC}, volume FROM stock", ("stock",))
def _(spark, sf):
    """The price table written in four parts, then compacted up to three months before its end."""
    path = stage_path(spark, "chunks")
    prices = fx.stock(spark, sf)
    for part in range(4):
        mt.write_chunked(prices.where(F.dayofmonth("date") % 4 == part), path)
    table = mt.read_chunked(spark, path)
    mt.compact(spark, path, latest(table, "date"))
    return mt.read_chunked(spark, path)


@register(
    "clustered_prices",
    f"""SELECT date, {OHLC}, volume FROM stock
WHERE volume BETWEEN (SELECT quantile_disc(volume, 0.4) FROM stock) AND (SELECT quantile_disc(volume, 0.6) FROM stock) AND close > 150""",
    ("stock",),
)
def _(spark, sf):
    """The price table laid out along a curve through date, volume and close, read by volume and close."""
    path = stage_path(spark, "clustered")
    mt.write_chunked(fx.stock(spark, sf), path)
    mt.cluster(spark, path, ["date", "volume", "close"])
    table = mt.read_chunked(spark, path)
    low, high = table.agg(*[F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY volume)") for q in (0.4, 0.6)]).first()
    return table.where(F.col("volume").between(int(low), int(high)) & (F.col("close") > 150))


@register(
    "retained_chunks",
    f"""SELECT date, {OHLC}, volume FROM stock
WHERE CAST(date_trunc('month', date) AS DATE) + INTERVAL '1 month' > (SELECT max(date) + INTERVAL '2 years' FROM stock) - INTERVAL '7 years'""",
    ("stock",),
)
def _(spark, sf):
    """The price table as chunks, after dropping the months retention lets go."""
    path = stage_path(spark, "chunks")
    mt.write_chunked(fx.stock(spark, sf), path)
    mt.retain(spark, path, latest(mt.read_chunked(spark, path), "date", plus="2 years"))
    return mt.read_chunked(spark, path)
