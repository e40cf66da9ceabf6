"""Uploads, objects, locations and layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolens.catalog.registry import register
from hydrolens.functions.shapes import as_shape, from_shape
from hydrolens.functions.text import id_json, media_type, normalise_names, size_text
from hydrolens.operators.lookup import pair_by_name, unpaired
from hydrolens.operators.upsert import upsert_rows
from hydrolens.plans import uploads as u
from hydrolens.sources import fixtures as fx
from hydrolens.sources.messages import normalise_messages, parse_messages

# --- upload log --------------------------------------------------------------------------------


@register(
    "validate_uploads",
    """
, named AS (SELECT event_id, concat(filename, ['', '.png', '.TIFF', '.gif', '.exe', '.', '.webp'][1 + event_id % 7]) AS filename, file_size FROM upload_log)
SELECT event_id, filename, file_size <= 52428800 AS size_ok, event_id % 7 IN (0, 1, 2) AS type_ok FROM named""",
    ("upload_log",),
)
def _(spark, sf):
    """Names with seven endings, three of them accepted types."""
    endings = F.array(*[F.lit(x) for x in ("", ".png", ".TIFF", ".gif", ".exe", ".", ".webp")])
    named = fx.upload_log(spark, sf).withColumn("filename", F.concat("filename", F.get(endings, (F.col("event_id") % 7).cast("int"))))
    return u.validate_uploads(named).select("event_id", "filename", "size_ok", "type_ok")


@register(
    "already_uploaded",
    """
, incoming AS (SELECT doc_id, concat('img_', CAST(doc_id % 400 AS VARCHAR), '.jpg') AS filename FROM documents)
SELECT doc_id, filename, filename IN (SELECT filename FROM upload_log WHERE success) AS already_uploaded FROM incoming""",
    ("upload_log",),
)
def _(spark, sf):
    name = F.concat(F.lit("img_"), (F.col("doc_id") % 400).cast("string"), F.lit(".jpg"))
    incoming = fx.table(spark, sf, "documents").select("doc_id", name.alias("filename"))
    return u.mark_already_uploaded(incoming, fx.upload_log(spark, sf))


@register(
    "upload_statistics",
    """SELECT count(*) AS total_uploads, count(CASE WHEN success THEN 1 END) AS successful,
  count(CASE WHEN NOT success THEN 1 END) AS failed,
  round(count(CASE WHEN success THEN 1 END) / CAST(count(*) AS DOUBLE) * 100, 8) AS success_pct,
  round(CAST(sum(file_size) AS DOUBLE) / 1048576, 8) AS total_mb FROM upload_log""",
    ("upload_log",),
)
def _(spark, sf):
    return u.upload_statistics(fx.upload_log(spark, sf))


RECENT = """SELECT filename, success, strftime(timestamp, '%H:%M:%S') AS timestamp,
  printf('%.2f MB', file_size / CAST(1048576 AS DOUBLE)) AS size, file_size, error
FROM upload_log {} ORDER BY upload_log.timestamp DESC, event_id DESC LIMIT {}"""


@register("recent_uploads", RECENT.format("", 5), ("upload_log",))
def _(spark, sf):
    return u.recent_uploads(fx.upload_log(spark, sf), "event_id")


@register("latest_success", RECENT.format("WHERE success", 1), ("upload_log",))
def _(spark, sf):
    return u.latest_success(fx.upload_log(spark, sf), "event_id")


@register(
    "size_texts",
    """SELECT event_id, CASE WHEN file_size < 10240 THEN concat(CAST(file_size AS VARCHAR), ' bytes')
  WHEN (file_size >> 9) < 20479 THEN concat(CAST(((file_size >> 9) + 1) >> 1 AS VARCHAR), ' kB')
  WHEN (file_size >> 19) < 20479 THEN concat(CAST(((file_size >> 19) + 1) >> 1 AS VARCHAR), ' MB')
  ELSE concat(CAST(((file_size >> 29) + 1) >> 1 AS VARCHAR), ' GB') END AS size FROM upload_log""",
    ("upload_log",),
)
def _(spark, sf):
    return fx.upload_log(spark, sf).select("event_id", size_text(F.col("file_size")).alias("size"))


@register(
    "media_types",
    """
, urls AS (SELECT page_id AS id, url AS name FROM pages UNION ALL SELECT event_id, filename FROM upload_log
  UNION ALL SELECT doc_id, concat('Scan.', CAST(doc_id AS VARCHAR), '.', upper(['gif', 'svg', 'tiff', 'webp', 'bmp'][1 + doc_id % 5])) FROM documents)
SELECT id, name, CASE WHEN NOT contains(name, '.') THEN 'image/png' ELSE coalesce(
  CASE lower(regexp_extract(name, '[^.]*$')) WHEN 'png' THEN 'image/png' WHEN 'jpg' THEN 'image/jpeg' WHEN 'jpeg' THEN 'image/jpeg'
  WHEN 'gif' THEN 'image/gif' WHEN 'webp' THEN 'image/webp' WHEN 'bmp' THEN 'image/bmp' WHEN 'tiff' THEN 'image/tiff'
  WHEN 'svg' THEN 'image/svg+xml' END, 'image/png') END AS content_type FROM urls""",
    ("upload_log",),
)
def _(spark, sf):
    kinds = F.array(*[F.lit(x) for x in ("gif", "svg", "tiff", "webp", "bmp")])
    doc = F.col("doc_id")
    scans = F.concat(F.lit("Scan."), doc.cast("string"), F.lit("."), F.upper(F.get(kinds, (doc % 5).cast("int"))))
    names = (
        fx.table(spark, sf, "pages")
        .select(F.col("page_id").alias("id"), F.col("url").alias("name"))
        .union(fx.upload_log(spark, sf).select("event_id", "filename"))
        .union(fx.table(spark, sf, "documents").select("doc_id", scans))
    )
    return names.withColumn("content_type", media_type(F.col("name")))


# --- objects -----------------------------------------------------------------------------------


@register("list_objects", "SELECT key, size, last_modified FROM objects WHERE starts_with(key, 'uploads/')", ("objects",))
def _(spark, sf):
    return u.objects_under(fx.objects(spark, sf), "uploads/")


@register("object_count", "SELECT count(*) AS count FROM objects WHERE starts_with(key, 'uploads/')", ("objects",))
def _(spark, sf):
    return u.object_count(fx.objects(spark, sf), "uploads/")


@register(
    "latest_objects",
    """SELECT regexp_extract(key, '^uploads/[^_]*_(.*)$', 1) AS filename, arg_max(key, (last_modified, key)) AS key,
  max(last_modified) AS last_modified FROM objects GROUP BY 1""",
    ("objects",),
)
def _(spark, sf):
    return u.latest_objects(fx.objects(spark, sf))


@register(
    "latest_object_of_file",
    """SELECT 'img_17.jpg' AS filename, arg_max(key, (last_modified, key)) AS key, max(last_modified) AS last_modified
FROM objects WHERE regexp_extract(key, '^uploads/[^_]*_(.*)$', 1) = 'img_17.jpg'""",
    ("objects",),
)
def _(spark, sf):
    return u.latest_object(fx.objects(spark, sf), "img_17.jpg")


# --- locations and messages --------------------------------------------------------------------

LOCATED = """
, parsed AS (
  SELECT event_id, CASE WHEN length(x_forwarded_for) > 0 THEN trim(split_part(x_forwarded_for, ',', 1)) ELSE client_host END AS addr
  FROM client_ips),
numbered AS (
  SELECT *, addr IN ('127.0.0.1', '::1', 'localhost') OR starts_with(addr, '192.168.') OR starts_with(addr, '10.') AS local,
    ((CAST(split_part(addr, '.', 1) AS BIGINT) * 256 + CAST(split_part(addr, '.', 2) AS BIGINT)) * 256
     + CAST(split_part(addr, '.', 3) AS BIGINT)) * 256 + CAST(split_part(addr, '.', 4) AS BIGINT) AS number
  FROM parsed),
located AS (
  SELECT event_id,
    CASE WHEN local OR country IS NOT NULL THEN addr ELSE '0.0.0.0' END AS ip,
    CASE WHEN local THEN 'Development' ELSE coalesce(country, 'Unknown') END AS country,
    CASE WHEN local THEN 'Local' ELSE coalesce(region, 'Unknown') END AS region,
    CASE WHEN local THEN 'Localhost' ELSE coalesce(city, 'Unknown') END AS city,
    CASE WHEN local THEN CAST(40.7128 AS DOUBLE) ELSE coalesce(lat, 0) END AS lat,
    CASE WHEN local THEN CAST(-74.0060 AS DOUBLE) ELSE coalesce(lon, 0) END AS lon
  FROM numbered LEFT JOIN geo_ranges ON NOT local AND number BETWEEN ip_from AND ip_to)
"""


def _located(spark, sf):
    return u.enrich_location(fx.client_ips(spark, sf), fx.geo_ranges(spark, sf)).drop("x_forwarded_for", "client_host")


@register(
    "upload_locations",
    LOCATED.replace(
        "FROM client_ips)",
        """FROM (SELECT event_id, CASE WHEN event_id % 13 > 0 THEN x_forwarded_for END AS x_forwarded_for,
    CASE WHEN event_id % 13 > 0 THEN client_host END AS client_host FROM client_ips))""",
    )
    + "SELECT * FROM located",
    ("client_ips", "geo_ranges"),
)
def _(spark, sf):
    """Every thirteenth client has no address at all."""
    clients = fx.client_ips(spark, sf)
    clients = clients.withColumns({c: F.when(F.col("event_id") % 13 > 0, F.col(c)) for c in ("x_forwarded_for", "client_host")})
    return u.enrich_location(clients, fx.geo_ranges(spark, sf)).drop("x_forwarded_for", "client_host")


@register(
    "upload_locations_mixed",
    """
, spelt AS (
  SELECT event_id, event_id % 8 AS turn, 20 + user_id % 200 AS net, user_id % 256 AS host, printf('%04x', CAST(3328 + user_id % 40 AS INTEGER)) AS site, user_id % 2 AS odd FROM events),
hexed AS (
  SELECT *, net * 16777216 + host * 65536 + 7 AS number,
    CASE turn WHEN 1 THEN '2001' || site || repeat('0', 20) || printf('%04x', CAST(host AS INTEGER))
      WHEN 2 THEN '2001' || site || '8000' || repeat('0', 16) || printf('%04x', CAST(host AS INTEGER))
      WHEN 5 THEN '2001' || site || '7fff' || repeat('0', 16) || printf('%04x', CAST(host AS INTEGER)) END AS digits
  FROM spelt),
networks AS (
  SELECT '2001' || printf('%04x', CAST(3328 + n_nationkey AS INTEGER)) AS start, 32 AS bits, n_name AS country, r_name AS region, concat(n_name, ' City') AS city,
    CAST(n_nationkey AS DOUBLE) AS lat, CAST(n_nationkey * -2 AS DOUBLE) AS lon FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT '2001' || printf('%04x', CAST(3328 + n_nationkey AS INTEGER)) || '8', 36, n_name, r_name, concat(n_name, ' North'),
    CAST(n_nationkey AS DOUBLE), CAST(n_nationkey * -2 AS DOUBLE) FROM nation JOIN region ON n_regionkey = r_regionkey),
limits AS (
  SELECT rpad(start, 32, '0') AS low, rpad(start, 32, 'f') AS high, * EXCLUDE (start) FROM networks
  UNION ALL SELECT rpad('20010c00', 32, '0'), rpad('20010fff', 32, 'f'), 22, NULL, r_name, NULL, NULL, NULL FROM region WHERE r_regionkey = 0),
six AS (
  SELECT event_id, arg_max({'country': country, 'region': region, 'city': city, 'lat': lat, 'lon': lon}, bits) AS place
  FROM hexed JOIN limits ON digits BETWEEN low AND high GROUP BY event_id),
four AS (
  SELECT event_id, {'country': country, 'region': region, 'city': city, 'lat': lat, 'lon': lon} AS place
  FROM hexed JOIN geo_ranges ON turn IN (0, 3, 4) AND number BETWEEN ip_from AND ip_to),
found AS (FROM six UNION ALL FROM four)
SELECT event_id, turn = 6 AS local, turn <> 6 AND place IS NULL AS lost,
  CASE WHEN turn = 6 THEN 'Development' ELSE coalesce(place.country, 'Unknown') END AS country,
  CASE WHEN turn = 6 THEN 'Local' ELSE coalesce(place.region, 'Unknown') END AS region,
  CASE WHEN turn = 6 THEN 'Localhost' ELSE coalesce(place.city, 'Unknown') END AS city,
  CASE WHEN turn = 6 THEN CAST(40.7128 AS DOUBLE) ELSE coalesce(place.lat, 0) END AS lat,
  CASE WHEN turn = 6 THEN CAST(-74.0060 AS DOUBLE) ELSE coalesce(place.lon, 0) END AS lon
FROM hexed LEFT JOIN found USING (event_id)""",
    ("geo_ranges",),
)
def _(spark, sf):
    """Clients with IPv4, IPv6 and IPv4 inside IPv6, in eight spellings; the longest of the nested networks wins."""
    found = u.enrich_location(fx.mixed_ips(spark, sf), fx.geo_ranges(spark, sf), fx.geo_networks(spark, sf))
    return found.select("event_id", (F.col("city") == "Localhost").alias("local"), (F.col("ip") == u.UNKNOWN_IP).alias("lost"), "country", "region", "city", "lat", "lon")


MESSAGE_ROWS = (
    LOCATED
    + """, messages AS (
  SELECT CAST(epoch_us(timestamp) // 1000 AS VARCHAR) AS key, filename,
    concat('uploads/', CAST(epoch_us(timestamp) // 1000 AS VARCHAR), '_', filename) AS image_link,
    CASE WHEN epoch_us(timestamp) % 1000000 = 0 THEN strftime(timestamp, '%Y-%m-%dT%H:%M:%S')
         ELSE strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%f') END AS date, file_size, lat, lon
  FROM upload_log JOIN located USING (event_id))
"""
)


def _messages(spark, sf):
    # Both sides have a row for each upload: neither is to be broadcast, however small its files are.
    located = _located(spark, sf).select("event_id", "lat", "lon").hint("merge")
    rows = fx.upload_log(spark, sf).join(located, "event_id")
    return u.build_messages(rows)


@register("upload_messages", MESSAGE_ROWS + "SELECT * FROM messages", ("client_ips", "geo_ranges", "upload_log"))
def _(spark, sf):
    return _messages(spark, sf)


@register(
    "unified_messages",
    MESSAGE_ROWS
    + """SELECT filename, image_link, date, file_size, round(lat, 8) AS lat, round(lon, 8) AS lon, 'unknown' AS location,
  CAST(0 AS BIGINT) AS processing_time_ms, 'unet++' AS model_version, CAST(NULL AS VARCHAR) AS payload FROM messages
UNION ALL
SELECT CASE WHEN doc_id % 5 = 0 THEN 'unknown' ELSE concat('doc_', CAST(doc_id AS VARCHAR)) END, NULL, '2024-01-01T00:00:00',
  CAST(octet_length(encode(text)) AS BIGINT), NULL, NULL, 'unknown', doc_id % 300, concat('v', CAST(doc_id % 3 AS VARCHAR)), text FROM documents""",
    ("client_ips", "geo_ranges", "upload_log"),
)
def _(spark, sf):
    """Both message forms as JSON text, parsed and brought to one shape."""
    linked = _messages(spark, sf).drop("key").select(F.to_json(F.struct("*")).alias("value"))
    doc = fx.table(spark, sf, "documents")
    inline = doc.select(
        F.to_json(
            F.struct(
                F.when(F.col("doc_id") % 5 > 0, F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))).alias("filename"),
                (F.col("doc_id") % 300).alias("processing_time_ms"),
                F.concat(F.lit("v"), (F.col("doc_id") % 3).cast("string")).alias("model_version"),
                F.base64(F.encode("text", "UTF-8")).alias("image"),
                F.lit("2024-01-01T00:00:00").alias("date"),
                F.col("doc_id").alias("message_id"),
                F.octet_length("text").cast("bigint").alias("file_size"),
            )
        ).alias("value")
    )
    unified = normalise_messages(parse_messages(linked.union(inline)))
    return unified.select(
        "filename",
        "image_link",
        "date",
        "file_size",
        "lat",
        "lon",
        "location",
        "processing_time_ms",
        "model_version",
        F.decode("content", "UTF-8").alias("payload"),
    )


@register("id_records", """SELECT event_id, concat('{"id": ', CAST(event_id AS VARCHAR), '}') AS record FROM events""")
def _(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", id_json("event_id").alias("record"))


@register(
    "normalised_names",
    """SELECT n_nationkey AS nation_key, n_name AS nation_name, r_name AS nested_region FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, sf):
    nation, region = fx.table(spark, sf, "nation"), fx.table(spark, sf, "region")
    wild = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("Nation Key"),
        F.col("n_name").alias("NATION Name"),
        F.array(F.struct(F.col("r_name").alias("Region NAME"))).alias("In Regions"),
    )
    clean = normalise_names(wild)
    return clean.select("nation_key", "nation_name", F.col("in_regions")[0]["region_name"].alias("nested_region"))


# --- pairing, upsert, layouts ------------------------------------------------------------------


@register(
    "paired_names",
    "SELECT a.vec_id AS key, a.label AS image_label, b.label AS mask_label FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
)
def _(spark, sf):
    return pair_by_name(*_pairs(spark, sf), "key", on_missing="drop")


@register(
    "unpaired_names",
    "SELECT vec_id AS key FROM embeddings WHERE vec_id + 1 NOT IN (SELECT vec_id FROM embeddings)",
)
def _(spark, sf):
    return unpaired(*_pairs(spark, sf), "key").select("key")


def _pairs(spark, sf):
    vectors = fx.table(spark, sf, "embeddings")
    return (
        vectors.select(F.col("vec_id").alias("key"), F.col("label").alias("image_label")),
        vectors.select((F.col("vec_id") - 1).alias("key"), F.col("label").alias("mask_label")),
    )


@register(
    "upserted_prices",
    """
, fresh AS (SELECT date + 365 AS date, close, high, low, open, volume * 3 AS volume FROM stock)
SELECT date, round(CAST(close AS DOUBLE), 8) AS close, round(CAST(high AS DOUBLE), 8) AS high,
  round(CAST(low AS DOUBLE), 8) AS low, round(CAST(open AS DOUBLE), 8) AS open, volume
FROM (SELECT * FROM stock WHERE date NOT IN (SELECT date FROM fresh) UNION ALL SELECT * FROM fresh)""",
    ("stock",),
)
def _(spark, sf):
    prices = fx.stock(spark, sf)
    moved = prices.withColumn("date", F.date_add("date", 365))
    updates = moved.crossJoin(spark.range(2, 4).withColumnRenamed("id", "seq")).withColumn(
        "volume", F.col("volume") * F.col("seq")
    )
    return upsert_rows(prices, updates, ["date"], ["seq"])


SHAPE_SQL = {
    "A": "SELECT timestamp, image_id, image_url, round(water_coverage_percent, 8) AS water_coverage_percent, round(confidence_score, 8) AS confidence_score, processing_time_ms, model_version FROM preds",
    "B": "SELECT timestamp, CAST(NULL AS VARCHAR) AS model_name, CAST(NULL AS VARCHAR) AS filename, round(water_coverage_percent, 8) AS water_coverage, round(confidence_score, 8) AS avg_confidence, CAST(NULL AS BOOLEAN) AS overflow_detected, location FROM preds",
    "C": "SELECT timestamp, CAST(NULL AS VARCHAR) AS image_name, round(water_coverage_percent, 8) AS water_coverage_pct, round(confidence_score, 8) AS avg_confidence, CAST(0 AS DOUBLE) AS iou_score, CAST(0 AS DOUBLE) AS dice_score, false AS overflow_detected, processing_time_ms, model_version, location FROM preds",
    "D": "SELECT timestamp, CAST(NULL AS VARCHAR) AS image_name, round(water_coverage_percent, 8) AS water_coverage_pct, round(confidence_score, 8) AS avg_confidence, CAST(NULL AS BOOLEAN) AS overflow_detected, processing_time_ms, model_version, location FROM preds",
}
for _shape, _sql in SHAPE_SQL.items():
    register(f"layout_{_shape.lower()}", _sql, ("preds",))(
        lambda spark, sf, shape=_shape: as_shape(from_shape(fx.predictions(spark, sf), "A"), shape)
    )
