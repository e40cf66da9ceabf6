"""Chunks, rollup refresh, retention, and a stream of closed buckets."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from hydrolens.catalog.registry import register
from hydrolens.functions.time import latest
from hydrolens.plans import maintenance as mt
from hydrolens.plans.prices import monthly_rollup
from hydrolens.session import shared_dir, stage
from hydrolens.sources import fixtures as fx
from hydrolens.sources.tables import append_rows, read_table
from hydrolens.streaming import jobs, silence

OHLC = "round(CAST(close AS DOUBLE), 8) AS close, round(CAST(high AS DOUBLE), 8) AS high, round(CAST(low AS DOUBLE), 8) AS low, round(CAST(open AS DOUBLE), 8) AS open"
MONTH = "CAST(date_trunc('month', date) AS DATE)"
FIRST, LAST = "CAST(arg_min(close, date) AS DOUBLE)", "CAST(arg_max(close, date) AS DOUBLE)"

MEASURES = """count(*) AS images,
  round(avg(water_coverage_percent), 8) AS avg_water_coverage, round(max(water_coverage_percent), 8) AS max_water_coverage,
  round(min(water_coverage_percent), 8) AS min_water_coverage, round(avg(confidence_score), 8) AS avg_confidence,
  round(min(confidence_score), 8) AS min_confidence, round(max(confidence_score), 8) AS max_confidence,
  round(avg(processing_time_ms), 8) AS avg_processing_time, max(processing_time_ms) AS max_processing_time,
  round(count(CASE WHEN confidence_score < 0.5 THEN 1 END) * CAST(100 AS DOUBLE) / count(*), 8) AS error_rate"""


def _fresh_path(spark, label):
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@register(
    "refreshed_rollup",
    f"""
, r AS (SELECT {MONTH} AS month, count(*) AS trading_days, round(avg(close), 8) AS avg_close_price, round(CAST(max(high) AS DOUBLE), 8) AS month_high,
  round(CAST(min(low) AS DOUBLE), 8) AS month_low, CAST(sum(volume) AS BIGINT) AS total_volume,
  round(({LAST} - {FIRST}) / nullif({FIRST}, 0) * 100, 8) AS monthly_return_pct FROM stock GROUP BY 1),
w AS (SELECT CAST(max(date) - INTERVAL '3 months' AS DATE) AS lo, CAST(max(date) - INTERVAL '1 day' AS DATE) AS hi FROM stock)
SELECT month, trading_days, avg_close_price, month_high, month_low,
  CASE WHEN month >= lo AND month + INTERVAL '1 month' <= hi THEN total_volume ELSE -total_volume END AS total_volume, monthly_return_pct
FROM r, w""",
    ("stock",),
)
def _(spark, sf):
    """A stale rollup (volumes negated) whose months inside the refresh window become right again."""
    base = stage(fx.stock(spark, sf), "prices")
    stale = monthly_rollup(base).withColumn("total_volume", -F.col("total_volume"))
    return mt.refreshed_rollup(stale, base, latest(base, "date"))


def _rollup_sql(volume: str) -> str:
    return f"""SELECT {MONTH} AS month, count(*) AS trading_days, round(avg(close), 8) AS avg_close_price, round(CAST(max(high) AS DOUBLE), 8) AS month_high,
  round(CAST(min(low) AS DOUBLE), 8) AS month_low, CAST(sum({volume}) AS BIGINT) AS total_volume,
  round(({LAST} - {FIRST}) / nullif({FIRST}, 0) * 100, 8) AS monthly_return_pct FROM stock GROUP BY 1"""


@register(
    "corrected_rollup",
    _rollup_sql("CASE WHEN date_trunc('month', date) = (SELECT date_trunc('month', max(date)) - INTERVAL '5 months' FROM stock) THEN volume + 1000 ELSE volume END"),
    ("stock",),
)
def _(spark, sf):
    """A correction five months back, upserted and then found by the refresh, which reads that month only."""
    path, rollup, changes = (_fresh_path(spark, label) for label in ("prices", "rollup", "changes"))
    prices = stage(fx.stock(spark, sf), "prices")
    mt.write_chunked(prices, path)
    monthly_rollup(prices).write.parquet(rollup)
    newest = prices.agg(F.max("date")).first()[0]
    month = F.add_months(F.trunc(F.lit(newest), "MM"), -5)
    fixed = prices.where(F.trunc("date", "MM") == month).withColumns({"volume": F.col("volume") + 1000, "at": F.lit(1)})
    mt.upsert_table(spark, path, fixed, ["date"], ["at"], changes=changes)
    mt.refresh_changed(spark, path, rollup, changes, str(newest))
    return spark.read.parquet(rollup)


@register("live_rollup", _rollup_sql("volume"), ("stock",))
def _(spark, sf):
    """A stored rollup that ends a year before the table, read together with the months after it."""
    path, rollup = _fresh_path(spark, "prices"), _fresh_path(spark, "rollup")
    prices = stage(fx.stock(spark, sf), "prices")
    mt.write_chunked(prices, path)
    end = prices.agg(F.add_months(F.trunc(F.max("date"), "MM"), -12)).first()[0]
    monthly_rollup(prices.where(F.col("date") < F.lit(end))).write.parquet(rollup)
    return mt.live_rollup(spark, path, rollup)


@register(
    "retained_prices",
    f"""SELECT date, {OHLC}, volume FROM stock
WHERE {MONTH} + INTERVAL '1 month' > (SELECT max(date) + INTERVAL '2 years' FROM stock) - INTERVAL '7 years'""",
    ("stock",),
)
def _(spark, sf):
    prices = fx.stock(spark, sf)
    return mt.retained(prices, latest(prices, "date", plus="2 years"))


@register(
    "chunked_prices",
    f"SELECT date, {OHLC}, volume FROM stock WHERE date BETWEEN DATE '1996-02-10' AND DATE '2001-03-20'",
    ("stock",),
)
def _(spark, sf):
    path = _fresh_path(spark, "chunks")
    mt.write_chunked(fx.stock(spark, sf), path)
    return mt.read_chunked(spark, path, ("1996-02-10", "2001-03-20"))


@register(
    "upserted_chunks",
    f"""
, fresh AS (SELECT date + 90 AS date, close, high, low, open, volume * 3 AS volume FROM stock)
SELECT date, {OHLC}, volume
FROM (SELECT * FROM stock WHERE date NOT IN (SELECT date FROM fresh) UNION ALL SELECT * FROM fresh)""",
    ("stock",),
)
def _(spark, sf):
    path = _fresh_path(spark, "chunks")
    mt.write_chunked(fx.stock(spark, sf), path)
    moved = mt.read_chunked(spark, path).withColumn("date", F.date_add("date", 90))
    seq = spark.range(2, 4).withColumnRenamed("id", "seq")
    updates = moved.crossJoin(seq).withColumn("volume", F.col("volume") * F.col("seq"))
    mt.upsert_table(spark, path, updates, ["date"], ["seq"])
    return mt.read_chunked(spark, path)


@register(
    "stream_closed_buckets",
    """
, edge AS (SELECT max(timestamp) - INTERVAL '10 minutes' AS mark FROM preds)
SELECT time_bucket(INTERVAL '5 minutes', timestamp) AS time, """
    + MEASURES
    + """ FROM preds, edge GROUP BY 1, mark HAVING time_bucket(INTERVAL '5 minutes', timestamp) + INTERVAL '5 minutes' <= mark""",
    ("preds",),
)
def _(spark, sf):
    """The whole events table as a stream; buckets the watermark has passed, each written once."""
    out, log = _fresh_path(spark, "buckets"), _fresh_path(spark, "bucket-log")
    events = jobs.event_stream(spark, sf)
    buckets = jobs.stream_buckets(events, "5 minutes", "10 minutes")
    jobs.append_stream(buckets, out, log).awaitTermination()
    return (
        spark.read.parquet(out)
        .drop("time_end")
        .withColumn("time", F.col("time").cast("timestamp_ntz"))
    )


@register(
    "stream_critical_alerts",
    """SELECT 'critical_level' AS rule, timestamp AS time, round(water_coverage_percent, 8) AS value FROM preds WHERE water_coverage_percent > 80""",
    ("preds",),
)
def _(spark, sf):
    return _alerts(spark, jobs.critical_alerts(jobs.event_stream(spark, sf)))


@register(
    "stream_degradation_alerts",
    """
, edge AS (SELECT max(timestamp) - INTERVAL '10 minutes' AS mark FROM preds),
slid AS (
  SELECT time_bucket(INTERVAL '5 minutes', timestamp) + k * INTERVAL '5 minutes' + INTERVAL '5 minutes' AS time, confidence_score
  FROM preds, generate_series(0, 5) AS g(k))
SELECT 'degradation' AS rule, time, round(avg(confidence_score), 8) AS value FROM slid, edge
GROUP BY time, mark HAVING time <= mark AND round(avg(confidence_score), 9) < 0.7""",
    ("preds",),
)
def _(spark, sf):
    return _alerts(spark, jobs.degradation_alerts(jobs.event_stream(spark, sf)))


def _alerts(spark, alerts):
    out = _fresh_path(spark, "alerts")
    jobs.append_stream(alerts, out, _fresh_path(spark, "alert-log")).awaitTermination()
    return spark.read.parquet(out).withColumn("time", F.col("time").cast("timestamp_ntz"))


@register(
    "stream_silence",
    """SELECT count(*) AS recent_predictions FROM preds WHERE water_coverage_percent > 80
AND timestamp > (SELECT max(timestamp) FROM preds) - INTERVAL '10 minutes' HAVING count(*) < 5""",
    ("preds",),
)
def _(spark, sf):
    """The scheduled silence rule over the result table of a stream that lets through high rows only."""
    out, log = _fresh_path(spark, "results"), _fresh_path(spark, "results-log")
    events = jobs.event_stream(spark, sf)
    jobs.append_stream(events.where("water_coverage_percent > 80"), out, log).awaitTermination()
    return jobs.silence_alert(spark, out, latest(fx.predictions(spark, sf), "timestamp"))


@register(
    "stream_live_buckets",
    f"SELECT time_bucket(INTERVAL '5 minutes', timestamp) AS time, time_bucket(INTERVAL '5 minutes', timestamp) + INTERVAL '5 minutes' AS time_end, {MEASURES} FROM preds GROUP BY 1",
    ("preds",),
)
def _(spark, sf):
    """Every bucket changed by several batches, kept up to date in a table: nothing waits for the watermark."""
    root = _fresh_path(spark, "live")
    events = fx.table(spark, sf, "events")
    for part in range(3):
        events.where(F.col("event_id") % 3 == part).write.parquet(f"{root}/events/{part}")
    files = len(spark.read.schema(events.schema).parquet(f"{root}/events/*").inputFiles())
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", str(max(1, -(-files // 3)))).parquet(f"{root}/events/*")
    preds = fx.predictions_from(stream).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    jobs.live_buckets(preds, f"{root}/table", f"{root}/checkpoint", "5 minutes", "60 days").awaitTermination()
    rows = jobs.read_live_buckets(spark, f"{root}/table").drop("query", "batch_id")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("time", "time_end")})


def _silences(series: str, floor: int) -> str:
    return f"""
, t AS (SELECT {series} AS series, timestamp, epoch_us(timestamp) AS us FROM preds),
counted AS (
  SELECT series, timestamp, us, count(*) OVER (PARTITION BY series, us) AS held,
         count(*) OVER (PARTITION BY series ORDER BY us RANGE BETWEEN 1 FOLLOWING AND 600000000 FOLLOWING) AS rows
  FROM t)
SELECT DISTINCT series, timestamp + INTERVAL '10 minutes' AS time, rows FROM counted
WHERE rows < {floor} AND rows + held >= {floor} AND (us // 60000000 + 11) * 60000000 <= (SELECT (max(us) - 600000000) // 1000 * 1000 FROM t)"""


@register("stream_gaps", _silences("''", 1), ("preds",))
def _(spark, sf):
    """Each time the whole stream had no row for ten minutes, raised by a timer."""
    return _alerts(spark, silence.silence_alerts(jobs.event_stream(spark, sf), floor=1))


@register("stream_silence_alerts", _silences("location", 5), ("preds",))
def _(spark, sf):
    """Each time a location fell below five rows in ten minutes, raised by a timer for each location."""
    return _alerts(spark, silence.silence_alerts(jobs.event_stream(spark, sf), series="location"))


@register("appended_rows", f"SELECT date, {OHLC}, volume FROM stock", ("stock",))
def _(spark, sf):
    """The price table appended in three parts, one row by itself among them, and read back by its path."""
    path, prices = _fresh_path(spark, "appended"), stage(fx.stock(spark, sf), "prices")
    first = prices.agg(F.min("date").alias("date"))
    parts = [prices.join(first, "date", "left_semi"), *[prices.join(first, "date", "left_anti").where(F.dayofmonth("date") % 2 == odd) for odd in (0, 1)]]
    for part in parts:
        append_rows(part, path)
    return read_table(spark, path)


@register(
    "storage_statistics",
    f"SELECT {MONTH} AS month, true AS stored, true AS sized FROM stock GROUP BY 1",
    ("stock",),
)
def _(spark, sf):
    """Files and bytes of each chunk of the price table; sizes depend on the writer, so only that there are some is shown."""
    path = _fresh_path(spark, "chunks")
    mt.write_chunked(fx.stock(spark, sf), path)
    shown = (F.col("files") >= 1).alias("stored"), F.col("size").rlike("^[0-9]+ (bytes|kB|MB|GB)$").alias("sized")
    return mt.storage_stats(spark, path).select("month", *shown)


@register(
    "maintenance_runs",
    f"""
, m AS (SELECT DISTINCT {MONTH} AS month FROM stock),
old AS (SELECT month, month + INTERVAL '1 month' <= (SELECT max(date) FROM stock) - INTERVAL '3 months' AS closed,
  month + INTERVAL '1 month' <= (SELECT max(date) + INTERVAL '2 years' FROM stock) - INTERVAL '7 years' AS gone FROM m)
SELECT 'compact' AS job, CAST(1 AS INT) AS run, count(CASE WHEN closed THEN 1 END) AS months, min(CASE WHEN closed THEN month END) AS first_month,
  max(CASE WHEN closed THEN month END) AS last_month FROM old
UNION ALL SELECT 'compact', 2, 0, NULL, NULL
UNION ALL SELECT 'retain', 3, count(CASE WHEN gone THEN 1 END), min(CASE WHEN gone THEN month END), max(CASE WHEN gone THEN month END) FROM old""",
    ("stock",),
)
def _(spark, sf):
    """The log of a compaction, of the same again, which finds nothing left to do, and of retention."""
    path, log = _fresh_path(spark, "chunks"), _fresh_path(spark, "log")
    mt.write_chunked(fx.stock(spark, sf), path)
    table = mt.read_chunked(spark, path)
    newest = table.agg(F.max("date").alias("d"), (F.max("date").cast("timestamp_ntz") + F.expr("INTERVAL 2 years")).alias("later")).first()
    runs = [("compact", newest.d), ("compact", newest.d), ("retain", newest.later)]
    for at, (job, as_of) in enumerate(runs, 1):
        work = {"compact": lambda: mt.compact(spark, path, as_of, log=log), "retain": lambda: mt.retain(spark, path, as_of)}[job]
        mt.logged(spark, log, job, path, datetime(2024, 1, at), work)
    months = F.size("months").cast("bigint").alias("months"), F.array_min("months").alias("first_month"), F.array_max("months").alias("last_month")
    return mt.maintenance_log(spark, log).select("job", F.dayofmonth("as_of").alias("run"), *months)
