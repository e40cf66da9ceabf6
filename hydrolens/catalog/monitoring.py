"""Monitoring reports and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolens.catalog.registry import ALL, ALL_TS, register
from hydrolens.functions.time import in_range, latest, since
from hydrolens.operators.ordered import dense_index, ordered_window
from hydrolens.plans import monitoring as m
from hydrolens.sources.fixtures import predictions

BUCKET = {
    "5m": "time_bucket(INTERVAL '5 minutes', timestamp)",
    "10m": "time_bucket(INTERVAL '10 minutes', timestamp)",
    "1h": "time_bucket(INTERVAL '1 hour', timestamp)",
    "1d": "time_bucket(INTERVAL '1 day', timestamp)",
    "1w": "CAST(date_trunc('week', timestamp) AS TIMESTAMP)",
    "1mon": "CAST(date_trunc('month', timestamp) AS TIMESTAMP)",
}
COVER, CONF = "water_coverage_percent", "confidence_score"


def q(name, sql):
    """Register a report that takes only the predictions."""

    def add(build):
        register(name, sql, ("preds",))(lambda spark, folder: build(predictions(spark, folder)))
        return build

    return add


def series(name, report, width, columns):
    """Register a bucketed report."""
    picked = ", ".join(f"{sql} AS {label}" for label, sql in columns.items())
    q(name, f"SELECT {BUCKET[width]} AS time, {picked} FROM preds WHERE {ALL_TS} GROUP BY 1")(lambda p: report(p, ALL))


series(
    "coverage_series",
    m.coverage_series,
    "5m",
    {
        "avg_water_coverage": f"round(avg({COVER}), 8)",
        "max_water_coverage": f"round(max({COVER}), 8)",
        "min_water_coverage": f"round(min({COVER}), 8)",
    },
)
series(
    "confidence_series",
    m.confidence_series,
    "5m",
    {
        "avg_confidence": f"round(avg({CONF}), 8)",
        "min_confidence": f"round(min({CONF}), 8)",
        "max_confidence": f"round(max({CONF}), 8)",
    },
)
series(
    "latency_series",
    m.latency_series,
    "5m",
    {
        "avg_processing_time": "round(avg(processing_time_ms), 8)",
        "max_processing_time": "max(processing_time_ms)",
    },
)
series("images_per_hour", m.images_per_hour, "1h", {"images_processed": "count(*)"})
series(
    "uptime",
    m.uptime,
    "10m",
    {"data_points": "count(*)", "system_status": "CAST(CASE WHEN count(*) = 0 THEN 0 ELSE 1 END AS INT)"},
)
series(
    "error_rate",
    m.error_rate,
    "1h",
    {"error_rate": f"round(count(CASE WHEN {CONF} < 0.5 THEN 1 END) * CAST(100 AS DOUBLE) / count(*), 8)"},
)
series(
    "daily_summary",
    m.daily_summary,
    "1d",
    {
        "avg_daily_coverage": f"round(avg({COVER}), 8)",
        "max_daily_coverage": f"round(max({COVER}), 8)",
        "min_daily_coverage": f"round(min({COVER}), 8)",
        "coverage_stddev": f"round(stddev_samp({COVER}), 8)",
    },
)
series(
    "weekly_trend",
    m.weekly_trend,
    "1w",
    {
        "avg_weekly_coverage": f"round(avg({COVER}), 8)",
        "total_predictions": "count(*)",
        "avg_weekly_confidence": f"round(avg({CONF}), 8)",
    },
)
series(
    "correlation_series",
    m.correlation_series,
    "1h",
    {
        "coverage_confidence_correlation": f"round(covar_pop({COVER}, {CONF}) / nullif(stddev_pop({COVER}) * stddev_pop({CONF}), 0), 8)"
    },
)

q(
    "uptime_filled",
    f"""
, seen AS (SELECT {BUCKET["10m"]} AS time, count(*) AS n FROM preds
  WHERE timestamp BETWEEN TIMESTAMP '2023-12-30 23:57:00' AND TIMESTAMP '2024-02-03 06:00:00' GROUP BY 1),
grid AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-30 23:50:00', TIMESTAMP '2024-02-03 06:00:00', INTERVAL '10 minutes')) AS time)
SELECT grid.time, coalesce(n, 0) AS data_points, CAST(CASE WHEN n IS NULL THEN 0 ELSE 1 END AS INT) AS system_status
FROM grid LEFT JOIN seen ON grid.time = seen.time""",
)(lambda p: m.uptime_filled(p, ("2023-12-30 23:57:00", "2024-02-03 06:00:00")))

q(
    "hour_of_day",
    f"SELECT CAST(hour(timestamp) AS INT) AS hour_of_day, round(avg({COVER}), 8) AS avg_water_coverage FROM preds WHERE {ALL_TS} GROUP BY 1",
)(lambda p: m.hour_of_day(p, ALL))

q(
    "monthly_coverage_statistics",
    f"""SELECT {BUCKET["1mon"]} AS month, count(*) AS total_predictions, round(avg({COVER}), 8) AS avg_water_coverage,
  round(max({COVER}), 8) AS max_water_coverage, round(min({COVER}), 8) AS min_water_coverage,
  round(avg({CONF}), 8) AS avg_confidence, count(CASE WHEN {COVER} > 80 THEN 1 END) AS critical_events
FROM preds WHERE {ALL_TS} GROUP BY 1""",
)(lambda p: m.monthly_statistics(p, ALL))

q(
    "trend",
    f"SELECT timestamp AS time, round({COVER}, 8) AS value FROM preds WHERE {ALL_TS}",
)(lambda p: m.trend(p, ALL))

q(
    "change_rate",
    f"""SELECT timestamp, round({COVER}, 8) AS {COVER},
  round({COVER} - lag({COVER}) OVER (ORDER BY timestamp, image_id), 8) AS coverage_change
FROM preds WHERE {ALL_TS}""",
)(lambda p: m.change_rate(p, ALL))

q(
    "alert_mode",
    f"""SELECT CASE WHEN {COVER} > 80 THEN 'CRITICAL' WHEN {COVER} > 60 THEN 'WARNING' ELSE 'NORMAL' END AS alert_status,
  count(*) AS count FROM preds WHERE {ALL_TS} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
)(lambda p: m.alert_mode(p, ALL))

q(
    "confidence_histogram",
    f"""SELECT CASE WHEN {CONF} >= 0.9 THEN '90-100%' WHEN {CONF} >= 0.8 THEN '80-90%' WHEN {CONF} >= 0.7 THEN '70-80%'
  WHEN {CONF} >= 0.6 THEN '60-70%' ELSE 'Below 60%' END AS confidence_range, count(*) AS prediction_count
FROM preds WHERE {ALL_TS} GROUP BY 1""",
)(lambda p: m.confidence_histogram(p, ALL))

q("model_versions", f"SELECT DISTINCT model_version FROM preds WHERE {ALL_TS}")(lambda p: m.model_versions(p, ALL))

q(
    "outliers",
    f"""
, stats AS (SELECT avg({COVER}) AS mean, stddev_samp({COVER}) AS sd FROM preds WHERE {ALL_TS})
SELECT timestamp, image_id, round({COVER}, 8) AS {COVER}, round({CONF}, 8) AS {CONF},
  round(abs({COVER} - mean) / nullif(sd, 0), 8) AS z_score
FROM preds, stats WHERE {ALL_TS} AND abs({COVER} - mean) / nullif(sd, 0) > 2
ORDER BY abs({COVER} - mean) / nullif(sd, 0) DESC, timestamp DESC, image_id DESC LIMIT 20""",
)(lambda p: m.outliers(p, ALL))

q(
    "current_coverage",
    f"""SELECT round({COVER}, 8) AS "Current Water Coverage %" FROM preds ORDER BY timestamp DESC, image_id DESC LIMIT 1""",
)(m.current_coverage)

q(
    "latest_predictions",
    f"""SELECT timestamp, image_id, image_url, round({COVER}, 8) AS {COVER}, round({CONF}, 8) AS {CONF},
  processing_time_ms, model_version FROM preds ORDER BY timestamp DESC, image_id DESC LIMIT 20""",
)(m.latest_predictions)

q(
    "low_confidence",
    f"""SELECT timestamp, image_id, round({COVER}, 8) AS {COVER}, round({CONF}, 8) AS {CONF}, processing_time_ms
FROM preds WHERE {CONF} < 0.7 AND {ALL_TS} ORDER BY timestamp DESC, image_id DESC LIMIT 50""",
)(lambda p: m.low_confidence(p, ALL))

q(
    "high_water",
    f"""SELECT timestamp, image_id, round({COVER}, 8) AS {COVER}, round({CONF}, 8) AS {CONF}, image_url
FROM preds WHERE {COVER} > 70 AND {ALL_TS} ORDER BY timestamp DESC, image_id DESC LIMIT 10""",
)(lambda p: m.high_water(p, ALL))

q(
    "above_threshold",
    f"SELECT timestamp, image_id, round({COVER}, 8) AS {COVER} FROM preds WHERE {COVER} > 75",
)(lambda p: m.above(p, 75).select("timestamp", "image_id", COVER))

q(
    "warning_band",
    f"SELECT timestamp, image_id, round({COVER}, 8) AS {COVER} FROM preds WHERE {COVER} BETWEEN 60 AND 80",
)(lambda p: m.between(p, 60, 80).select("timestamp", "image_id", COVER))

q(
    "time_filter",
    "SELECT timestamp, image_id FROM preds WHERE timestamp BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-15 12:00:00'",
)(lambda p: in_range(p, "timestamp", ("2024-01-08", "2024-01-15 12:00:00")).select("timestamp", "image_id"))

q(
    "since_three_days",
    "SELECT timestamp, image_id FROM preds WHERE timestamp > (SELECT max(timestamp) FROM preds) - INTERVAL '3 days'",
)(lambda p: since(p, "timestamp", latest(p, "timestamp"), "3 days").select("timestamp", "image_id"))

q(
    "overflow_flags",
    f"SELECT image_id, {COVER} > 80 AS overflow_detected, {COVER} > 60 AS overflow_at_60 FROM preds",
)(
    lambda p: p.select(
        "image_id",
        m.overflow(F.col(COVER)).alias("overflow_detected"),
        m.overflow(F.col(COVER), 60).alias("overflow_at_60"),
    )
)

# Alerts: "now" is the newest critical row plus one minute, so that there is something to see.
NOW = f"(SELECT max(timestamp) + INTERVAL '1 minute' FROM preds WHERE {COVER} > 80)"


def alert_clock(preds):
    return latest(preds.where(F.col(COVER) > 80), "timestamp", plus="1 minute")


def alert(name, sql, report):
    q(name, sql)(lambda p: report(p, alert_clock(p)))


alert(
    "alert_counts",
    f"""SELECT count(CASE WHEN {COVER} > 80 THEN 1 END) AS critical_alerts,
  count(CASE WHEN {COVER} BETWEEN 60 AND 80 THEN 1 END) AS warning_alerts,
  count(CASE WHEN {CONF} < 0.7 THEN 1 END) AS low_confidence_count
FROM preds WHERE timestamp > {NOW} - INTERVAL '24 hours'""",
    m.alert_counts,
)
alert(
    "processing_rate",
    f"""SELECT round(count(*) * CAST(60 AS DOUBLE) /
  nullif((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / CAST(1000000 AS DOUBLE), 0), 8) AS images_per_minute
FROM preds WHERE timestamp > {NOW} - INTERVAL '10 minutes'""",
    m.processing_rate,
)
alert(
    "critical_alert",
    f"""SELECT timestamp, round({COVER}, 8) AS {COVER} FROM preds
WHERE {COVER} > 80 AND timestamp > {NOW} - INTERVAL '5 minutes' ORDER BY timestamp DESC, image_id DESC LIMIT 1""",
    m.critical_alert,
)
alert(
    "degradation_alert",
    f"""SELECT round(avg({CONF}), 8) AS avg_confidence FROM preds
WHERE timestamp > {NOW} - INTERVAL '30 minutes' HAVING round(avg({CONF}), 9) < 0.7""",
    m.degradation_alert,
)
# The pipeline falls silent after the newest row.
q(
    "health_alert",
    """SELECT count(*) AS recent_predictions FROM preds
WHERE timestamp > (SELECT max(timestamp) + INTERVAL '590 seconds' FROM preds) - INTERVAL '10 minutes' HAVING count(*) < 5""",
)(lambda p: m.health_alert(p, latest(p, "timestamp", plus="590 seconds")))

# --- global order ------------------------------------------------------------------------------

q(
    "row_positions",
    "SELECT timestamp, image_id, row_number() OVER (ORDER BY timestamp, image_id) - 1 AS row_index FROM preds",
)(lambda p: dense_index(p.select("timestamp", "image_id"), ["timestamp", "image_id"]))

q(
    "change_rate_by_location",
    f"""SELECT location, image_id,
  round({COVER} - lag({COVER}) OVER w, 8) AS coverage_change,
  round(avg({COVER}) OVER (PARTITION BY location ORDER BY timestamp, image_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 8) AS trailing_mean
FROM preds WINDOW w AS (PARTITION BY location ORDER BY timestamp, image_id)""",
)(
    lambda p: ordered_window(
        p.select("location", "timestamp", "image_id", COVER),
        ["timestamp", "image_id"],
        {
            "coverage_change": lambda w: F.col(COVER) - F.lag(COVER).over(w),
            "trailing_mean": lambda w: F.avg(COVER).over(w.rowsBetween(-29, 0)),
        },
        lookback=29,
        series=["location"],
    ).select("location", "image_id", "coverage_change", "trailing_mean")
)
