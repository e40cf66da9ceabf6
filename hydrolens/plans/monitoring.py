"""Reports and alerts over the predictions table.

Every function takes the predictions and returns one report. `rng` is the dashboard's time range,
`as_of` its clock (see functions.time). Columns used: timestamp, image_id, image_url,
water_coverage_percent, confidence_score, processing_time_ms, model_version. Limits carry
`image_id` as a last sort key, so equal timestamps give one answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hydrolens.functions.bands import alert_status, confidence_band, overflow  # noqa: F401
from hydrolens.functions.time import Moment, Range, bucketed, in_range, moment, parse_width, since
from hydrolens.operators.ordered import ordered_window

STRETCH = 10_000  # buckets
TS, COVER, CONF, MS = "timestamp", "water_coverage_percent", "confidence_score", "processing_time_ms"


def _by_bucket(preds: DataFrame, rng: Range, width: str, *aggs: Column, label: str = "time") -> DataFrame:
    rows = in_range(preds, TS, rng)
    return rows.groupBy(bucketed(rows, width, TS).alias(label)).agg(*aggs)


def _newest(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(TS), F.desc("image_id")).limit(n)


def _share(part: Column, name: str) -> Column:
    return (F.count_if(part).cast("double") * 100 / F.count("*")).alias(name)


# --- time series -------------------------------------------------------------------------------


def coverage_series(preds: DataFrame, rng: Range = None) -> DataFrame:
    return _by_bucket(
        preds,
        rng,
        "5m",
        F.avg(COVER).alias("avg_water_coverage"),
        F.max(COVER).alias("max_water_coverage"),
        F.min(COVER).alias("min_water_coverage"),
    ).orderBy("time")


def confidence_series(preds: DataFrame, rng: Range = None) -> DataFrame:
    return _by_bucket(
        preds,
        rng,
        "5m",
        F.avg(CONF).alias("avg_confidence"),
        F.min(CONF).alias("min_confidence"),
        F.max(CONF).alias("max_confidence"),
    ).orderBy("time")


def latency_series(preds: DataFrame, rng: Range = None) -> DataFrame:
    return _by_bucket(
        preds, rng, "5m", F.avg(MS).alias("avg_processing_time"), F.max(MS).alias("max_processing_time")
    ).orderBy("time")


def images_per_hour(preds: DataFrame, rng: Range = None) -> DataFrame:
    return _by_bucket(preds, rng, "1h", F.count("*").alias("images_processed")).orderBy("time")


def uptime(preds: DataFrame, rng: Range = None) -> DataFrame:
    """Rows per ten minutes. Empty buckets do not appear, so the status is 1 throughout."""
    return (
        _by_bucket(preds, rng, "10m", F.count("*").alias("data_points"))
        .withColumn("system_status", F.when(F.col("data_points") == 0, 0).otherwise(1))
        .orderBy("time")
    )


def uptime_filled(preds: DataFrame, rng: Range = None, width: str = "10m") -> DataFrame:
    """As `uptime`, with every bucket of the range, empty ones at status 0. An open end is that of the rows."""
    seen = _by_bucket(preds, rng, width, F.count("*").alias("data_points"))
    n, unit = parse_width(width)
    dtype = preds.schema[TS].dataType
    given = [None if end is None else moment(end, dtype) for end in (rng or (None, None))]
    found = [F.min("time"), F.max("time")]
    ends = seen.agg(F.array(*[f if g is None else F.coalesce(g, f) for g, f in zip(given, found)]).alias("ends"))
    ends = ends.select(F.explode("ends").alias("at")).where("at IS NOT NULL")
    span = ends.select(bucketed(ends, width, "at").alias("at")).agg(F.min("at").alias("lo"), F.max("at").alias("hi")).where("lo IS NOT NULL")
    if unit == "month":
        grid = span.select(F.explode(F.sequence("lo", "hi", F.make_ym_interval(F.lit(0), F.lit(n)))).alias("time"))
    else:
        grid = _steps(span, n * {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit])
    return (
        grid.join(seen, "time", "left")
        .select(
            "time",
            F.coalesce("data_points", F.lit(0)).alias("data_points"),
            F.when(F.col("data_points").isNull(), 0).otherwise(1).alias("system_status"),
        )
        .orderBy("time")
    )


def _steps(span: DataFrame, step: int) -> DataFrame:
    """All times from `lo` to `hi` of a one-row frame. Stretches first, so that a long range is spread over tasks."""
    seconds = F.unix_seconds(F.col("hi").cast("timestamp")) - F.unix_seconds(F.col("lo").cast("timestamp"))
    stretches = span.select(
        "lo", F.floor(seconds / step).alias("last"), F.explode(F.sequence(F.lit(0), F.floor(seconds / step), F.lit(STRETCH))).alias("at")
    ).repartition("at")
    return stretches.select(
        "lo", F.explode(F.sequence("at", F.least("last", F.col("at") + STRETCH - 1))).alias("i")
    ).select((F.col("lo") + F.make_dt_interval(secs=F.col("i") * step)).alias("time"))


def error_rate(preds: DataFrame, rng: Range = None) -> DataFrame:
    return _by_bucket(preds, rng, "1h", _share(F.col(CONF) < 0.5, "error_rate")).orderBy("time")


def daily_summary(preds: DataFrame, rng: Range = None) -> DataFrame:
    return _by_bucket(
        preds,
        rng,
        "1 day",
        F.avg(COVER).alias("avg_daily_coverage"),
        F.max(COVER).alias("max_daily_coverage"),
        F.min(COVER).alias("min_daily_coverage"),
        F.stddev_samp(COVER).alias("coverage_stddev"),
    ).orderBy("time")


def weekly_trend(preds: DataFrame, rng: Range = None) -> DataFrame:
    return _by_bucket(
        preds,
        rng,
        "1 week",
        F.avg(COVER).alias("avg_weekly_coverage"),
        F.count("*").alias("total_predictions"),
        F.avg(CONF).alias("avg_weekly_confidence"),
    ).orderBy("time")


def hour_of_day(preds: DataFrame, rng: Range = None) -> DataFrame:
    rows = in_range(preds, TS, rng)
    return (
        rows.groupBy(F.hour(TS).alias("hour_of_day")).agg(F.avg(COVER).alias("avg_water_coverage")).orderBy("hour_of_day")
    )


def monthly_statistics(preds: DataFrame, rng: Range = None) -> DataFrame:
    return _by_bucket(
        preds,
        rng,
        "1 month",
        F.count("*").alias("total_predictions"),
        F.avg(COVER).alias("avg_water_coverage"),
        F.max(COVER).alias("max_water_coverage"),
        F.min(COVER).alias("min_water_coverage"),
        F.avg(CONF).alias("avg_confidence"),
        F.count_if(F.col(COVER) > 80).alias("critical_events"),
        label="month",
    ).orderBy(F.desc("month"))


def correlation_series(preds: DataFrame, rng: Range = None) -> DataFrame:
    """Hourly Pearson correlation; NULL where a side does not vary.

    Built from moments: the built-in raises on zero variance under ANSI, guarded or not.
    """
    both = F.col(COVER).isNotNull() & F.col(CONF).isNotNull()
    x, y = F.when(both, F.col(COVER)), F.when(both, F.col(CONF))
    return _by_bucket(
        preds,
        rng,
        "1h",
        F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias("coverage_confidence_correlation"),
    ).orderBy("time")


def trend(preds: DataFrame, rng: Range = None) -> DataFrame:
    rows = in_range(preds, TS, rng)
    return rows.select(F.col(TS).alias("time"), F.col(COVER).alias("value")).orderBy(F.asc_nulls_last("time"))


def change_rate(preds: DataFrame, rng: Range = None) -> DataFrame:
    """Coverage and its change from the row before, in time order."""
    rows = in_range(preds, TS, rng).select(TS, "image_id", COVER)
    lagged = ordered_window(rows, [TS, "image_id"], {"_prev": lambda w: F.lag(COVER).over(w)}, lookback=1)
    return lagged.select(TS, COVER, (F.col(COVER) - F.col("_prev")).alias("coverage_change"))


# --- distributions -----------------------------------------------------------------------------


def alert_mode(preds: DataFrame, rng: Range = None) -> DataFrame:
    """The most frequent alert status; equal counts are settled by name."""
    return (
        in_range(preds, TS, rng)
        .groupBy(alert_status(F.col(COVER)).alias("alert_status"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "alert_status")
        .limit(1)
    )


def confidence_histogram(preds: DataFrame, rng: Range = None) -> DataFrame:
    return (
        in_range(preds, TS, rng)
        .groupBy(confidence_band(F.col(CONF)).alias("confidence_range"))
        .agg(F.count("*").alias("prediction_count"))
        .orderBy("confidence_range")
    )


def model_versions(preds: DataFrame, rng: Range = None) -> DataFrame:
    return in_range(preds, TS, rng).select("model_version").distinct().orderBy(F.asc_nulls_last("model_version"))


def outliers(preds: DataFrame, rng: Range = None, sigmas: float = 2, n: int = 20) -> DataFrame:
    """Rows more than `sigmas` standard deviations from the mean, farthest first."""
    rows = in_range(preds, TS, rng)
    # One row by construction (a global aggregate), so the broadcast cannot grow.
    stats = rows.agg(F.avg(COVER).alias("_mean"), F.stddev_samp(COVER).alias("_sd"))
    z = F.try_divide(F.abs(F.col(COVER) - F.col("_mean")), F.col("_sd"))
    return (
        rows.crossJoin(F.broadcast(stats))
        .select(TS, "image_id", COVER, CONF, z.alias("z_score"))
        .where(F.col("z_score") > sigmas)
        .orderBy(F.desc("z_score"), F.desc(TS), F.desc("image_id"))
        .limit(n)
    )


# --- newest rows -------------------------------------------------------------------------------


def current_coverage(preds: DataFrame) -> DataFrame:
    return _newest(preds, 1).select(F.col(COVER).alias("Current Water Coverage %"))


def latest_predictions(preds: DataFrame, n: int = 20) -> DataFrame:
    return _newest(preds, n).select(TS, "image_id", "image_url", COVER, CONF, MS, "model_version")


def low_confidence(preds: DataFrame, rng: Range = None, limit: float = 0.7, n: int = 50) -> DataFrame:
    rows = in_range(preds.where(F.col(CONF) < limit), TS, rng)
    return _newest(rows, n).select(TS, "image_id", COVER, CONF, MS)


def above(preds: DataFrame, threshold: float, rng: Range = None) -> DataFrame:
    """Rows above the dashboard's threshold variable."""
    return in_range(preds.where(F.col(COVER) > F.lit(float(threshold))), TS, rng)


def between(preds: DataFrame, low: float, high: float, rng: Range = None) -> DataFrame:
    """Rows whose coverage lies in the closed band."""
    return in_range(preds.where(F.col(COVER).between(float(low), float(high))), TS, rng)


def high_water(preds: DataFrame, rng: Range = None, threshold: float = 70, n: int = 10) -> DataFrame:
    return _newest(above(preds, threshold, rng), n).select(TS, "image_id", COVER, CONF, "image_url")


# --- alerts ------------------------------------------------------------------------------------


def alert_counts(preds: DataFrame, as_of: Moment = None, interval: str = "24 hours") -> DataFrame:
    """The three alert counters of the last day in one pass."""
    return since(preds, TS, as_of, interval).agg(
        F.count_if(F.col(COVER) > 80).alias("critical_alerts"),
        F.count_if(F.col(COVER).between(60, 80)).alias("warning_alerts"),
        F.count_if(F.col(CONF) < 0.7).alias("low_confidence_count"),
    )


def processing_rate(preds: DataFrame, as_of: Moment = None) -> DataFrame:
    """Images per minute over the span of the last ten minutes; NULL when the span is zero."""
    micros = F.unix_micros(F.col(TS).cast("timestamp"))
    seconds = (F.max(micros) - F.min(micros)) / F.lit(1e6)
    return since(preds, TS, as_of, "10 minutes").agg(
        F.try_divide(F.count("*") * F.lit(60.0), seconds).alias("images_per_minute")
    )


def critical_alert(preds: DataFrame, as_of: Moment = None) -> DataFrame:
    rows = since(preds.where(F.col(COVER) > 80), TS, as_of, "5 minutes")
    return _newest(rows, 1).select(TS, COVER)


def degradation_alert(preds: DataFrame, as_of: Moment = None, limit: float = 0.7) -> DataFrame:
    """Mean confidence of the last half hour, only when it is below the limit.

    Compared at nine places, so that the order in which partial sums meet does not decide a tie.
    """
    mean = since(preds, TS, as_of, "30 minutes").agg(F.avg(CONF).alias("avg_confidence"))
    return mean.where(F.round("avg_confidence", 9) < limit)


def health_alert(preds: DataFrame, as_of: Moment = None, floor: int = 5) -> DataFrame:
    """Row count of the last ten minutes, only when it is below the floor (also at zero)."""
    return (
        since(preds, TS, as_of, "10 minutes")
        .agg(F.count("*").alias("recent_predictions"))
        .where(F.col("recent_predictions") < floor)
    )
