"""Edges of filters, bands, buckets, reports and alerts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from hydrolens.functions import bands
from hydrolens.functions.time import bucketed, in_range, parse_width, since
from hydrolens.plans import monitoring as m, prices as p
from hydrolens.plans.variables import VARIABLES, variable_values
from tests.conftest import plan_text

PRED = "timestamp timestamp_ntz, image_id bigint, image_url string, water_coverage_percent double, confidence_score double, processing_time_ms bigint, model_version string"


def at(text):
    return dt.datetime.fromisoformat(text)


def preds(spark, rows):
    """rows: (time, coverage, confidence)"""
    return spark.createDataFrame([(at(t), i, "u", c, q, 100 + i, "v1") for i, (t, c, q) in enumerate(rows)], PRED)


def stock(spark, rows):
    """rows: (date, open, high, low, close, volume)"""
    from decimal import Decimal as D

    data = [(dt.date.fromisoformat(d), D(str(c)), D(str(h)), D(str(lo)), D(str(o)), v) for d, o, h, lo, c, v in rows]
    return spark.createDataFrame(data, "date date, close decimal(20,8), high decimal(20,8), low decimal(20,8), open decimal(20,8), volume bigint")


def values(df, *columns):
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()]


def test_bands_at_their_limits(spark):
    df = spark.createDataFrame([(x,) for x in (60.0, 60.01, 80.0, 80.01)], "c double")
    assert values(df.select(bands.alert_status(F.col("c")).alias("s")), "s") == ["NORMAL", "WARNING", "WARNING", "CRITICAL"]
    assert values(df.select(bands.overflow(F.col("c")).alias("s")), "s") == [False, False, False, True]
    conf = spark.createDataFrame([(x,) for x in (0.9, 0.8, 0.7, 0.6, 0.59)], "c double")
    assert values(conf.select(bands.confidence_band(F.col("c")).alias("s")), "s") == ["90-100%", "80-90%", "70-80%", "60-70%", "Below 60%"]
    price = spark.createDataFrame([(x,) for x in (99.99, 100.0, 200.0, 300.0, 400.0)], "c double")
    assert values(price.select(bands.price_band(F.col("c")).alias("s")), "s") == ["Under $100", "$100-200", "$200-300", "$300-400", "Over $400"]


def test_bucket_edges(spark):
    rows = spark.createDataFrame([(at(x),) for x in ("2024-03-03T23:59:59.999999", "2024-03-04T00:00:00", "2024-02-29T12:34:56")], "t timestamp_ntz")

    def starts(width):
        return [r.b.isoformat() for r in rows.select(bucketed(rows, width, "t").alias("b")).collect()]

    assert starts("1w") == ["2024-02-26T00:00:00", "2024-03-04T00:00:00", "2024-02-26T00:00:00"]
    assert starts("1 month") == ["2024-03-01T00:00:00", "2024-03-01T00:00:00", "2024-02-01T00:00:00"]
    assert starts("5m") == ["2024-03-03T23:55:00", "2024-03-04T00:00:00", "2024-02-29T12:30:00"]
    days = rows.select(F.to_date("t").alias("t"))
    assert [r.b.isoformat() for r in days.select(bucketed(days, "1 week", "t").alias("b")).collect()] == ["2024-02-26", "2024-03-04", "2024-02-26"]
    assert isinstance(days.select(bucketed(days, "1 month", "t").alias("b")).schema["b"].dataType, T.DateType)
    old = spark.createDataFrame([(dt.date(1969, 12, 31),), (dt.date(1969, 12, 28),)], "t date")
    assert [r.b.isoformat() for r in old.select(bucketed(old, "1 week", "t").alias("b")).collect()] == ["1969-12-29", "1969-12-22"]


def test_bucket_widths():
    assert parse_width("5m") == (5, "minute") and parse_width("1 week") == (1, "week") and parse_width("10 minutes") == (10, "minute")
    with pytest.raises(ValueError):
        parse_width("soon")


def test_range_is_closed_and_since_is_strict(spark):
    df = preds(spark, [("2024-01-01T00:00:00", 1.0, 0.5), ("2024-01-01T00:10:00", 2.0, 0.5), ("2024-01-01T00:20:00", 3.0, 0.5)])
    assert in_range(df, "timestamp", ("2024-01-01 00:00:00", "2024-01-01 00:10:00")).count() == 2
    assert in_range(df, "timestamp", ("2024-01-01 00:10:00", None)).count() == 2
    assert since(df, "timestamp", at("2024-01-01T00:20:00"), "10 minutes").count() == 1
    days = df.select(F.date_add(F.to_date("timestamp"), F.col("image_id").cast("int")).alias("d"))
    assert [str(r.d) for r in since(days, "d", at("2024-01-04T12:00:00"), "2 days").collect()] == ["2024-01-03"]


def test_reports_on_an_empty_range(spark):
    df = preds(spark, [("2024-01-01T00:00:00", 1.0, 0.5)])
    never = ("2030-01-01", "2030-01-02")
    for report in (m.coverage_series, m.uptime, m.change_rate, m.outliers, m.alert_mode, m.high_water, m.correlation_series):
        assert report(df, never).count() == 0
    assert {r.system_status for r in m.uptime_filled(df, never).collect()} == {0}  # the outage itself is shown


def test_one_row_and_constant_buckets(spark):
    one = preds(spark, [("2024-01-01T00:00:00", 1.0, 0.5)])
    assert values(m.daily_summary(one), "coverage_stddev") == [None]
    assert values(m.processing_rate(one, at("2024-01-01T00:01:00")), "images_per_minute") == [None]
    flat = preds(spark, [("2024-01-01T00:00:00", 5.0, 0.5), ("2024-01-01T00:01:00", 5.0, 0.7), ("2024-01-01T00:02:00", None, 0.9)])
    assert values(m.correlation_series(flat), "coverage_confidence_correlation") == [None]
    assert m.outliers(flat).count() == 0


def test_uptime_filled_across_midnight(spark):
    df = preds(spark, [("2024-01-01T23:45:00", 1.0, 0.5), ("2024-01-02T00:15:00", 1.0, 0.5)])
    got = values(m.uptime_filled(df), "time", "data_points", "system_status")
    assert [(t.strftime("%H:%M"), n, s) for t, n, s in got] == [("23:40", 1, 1), ("23:50", 0, 0), ("00:00", 0, 0), ("00:10", 1, 1)]


def test_uptime_filled_with_any_width(spark):
    df = preds(spark, [("2024-01-01T22:10:00", 1.0, 0.5), ("2024-01-03T01:00:00", 1.0, 0.5)])
    got = values(m.uptime_filled(df, width="7m"), "time", "system_status")
    gaps = {(b - a).total_seconds() for (a, _), (b, _) in zip(got, got[1:])}
    assert gaps == {420.0} and [s for _, s in got] == [1] + [0] * (len(got) - 2) + [1]
    assert (got[0][0] - at("1970-01-01T00:00:00")).total_seconds() % 420 == 0
    long = preds(spark, [("2020-01-01T00:00:00", 1.0, 0.5), ("2024-01-01T00:00:00", 1.0, 0.5)])
    assert m.uptime_filled(long).count() == 1461 * 144 + 1


def test_alerts(spark):
    df = preds(spark, [("2024-01-01T00:00:00", 80.0, 0.7), ("2024-01-01T00:01:00", 60.0, 0.69), ("2024-01-01T00:02:00", 80.5, 0.2)])
    now = at("2024-01-01T00:03:00")
    assert tuple(m.alert_counts(df, now).first()) == (1, 2, 2)
    assert values(m.critical_alert(df, now), "water_coverage_percent") == [80.5]
    assert m.critical_alert(df, at("2024-01-01T00:07:00")).count() == 0  # exactly five minutes is not newer
    assert values(m.health_alert(df, now), "recent_predictions") == [3]
    assert values(m.health_alert(df, at("2025-01-01T00:00:00")), "recent_predictions") == [0]
    assert m.degradation_alert(df, at("2025-01-01T00:00:00")).count() == 0
    assert m.degradation_alert(df, now).count() == 1


def test_mode_tie_is_settled_by_name(spark):
    df = preds(spark, [("2024-01-01T00:00:00", 90.0, 0.7), ("2024-01-01T00:01:00", 10.0, 0.7)])
    assert values(m.alert_mode(df), "alert_status", "count") == [("CRITICAL", 1)]


def test_price_alerts(spark):
    flat = [(f"2024-01-{d:02d}", 10, 10, 10, 10, 100) for d in range(1, 31)]
    drop = stock(spark, [*flat, ("2024-01-31", 10, 10, 9, 9.4, 201)])
    today = dt.date(2024, 2, 1)
    assert [round(v, 6) for v in values(p.price_drop_alert(drop, today), "daily_change_pct")] == [-6.0]
    assert values(p.high_volume_alert(drop, today), "volume", "avg_volume_30d") == [(201, 100.0)]
    assert p.price_drop_alert(drop, dt.date(2024, 1, 31)).count() == 0
    edge = stock(spark, [*flat, ("2024-01-31", 10, 10, 9, 9.5, 200)])  # exactly -5 % and exactly twice
    assert p.price_drop_alert(edge, today).count() == 0
    assert p.high_volume_alert(edge, today).count() == 0


def test_price_reports(spark):
    df = stock(spark, [("2024-01-05", 10, 11, 9, 10, 5), ("2024-01-08", 10.3, 12, 10, 11, 7), ("2024-01-09", 11, 11, 8, 8.8, 9)])
    assert [round(v, 6) for v in values(p.weekly_returns(df), "weekly_return_pct")] == [0.0, -20.0]
    assert values(p.daily_change(df), "price_change") == [-2.2]
    assert values(p.daily_change(df.limit(0)), "price_change") == []
    assert values(p.daily_change(df.where("date = '2024-01-05'")), "price_change", "price_change_pct") == [(None, None)]
    assert [str(d) for d in values(p.gaps(df), "date")] == ["2024-01-08"]
    assert [round(x, 6) for x in p.extreme_days(df).first()] == [10.0, -20.0]
    assert [round(x, 6) for x in values(p.ytd_return(df, dt.date(2024, 12, 31)), "ytd_return")] == [-12.0]
    assert values(p.ytd_return(df, dt.date(2023, 12, 31)), "ytd_return") == [None]
    stats = p.monthly_statistics(df).first()
    assert (str(stats.avg_price), stats.total_volume, str(stats.monthly_return_pct)) == ("9.93", 21, "-12.00")
    assert values(p.volume_categories(df, n=2), "volume", "volume_category") == [(9, "Above Average"), (7, "Below Average")]


def test_zero_base_gives_null(spark):
    df = stock(spark, [("2024-01-01", 0, 0, 0, 0, 1), ("2024-01-02", 1, 1, 1, 1, 1)])
    assert values(p.price_movement(df), "daily_change_pct") == [None, None]


def test_drop_down_values(spark):
    assert values(variable_values(spark, "time_range"), "text", "value") == [(v, v) for v in VARIABLES["time_range"]]
    assert values(variable_values(spark, "price_threshold"), "value") == [100, 200, 300, 400]


def test_filters_and_columns_reach_the_scan(spark):
    from hydrolens.sources.fixtures import predictions

    df = m.coverage_series(predictions(spark, "/root/testdata/sf0.001"), ("2024-01-08", "2024-01-09"))
    text = plan_text(df)
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in text


def test_top_rows_need_no_sort_of_everything(spark):
    from hydrolens.sources.fixtures import predictions

    text = plan_text(m.latest_predictions(predictions(spark, "/root/testdata/sf0.001")))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


def test_clock_literals_reach_the_scan(spark):
    from hydrolens.sources.fixtures import predictions

    df = predictions(spark, "/root/testdata/sf0.001")
    for now in (at("2024-01-20T00:00:00"), "2024-01-20 00:00:00", dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc)):
        text = plan_text(m.alert_counts(df, now))
        assert "GreaterThan(ts,2024-01-19T00:00)" in text
    assert m.health_alert(df).first().recent_predictions == 0  # the wall clock is past the data


def test_uptime_filled_covers_the_range(spark):
    df = preds(spark, [("2024-01-01T00:30:00", 1.0, 0.5)])
    got = values(m.uptime_filled(df, ("2024-01-01 00:05:00", "2024-01-01 01:00:00")), "time", "system_status")
    assert [(t.strftime("%H:%M"), s) for t, s in got] == [("00:00", 0), ("00:10", 0), ("00:20", 0), ("00:30", 1), ("00:40", 0), ("00:50", 0), ("01:00", 0)]
    assert m.uptime_filled(df.limit(0), ("2024-01-01", "2024-01-02")).count() == 145
    assert m.uptime_filled(df.limit(0)).count() == 0
    months = values(m.uptime_filled(df, ("2023-11-15", "2024-02-01"), "1 month"), "time", "system_status")
    assert [(t.month, s) for t, s in months] == [(11, 0), (12, 0), (1, 1), (2, 0)]
