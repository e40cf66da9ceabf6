"""Price reports and alerts. The price table is derived, so windowed reports stage it once."""

from __future__ import annotations

from pyspark.sql import functions as F

from hydrolens.catalog.registry import ALL, ALL_DATE, register
from hydrolens.functions.time import latest
from hydrolens.operators.ordered import ordered_window
from hydrolens.plans import prices as p
from hydrolens.session import stage
from hydrolens.sources.fixtures import stock

D = "CAST({} AS DOUBLE)"
MONTH = "CAST(date_trunc('month', date) AS DATE)"
WEEK = "CAST(date_trunc('week', date) AS DATE)"
LAST, FIRST = "CAST(arg_max(close, date) AS DOUBLE)", "CAST(arg_min(close, date) AS DOUBLE)"
RETURN = f"({LAST} - {FIRST}) / nullif({FIRST}, 0) * 100"
LAGGED = (
    ", lagged AS (SELECT *, CAST(lag(close) OVER (ORDER BY date) AS DOUBLE) AS prev, CAST(close AS DOUBLE) AS c, "
    f"CAST(open AS DOUBLE) AS o FROM stock WHERE {ALL_DATE})"
)


def q(name, sql):
    def add(build):
        register(name, sql, ("stock",))(lambda spark, folder: build(stock(spark, folder)))
        return build

    return add


def dbl(col, label=None):
    return f"round(CAST({col} AS DOUBLE), 8) AS {label or col}"


q(
    "ohlc_overview",
    f"""SELECT date AS time, {dbl("open", '"Open Price"')}, {dbl("high", '"High Price"')},
  {dbl("low", '"Low Price"')}, {dbl("close", '"Close Price"')} FROM stock WHERE {ALL_DATE}""",
)(lambda s: p.ohlc_overview(s, ALL))
q(
    "candlestick",
    f"""SELECT date AS time, {dbl("open", '"Open"')}, {dbl("high", '"High"')}, {dbl("low", '"Low"')},
  {dbl("close", '"Close"')} FROM stock WHERE {ALL_DATE}""",
)(lambda s: p.candlestick(s, ALL))
q("volume_series", f"""SELECT date AS time, volume AS "Trading Volume" FROM stock WHERE {ALL_DATE}""")(
    lambda s: p.volume_series(s, ALL)
)
q(
    "close_between",
    f"""SELECT date, {dbl("close")} FROM stock WHERE date > DATE '1997-01-01'
  AND date < (SELECT max(date) FROM stock)""",
)(lambda s: p.close_between(s, "1997-01-01", latest(s, "date")))
q(
    "close_recent",
    f"SELECT date, {dbl('close')} FROM stock WHERE date > (SELECT max(date) FROM stock) - INTERVAL '1 month'",
)(lambda s: p.close_recent(s, latest(s, "date")))
q(
    "price_movement",
    LAGGED
    + """ SELECT date AS time, round(c, 8) AS close, round(CAST(close - lag(close) OVER (ORDER BY date) AS DOUBLE), 8) AS daily_change,
  round((c - prev) / nullif(prev, 0) * 100, 8) AS daily_change_pct FROM lagged""",
)(lambda s: p.price_movement(s, ALL, staged=True))
q(
    "moving_averages",
    f"""SELECT date AS time, {dbl("close")},
  round(avg(close) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 8) AS "7-day MA",
  round(avg(close) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 8) AS "30-day MA",
  round(avg(close) OVER (ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 8) AS "50-day MA"
FROM stock WHERE {ALL_DATE}""",
)(lambda s: p.moving_averages(s, ALL, staged=True))
q(
    "monthly_performance",
    f"""SELECT {MONTH} AS time, round(avg(close), 8) AS avg_monthly_price, {dbl("max(high)", "monthly_high")},
  {dbl("min(low)", "monthly_low")}, CAST(sum(volume) AS BIGINT) AS total_monthly_volume
FROM stock WHERE {ALL_DATE} GROUP BY 1""",
)(lambda s: p.monthly_performance(s, ALL))
q(
    "weekly_returns",
    f"SELECT {WEEK} AS time, round({RETURN}, 8) AS weekly_return_pct FROM stock WHERE {ALL_DATE} GROUP BY 1",
)(lambda s: p.weekly_returns(s, ALL))
q(
    "volatility",
    f"""SELECT {WEEK} AS time, round(stddev_samp(CAST(close AS DOUBLE)), 8) AS price_volatility,
  round(CAST(max(high) - min(low) AS DOUBLE) / avg(close) * 100, 8) AS weekly_range_pct
FROM stock WHERE {ALL_DATE} GROUP BY 1""",
)(lambda s: p.volatility(s, ALL))
q(
    "monthly_price_statistics",
    f"""SELECT {MONTH} AS month, count(*) AS trading_days, round(CAST(avg(close) AS DOUBLE), 2) AS avg_price,
  CAST(round(max(high), 2) AS DOUBLE) AS month_high, CAST(round(min(low), 2) AS DOUBLE) AS month_low,
  CAST(sum(volume) AS BIGINT) AS total_volume, round({RETURN}, 2) AS monthly_return_pct
FROM stock WHERE {ALL_DATE} GROUP BY 1""",
)(lambda s: p.monthly_statistics(s, ALL))
q(
    "monthly_rollup",
    f"""SELECT {MONTH} AS month, count(*) AS trading_days, round(avg(close), 8) AS avg_close_price,
  {dbl("max(high)", "month_high")}, {dbl("min(low)", "month_low")}, CAST(sum(volume) AS BIGINT) AS total_volume,
  round({RETURN}, 8) AS monthly_return_pct FROM stock GROUP BY 1""",
)(p.monthly_rollup)
q(
    "price_histogram",
    f"""SELECT CASE WHEN close < 100 THEN 'Under $100' WHEN close < 200 THEN '$100-200' WHEN close < 300 THEN '$200-300'
  WHEN close < 400 THEN '$300-400' ELSE 'Over $400' END AS price_range, count(*) AS frequency
FROM stock WHERE {ALL_DATE} GROUP BY 1""",
)(lambda s: p.price_histogram(s, ALL))
q(
    "monthly_first_last",
    f"""SELECT {MONTH} AS month, {dbl("arg_min(close, date)", "month_first_close")}, {dbl("arg_max(close, date)", "month_last_close")}
FROM stock WHERE date > (SELECT max(date) FROM stock) - INTERVAL '2 months' GROUP BY 1""",
)(lambda s: p.monthly_first_last(s, latest(s, "date")))
q(
    "monthly_averages",
    f"SELECT {MONTH} AS month, round(avg(close), 8) AS close_avg, round(avg(volume), 8) AS volume_avg FROM stock GROUP BY 1",
)(p.monthly_averages)
q("current_price", f"SELECT {dbl('close', '"Current Price"')} FROM stock ORDER BY date DESC LIMIT 1")(p.current_price)
q(
    "daily_change",
    LAGGED
    + """ SELECT round(CAST(close - lag(close) OVER (ORDER BY date) AS DOUBLE), 8) AS price_change,
  round((c - prev) / nullif(prev, 0) * 100, 8) AS price_change_pct FROM lagged ORDER BY date DESC LIMIT 1""",
)(p.daily_change)
q(
    "support_resistance",
    f"""SELECT {dbl("max(high)", '"52-Week High"')}, {dbl("min(low)", '"52-Week Low"')}, round(avg(close), 8) AS "52-Week Average"
FROM stock WHERE date > (SELECT max(date) FROM stock) - INTERVAL '364 days'""",
)(lambda s: p.support_resistance(s, latest(s, "date")))
q(
    "average_close",
    "SELECT round(avg(close), 8) AS avg FROM stock WHERE date > (SELECT max(date) FROM stock) - INTERVAL '1 month'",
)(lambda s: p.average_close(s, latest(s, "date")))
q(
    "first_last_close",
    f"""SELECT {dbl("arg_min(close, date)", "first")}, {dbl("arg_max(close, date)", "last")}
FROM stock WHERE date > (SELECT max(date) FROM stock) - INTERVAL '2 months'""",
)(lambda s: p.first_last_close(s, latest(s, "date")))
q(
    "ytd_return",
    f"SELECT round({RETURN}, 8) AS ytd_return FROM stock WHERE year(date) = (SELECT year(max(date)) FROM stock)",
)(lambda s: p.ytd_return(s, latest(s, "date")))
q(
    "extreme_days",
    LAGGED
    + """ SELECT round(max((c - prev) / nullif(prev, 0) * 100), 8) AS best_day_return,
  round(min((c - prev) / nullif(prev, 0) * 100), 8) AS worst_day_return FROM lagged""",
)(lambda s: p.extreme_days(s, ALL, staged=True))
q(
    "volume_categories",
    f"""SELECT date, volume, CASE WHEN volume > avg(volume) OVER () THEN 'Above Average' ELSE 'Below Average' END AS volume_category
FROM stock WHERE {ALL_DATE} ORDER BY date DESC LIMIT 30""",
)(lambda s: p.volume_categories(s, ALL))
q(
    "top_volume_days",
    LAGGED
    + """ SELECT date, round(c, 8) AS "Close Price", volume AS "Trading Volume",
  round((c - prev) / nullif(prev, 0) * 100, 8) AS "Daily Change %" FROM lagged ORDER BY volume DESC, date DESC LIMIT 20""",
)(lambda s: p.top_volume_days(s, ALL, staged=True))
q("top_volumes", "SELECT date, volume FROM stock ORDER BY volume DESC, date DESC LIMIT 10")(p.top_volumes)
q(
    "latest_rows",
    f"""SELECT date, {dbl("close")}, {dbl("high")}, {dbl("low")}, {dbl("open")}, volume FROM stock
ORDER BY date DESC LIMIT 5""",
)(p.latest_rows)
q(
    "gaps",
    LAGGED
    + """ SELECT date, round(o, 8) AS open, round(prev, 8) AS prev_close,
  round(CAST(open - CAST(prev AS DECIMAL(20,8)) AS DOUBLE), 8) AS gap, round((o - prev) / nullif(prev, 0) * 100, 8) AS gap_pct
FROM lagged WHERE abs((o - prev) / nullif(prev, 0) * 100) > 2
ORDER BY abs((o - prev) / nullif(prev, 0) * 100) DESC, date DESC LIMIT 20""",
)(lambda s: p.gaps(s, ALL, staged=True))

# Alerts: "today" is the day after the largest fall, or after the day farthest above its trailing
# mean volume, so that there is something to see.
AVERAGED = """
, averaged AS (SELECT date, volume, avg(volume) OVER (ORDER BY date ROWS BETWEEN 29 PRECEDING AND 1 PRECEDING) AS a FROM stock)
SELECT date, volume, round(a, 8) AS avg_volume_30d FROM averaged
WHERE date = (SELECT arg_max(date, (volume / a, date)) FROM averaged WHERE a IS NOT NULL) AND volume > a * {}"""


@q(
    "price_drop_alert",
    LAGGED
    + """ SELECT date, round(c, 8) AS close, round((c - prev) / nullif(prev, 0) * 100, 8) AS daily_change_pct
FROM lagged WHERE date = (SELECT arg_min(date, ((c - prev) / nullif(prev, 0), date)) FROM lagged WHERE prev IS NOT NULL)
  AND (c - prev) / nullif(prev, 0) * 100 < -5""",
)
def _(s):
    rows = stage(s, "prices")
    fall = p.price_movement(rows).where("daily_change_pct IS NOT NULL")
    day = fall.agg(F.min_by("time", F.struct("daily_change_pct", "time"))).scalar()
    return p.price_drop_alert(rows, F.date_add(day, 1))


def _volume_alert(s, factor):
    rows = stage(s, "prices")
    mean = {"a": lambda w: F.avg("volume").over(w.rowsBetween(-29, -1))}
    ratio = F.struct(F.col("volume") / F.col("a"), "date")
    ranked = ordered_window(rows.select("date", "volume"), ["date"], mean, lookback=29).where("a IS NOT NULL")
    return p.high_volume_alert(rows, F.date_add(ranked.agg(F.max_by("date", ratio)).scalar(), 1), factor)


q("high_volume_alert", AVERAGED.format(2))(lambda s: _volume_alert(s, 2))
# The fixture's volumes are even and may never double, so the rule is also shown at the mean itself.
q("above_mean_volume_alert", AVERAGED.format(1))(lambda s: _volume_alert(s, 1))
