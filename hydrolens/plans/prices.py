"""Reports and alerts over the daily price table (one row per date)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from hydrolens.functions.bands import percent_change, price_band
from hydrolens.functions.time import Moment, Range, bucketed, in_range, moment, since
from hydrolens.operators.ordered import ordered_window, with_lookback


def first_by(value: str, time: str) -> Column:
    """The value at the earliest time; NULL times are ignored."""
    return F.min_by(value, time)


def last_by(value: str, time: str) -> Column:
    return F.max_by(value, time)


def _return_pct(name: str) -> Column:
    return percent_change(last_by("close", "date"), first_by("close", "date")).alias(name)


def _avg(name: str) -> Column:
    # Decimal averages are exact whatever the order of the rows; the report shows a double.
    return F.avg(name).cast("double")


def _by_bucket(stock: DataFrame, rng: Range, width: str, *aggs: Column, label: str = "time") -> DataFrame:
    rows = in_range(stock, "date", rng)
    return rows.groupBy(bucketed(rows, width, "date").alias(label)).agg(*aggs)


def _with_previous(rows: DataFrame, staged: bool) -> DataFrame:
    return ordered_window(rows, ["date"], {"prev_close": lambda w: F.lag("close").over(w)}, lookback=1, staged=staged)


def _change_pct() -> Column:
    return percent_change(F.col("close"), F.col("prev_close"))


# --- series ------------------------------------------------------------------------------------


def ohlc_overview(stock: DataFrame, rng: Range = None) -> DataFrame:
    return (
        in_range(stock, "date", rng)
        .select(
            F.col("date").alias("time"),
            F.col("open").alias("Open Price"),
            F.col("high").alias("High Price"),
            F.col("low").alias("Low Price"),
            F.col("close").alias("Close Price"),
        )
        .orderBy("time")
    )


def candlestick(stock: DataFrame, rng: Range = None) -> DataFrame:
    return (
        in_range(stock, "date", rng)
        .select(F.col("date").alias("time"), *[F.col(c).alias(c.title()) for c in ("open", "high", "low", "close")])
        .orderBy("time")
    )


def volume_series(stock: DataFrame, rng: Range = None) -> DataFrame:
    return (
        in_range(stock, "date", rng)
        .select(F.col("date").alias("time"), F.col("volume").alias("Trading Volume"))
        .orderBy("time")
    )


def close_between(stock: DataFrame, after: Moment, before: Moment) -> DataFrame:
    """Closes strictly between two moments."""
    day = F.col("date").cast("timestamp_ntz")
    ntz = T.TimestampNTZType()
    rows = in_range(stock, "date", (moment(after, ntz).cast("date"), moment(before, ntz).cast("date")))
    return rows.where((day > moment(after, ntz)) & (day < moment(before, ntz))).select("date", "close")


def close_recent(stock: DataFrame, as_of: Moment = None, interval: str = "1 month") -> DataFrame:
    return since(stock, "date", as_of, interval).select("date", "close")


def price_movement(stock: DataFrame, rng: Range = None, staged: bool = False) -> DataFrame:
    rows = in_range(stock, "date", rng).select("date", "close")
    return _with_previous(rows, staged).select(
        F.col("date").alias("time"),
        "close",
        (F.col("close") - F.col("prev_close")).cast("double").alias("daily_change"),
        _change_pct().alias("daily_change_pct"),
    )


def moving_averages(stock: DataFrame, rng: Range = None, staged: bool = False) -> DataFrame:
    """Trailing means over 7, 30 and 50 rows; shorter at the start."""
    rows = in_range(stock, "date", rng).select("date", "close")
    spans = {"7-day MA": 7, "30-day MA": 30, "50-day MA": 50}
    exprs = {
        name: (lambda w, back=n - 1: F.avg("close").over(w.rowsBetween(-back, 0)).cast("double"))
        for name, n in spans.items()
    }
    return ordered_window(rows, ["date"], exprs, lookback=49, staged=staged).withColumnRenamed("date", "time")


# --- buckets -----------------------------------------------------------------------------------


def monthly_performance(stock: DataFrame, rng: Range = None) -> DataFrame:
    return _by_bucket(
        stock,
        rng,
        "1 month",
        _avg("close").alias("avg_monthly_price"),
        F.max("high").alias("monthly_high"),
        F.min("low").alias("monthly_low"),
        F.sum("volume").alias("total_monthly_volume"),
    ).orderBy("time")


def weekly_returns(stock: DataFrame, rng: Range = None) -> DataFrame:
    return _by_bucket(stock, rng, "1 week", _return_pct("weekly_return_pct")).orderBy("time")


def volatility(stock: DataFrame, rng: Range = None) -> DataFrame:
    spread = (F.max("high") - F.min("low")).cast("double")
    return _by_bucket(
        stock,
        rng,
        "1 week",
        F.stddev_samp("close").alias("price_volatility"),
        (F.try_divide(spread, _avg("close")) * 100).alias("weekly_range_pct"),
    ).orderBy("time")


def monthly_statistics(stock: DataFrame, rng: Range = None) -> DataFrame:
    money = lambda c: F.round(c.cast("decimal(38,12)"), 2)  # noqa: E731  half away from zero
    return _by_bucket(
        stock,
        rng,
        "1 month",
        F.count("*").alias("trading_days"),
        money(F.avg("close")).alias("avg_price"),
        money(F.max("high")).alias("month_high"),
        money(F.min("low")).alias("month_low"),
        F.sum("volume").alias("total_volume"),
        money(_return_pct("r")).alias("monthly_return_pct"),
        label="month",
    ).orderBy(F.desc("month"))


def monthly_rollup(stock: DataFrame) -> DataFrame:
    """The stored monthly table: one row per month, as kept by plans.maintenance."""
    return _by_bucket(
        stock,
        None,
        "1 month",
        F.count("*").alias("trading_days"),
        _avg("close").alias("avg_close_price"),
        F.max("high").alias("month_high"),
        F.min("low").alias("month_low"),
        F.sum("volume").alias("total_volume"),
        _return_pct("monthly_return_pct"),
        label="month",
    )


def price_histogram(stock: DataFrame, rng: Range = None) -> DataFrame:
    return (
        in_range(stock, "date", rng)
        .groupBy(price_band(F.col("close")).alias("price_range"))
        .agg(F.count("*").alias("frequency"))
        .orderBy("price_range")
    )


def monthly_first_last(stock: DataFrame, as_of: Moment = None, interval: str = "2 months") -> DataFrame:
    rows = since(stock, "date", as_of, interval)
    return _by_bucket(
        rows,
        None,
        "1 month",
        first_by("close", "date").alias("month_first_close"),
        last_by("close", "date").alias("month_last_close"),
        label="month",
    ).orderBy("month")


def monthly_averages(stock: DataFrame) -> DataFrame:
    return _by_bucket(
        stock, None, "1 month", _avg("close").alias("close_avg"), F.avg("volume").alias("volume_avg"), label="month"
    ).orderBy("month")


# --- single values -----------------------------------------------------------------------------


def current_price(stock: DataFrame) -> DataFrame:
    return stock.orderBy(F.desc("date")).limit(1).select(F.col("close").alias("Current Price"))


def daily_change(stock: DataFrame) -> DataFrame:
    """Change of the newest close. Only the two newest rows are needed, so no window over history."""
    spec = Window.orderBy("date")  # over two rows
    return (
        stock.select("date", "close")
        .orderBy(F.desc("date"))
        .limit(2)
        .withColumn("prev_close", F.lag("close").over(spec))
        .orderBy(F.desc("date"))
        .limit(1)
        .select(
            (F.col("close") - F.col("prev_close")).cast("double").alias("price_change"),
            _change_pct().alias("price_change_pct"),
        )
    )


def support_resistance(stock: DataFrame, as_of: Moment = None) -> DataFrame:
    return since(stock, "date", as_of, "364 days").agg(
        F.max("high").alias("52-Week High"), F.min("low").alias("52-Week Low"), _avg("close").alias("52-Week Average")
    )


def average_close(stock: DataFrame, as_of: Moment = None, interval: str = "1 month") -> DataFrame:
    return since(stock, "date", as_of, interval).agg(_avg("close").alias("avg"))


def first_last_close(stock: DataFrame, as_of: Moment = None, interval: str = "2 months") -> DataFrame:
    return since(stock, "date", as_of, interval).agg(
        first_by("close", "date").alias("first"), last_by("close", "date").alias("last")
    )


def ytd_return(stock: DataFrame, as_of: Moment = None) -> DataFrame:
    """Return since the first close of the year; the year is a range, so the scan can be pruned."""
    now = moment(as_of, T.DateType())
    start = F.trunc(now, "YEAR")
    rows = stock.where((F.col("date") >= start) & (F.col("date") < F.add_months(start, 12)))
    return rows.agg(_return_pct("ytd_return"))


def extreme_days(stock: DataFrame, rng: Range = None, staged: bool = False) -> DataFrame:
    """Best and worst daily return in one pass."""
    rows = in_range(stock, "date", rng).select("date", "close")
    return _with_previous(rows, staged).agg(
        F.max(_change_pct()).alias("best_day_return"), F.min(_change_pct()).alias("worst_day_return")
    )


# --- top rows ----------------------------------------------------------------------------------


def volume_categories(stock: DataFrame, rng: Range = None, n: int = 30) -> DataFrame:
    """The newest days, each against the mean volume of the whole range."""
    rows = in_range(stock, "date", rng)
    mean = rows.agg(F.avg("volume").alias("_mean"))  # one row by construction
    return (
        rows.select("date", "volume")
        .orderBy(F.desc("date"))
        .limit(n)
        .crossJoin(F.broadcast(mean))
        .select(
            "date",
            "volume",
            F.when(F.col("volume") > F.col("_mean"), "Above Average").otherwise("Below Average").alias("volume_category"),
        )
        .orderBy(F.desc("date"))
    )


def top_volume_days(stock: DataFrame, rng: Range = None, n: int = 20, staged: bool = False) -> DataFrame:
    rows = in_range(stock, "date", rng).select("date", "close", "volume")
    return (
        _with_previous(rows, staged)
        .orderBy(F.desc("volume"), F.desc("date"))
        .limit(n)
        .select(
            "date",
            F.col("close").alias("Close Price"),
            F.col("volume").alias("Trading Volume"),
            _change_pct().alias("Daily Change %"),
        )
    )


def top_volumes(stock: DataFrame, n: int = 10) -> DataFrame:
    return stock.select("date", "volume").orderBy(F.desc("volume"), F.desc("date")).limit(n)


def latest_rows(stock: DataFrame, n: int = 5) -> DataFrame:
    return stock.orderBy(F.desc("date")).limit(n)


def gaps(stock: DataFrame, rng: Range = None, limit_pct: float = 2, n: int = 20, staged: bool = False) -> DataFrame:
    """Opens more than `limit_pct` percent away from the close before, largest first."""
    rows = in_range(stock, "date", rng).select("date", "open", "close")
    pct = percent_change(F.col("open"), F.col("prev_close"))
    return (
        _with_previous(rows, staged)
        .select(
            "date",
            "open",
            "prev_close",
            (F.col("open") - F.col("prev_close")).cast("double").alias("gap"),
            pct.alias("gap_pct"),
        )
        .where(F.abs("gap_pct") > limit_pct)
        .orderBy(F.desc(F.abs("gap_pct")), F.desc("date"))
        .limit(n)
    )


# --- alerts ------------------------------------------------------------------------------------


def _yesterday(as_of: Moment) -> Column:
    return F.date_sub(moment(as_of, T.DateType()), 1)


def price_drop_alert(stock: DataFrame, as_of: Moment = None, limit_pct: float = -5) -> DataFrame:
    """Yesterday's close, when it fell by more than the limit against the row before."""
    day = _yesterday(as_of)
    rows = with_lookback(stock.select("date", "close"), "date", day, day, 1)
    return (
        rows.withColumn("prev_close", F.lag("close").over(Window.orderBy("date")))  # over two rows
        .where(F.col("date") == day)
        .select("date", "close", _change_pct().alias("daily_change_pct"))
        .where(F.col("daily_change_pct") < limit_pct)
    )


def high_volume_alert(stock: DataFrame, as_of: Moment = None, factor: float = 2) -> DataFrame:
    """Yesterday's volume, when above `factor` times the mean of the 29 rows before."""
    day = _yesterday(as_of)
    rows = with_lookback(stock.select("date", "volume"), "date", day, day, 29)
    before = Window.orderBy("date").rowsBetween(-29, -1)  # over thirty rows
    return (
        rows.withColumn("avg_volume_30d", F.avg("volume").over(before))
        .where((F.col("date") == day) & (F.col("volume") > F.col("avg_volume_30d") * factor))
        .select("date", "volume", "avg_volume_30d")
    )
