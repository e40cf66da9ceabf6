"""Joins against lookup tables when one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

HOT_KEYS = 1000
HOT_ROWS = 1_000_000
IP_BLOCK = 65536


def lookup_join(left: DataFrame, right: DataFrame, on: str, how: str = "left", hot_rows: int = HOT_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """Left or inner join on one key, where `right` holds each key at most once.

    The most frequent left keys are found first: at most HOT_KEYS of them, each with `hot_rows`
    rows or more. Their right rows, one per key, are broadcast and their left rows never shuffle.
    Every other key holds less than 1/HOT_KEYS of the rows, or less than `hot_rows`, and takes the
    ordinary join, where adaptive execution splits what still is skewed. Rows without a key cannot match and stay in place too.
    A caller that has counted the left keys gives them as `counts` (key, `_n`).
    """
    if how not in ("left", "inner"):
        raise ValueError(f"not a lookup join: {how}")
    counts = left.groupBy(on).agg(F.count("*").alias("_n")) if counts is None else counts
    top = counts.where(F.col(on).isNotNull()).where(F.col("_n") >= hot_rows).orderBy(F.desc("_n")).limit(HOT_KEYS)
    hot_keys = [row[0] for row in top.select(on).collect()]
    if not hot_keys:
        return left.join(right, on, how)
    hot = F.col(on).isNull() | F.col(on).isin(hot_keys)
    few = right.where(F.col(on).isin(hot_keys))  # at most one row per hot key
    return (
        left.where(hot)
        .join(F.broadcast(few), on, how)
        .unionByName(left.where(~hot).join(right.where(~F.col(on).isin(hot_keys)), on, how))
    )


def locate_numbers(points: DataFrame, ranges: DataFrame, number: str, payload: list[str]) -> DataFrame:
    """Add `found` and the payload of the range [ip_from, ip_to] that holds each 32-bit number.

    `points` are distinct and `ranges` do not overlap. Both sides are cut into blocks of 65,536
    numbers, and inside a block the last range that starts at or before a number is carried forward
    in order: one sort per block, no pairing of points with ranges. So a block holds no more than
    65,536 numbers and as many ranges, whatever the traffic; points without a number are spread.
    """
    start, end, at = F.col("ip_from"), F.col("ip_to"), F.col(number)
    loose = -1 - F.pmod(F.xxhash64(*points.columns), F.lit(4096))
    block = F.when(at.isNull(), loose).otherwise(F.floor(at / IP_BLOCK))
    pieces = ranges.select(
        F.struct(F.col("ip_to"), *payload).alias("_range"),
        start,
        F.explode(F.sequence(F.floor(start / IP_BLOCK), F.floor(end / IP_BLOCK))).alias("_block"),
    ).select("_block", F.greatest(start, F.col("_block") * IP_BLOCK).alias(number), "_range", F.lit(0).alias("_is_point"))
    both = points.select("*", block.alias("_block"), F.lit(1).alias("_is_point")).unionByName(pieces, allowMissingColumns=True)
    order = Window.partitionBy("_block").orderBy(number, "_is_point").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_range", F.last("_range", ignorenulls=True).over(order)).where("_is_point = 1")
    inside = F.coalesce(at <= F.col("_range.ip_to"), F.lit(False))
    return carried.select(
        *points.columns, inside.alias("found"), *[F.when(inside, F.col(f"_range.{c}")).alias(c) for c in payload]
    )


def _network_key(bits: Column, high: Column, low: Column) -> Column:
    """The first `bits` of an address, as text to join on."""
    upper, lower = F.least(bits, F.lit(64)), F.greatest(bits - 64, F.lit(0))
    mask = lambda n: F.when(n == 0, F.lit(0).cast("bigint")).otherwise(F.call_function("shiftleft", F.lit(-1).cast("bigint"), (64 - n).cast("int")))
    return F.concat_ws("/", bits, high.bitwiseAND(mask(upper)), low.bitwiseAND(mask(lower)))


def locate_prefixes(points: DataFrame, networks: DataFrame, payload: list[str]) -> DataFrame:
    """`points` (distinct, with `high` and `low`, the halves of a 128-bit address) with `network`, the payload of the longest
    prefix that holds each; points in no network are left out.

    `networks` has `high`, `low`, `bits` and the payload, nested as they may be. An address is looked up once for each
    length that occurs, of which there are at most 129, so neither nested nor wide networks are cut up, and a short prefix that
    holds most addresses is a hot key of a lookup. Networks given twice count once.
    """
    lengths = sorted(r.bits for r in networks.select("bits").distinct().collect())
    if not lengths:
        return points.limit(0).withColumn("network", F.lit(None).cast(networks.select(*payload).schema))
    known = networks.groupBy(_network_key(F.col("bits"), F.col("high"), F.col("low")).alias("_key"), "bits").agg(F.min(F.struct(*payload)).alias("network"))
    tried = points.withColumn("_bits", F.explode(F.array(*map(F.lit, lengths)))).withColumn("_key", _network_key(F.col("_bits"), F.col("high"), F.col("low")))
    found = lookup_join(tried.drop("_bits"), known, "_key", "inner")
    return found.groupBy(*points.columns).agg(F.max_by("network", "bits").alias("network"))


def pair_by_name(left: DataFrame, right: DataFrame, on: str, on_missing: str = "fail") -> DataFrame:
    """Inner join of two listings by name. A left row without partner fails the run, or is dropped.

    The failure tells how many there are and shows the first few; `unpaired` gives all of them.
    """
    if on_missing == "fail":
        lost = unpaired(left, right, on)
        shown = lost.select(on).orderBy(on).limit(5).collect()
        if shown:
            raise ValueError(f"no partner for {lost.count()} rows, such as {[r[on] for r in shown]}; unpaired() lists all")
    elif on_missing != "drop":
        raise ValueError(f"on_missing is 'fail' or 'drop', not {on_missing!r}")
    return left.join(right, on)


def unpaired(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left rows without a partner."""
    return left.join(right.select(on), on, "left_anti")
