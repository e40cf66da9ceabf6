"""The blocked window against the plain one."""

import random
from datetime import datetime, timedelta

from hypothesis import given, settings, strategies as st
from pyspark.sql import Window, functions as F

from hydrolens.operators.ordered import _layout, assign_targets, dense_index, ordered_window, with_lookback
from tests.conftest import plan_text


@settings(max_examples=200, deadline=None)
@given(
    st.dictionaries(st.integers(0, 60), st.integers(1, 40), max_size=40),
    st.integers(1, 12),
    st.integers(0, 90),
)
def test_targets_cover_the_lookback(counts, blocks, lookback):
    targets, offsets = assign_targets(counts, blocks, lookback)
    own = [t[0] for t in targets]
    sizes = [counts.get(i, 0) for i in range(len(targets))]
    assert own == sorted(own)
    for block, offset in enumerate(offsets):
        before = sum(s for s, o in zip(sizes, own) if o < block)
        assert offset == before
        received = sum(s for s, t in zip(sizes, targets) if block in t[1:])
        assert received >= min(lookback, before)
        # What a block receives is a run of slices right in front of it.
        got = [i for i, t in enumerate(targets) if block in t[1:] and sizes[i]]
        front = [i for i, o in enumerate(own) if o < block and sizes[i]]
        assert got == front[len(front) - len(got) :]


def rows(spark, n, hot=0.0, nulls=0, series=1, seed=1):
    rng = random.Random(seed)
    base = datetime(2024, 1, 1)
    data = []
    for i in range(n):
        ts = base + timedelta(seconds=rng.randrange(n))
        if rng.random() < hot:
            ts = base + timedelta(seconds=n // 2)
        data.append((i, None if i < nulls else ts, rng.randrange(1000) / 8, 0 if rng.random() < 0.6 else rng.randrange(series)))
    rng.shuffle(data)
    return spark.createDataFrame(data, "id bigint, ts timestamp_ntz, v double, s int").repartition(5)


EXPRS = {
    "prev": lambda w: F.lag("v").over(w),
    "prev3": lambda w: F.lag("v", 3).over(w),
    "mean": lambda w: F.avg("v").over(w.rowsBetween(-49, 0)),
    "before": lambda w: F.sum("v").over(w.rowsBetween(-29, -1)),
}


def check(spark, df, block_rows, series=None):
    spec = Window.partitionBy(*(series or [F.lit(1)])).orderBy(F.asc_nulls_last("ts"), "id")
    want = df.select("*", *[make(spec).alias(n) for n, make in EXPRS.items()]).orderBy("id").collect()
    got = ordered_window(df, ["ts", "id"], EXPRS, 49, series=series, block_rows=block_rows).orderBy("id").collect()
    assert got == want


def test_equals_plain_window(spark):
    check(spark, rows(spark, 4000), 500)


def test_third_of_the_rows_at_one_time(spark):
    check(spark, rows(spark, 3000, hot=0.35), 200)


def test_null_order_keys_come_last(spark):
    check(spark, rows(spark, 600, nulls=120), 100)


def test_blocks_shorter_than_the_lookback(spark):
    check(spark, rows(spark, 300), 5)


def test_fewer_rows_than_blocks(spark):
    for n in (0, 1, 3, 20):
        check(spark, rows(spark, n), 1)


def test_series_with_a_hot_one(spark):
    check(spark, rows(spark, 3000, series=7), 200, series=["s"])


def test_staged_input_gives_the_same(spark):
    df = rows(spark, 500)
    plain = ordered_window(df, ["ts", "id"], EXPRS, 49).orderBy("id").collect()
    assert ordered_window(df, ["ts", "id"], EXPRS, 49, staged=True).orderBy("id").collect() == plain


def test_text_and_decimal_keys(spark):
    df = rows(spark, 800).select("id", F.concat(F.lit("é'\""), (F.col("id") % 90).cast("string")).alias("name"), F.col("v").cast("decimal(20,8)").alias("d"))
    order = ["name", "d", "id"]
    spec = Window.orderBy(*order)
    want = df.withColumn("p", F.lag("id").over(spec)).orderBy("id").collect()
    got = ordered_window(df, order, {"p": lambda w: F.lag("id").over(w)}, 1, block_rows=50).orderBy("id").collect()
    assert got == want


def test_dense_index(spark):
    df = rows(spark, 2500, hot=0.4, nulls=10)
    got = [r.id for r in dense_index(df, ["ts", "id"], block_rows=100).orderBy("row_index").collect()]
    want = [r.id for r in df.orderBy(F.asc_nulls_last("ts"), "id").collect()]
    assert got == want
    positions = dense_index(df, ["ts", "id"], block_rows=100).agg(F.min("row_index"), F.max("row_index"), F.count_distinct("row_index")).first()
    assert tuple(positions) == (0, 2499, 2500)


def test_no_single_task_exchange(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("event_id AS id", "ts", "value AS v")
    text = plan_text(ordered_window(events, ["ts", "id"], EXPRS, 49, block_rows=100))
    assert "SinglePartition" not in text
    assert text.count("Exchange") == text.count("shufflepartitionidpassthrough") == 1


def test_result_is_in_order(spark):
    df = rows(spark, 3000, hot=0.3, nulls=5)
    got = [r.id for r in ordered_window(df, ["ts", "id"], EXPRS, 49, block_rows=100).collect()]
    assert got == [r.id for r in df.orderBy(F.asc_nulls_last("ts"), "id").collect()]
    many = rows(spark, 2000, series=5)
    got = [r.id for r in ordered_window(many, ["ts", "id"], EXPRS, 49, series=["s"], block_rows=100).collect()]
    assert got == [r.id for r in many.orderBy("s", "ts", "id").collect()]


def test_lookback_prefix(spark):
    df = spark.range(100).withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")))
    low = F.lit("2024-02-10").cast("date")
    got = sorted(r.id for r in with_lookback(df, "d", low, low, 29).collect())
    assert got == list(range(11, 41))


def test_a_small_order_is_one_block(spark):
    df = rows(spark, 300, hot=0.3, nulls=3)
    assert _layout(df, ["ts", "id"], 49, 300).blocks == 1 < _layout(df, ["ts", "id"], 49, 299).blocks
    check(spark, df, 300)
