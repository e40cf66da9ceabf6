"""Chunked tables: writing, pruning, upsert, rollup refresh, compaction, retention, log."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hydrolens.plans import maintenance as mt
from hydrolens.plans.prices import monthly_rollup
from hydrolens.sources.tables import append_rows, read_table
from tests.conftest import plan_text

SCHEMA = "date date, close decimal(20,8), high decimal(20,8), low decimal(20,8), open decimal(20,8), volume bigint"
TODAY = dt.datetime(2024, 6, 10)


@pytest.fixture()
def prices(spark):
    days = [dt.date(2016, 11, 15) + dt.timedelta(days=i) for i in range(0, 2760, 3)]
    rows = [(d, *[Decimal(i % 97 + k) for k in (2, 4, 1, 3)], i) for i, d in enumerate(days)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture()
def table(spark, tmp_path, prices):
    path = str(tmp_path / "prices")
    mt.write_chunked(prices, path)
    return path


def rows(df):
    return sorted(map(tuple, df.select("date", "close", "volume").collect()))


def test_chunks_and_pruning(spark, table, prices):
    assert rows(mt.read_chunked(spark, table)) == rows(prices)
    months = mt.chunks(spark, table)
    assert months[0] == dt.date(2016, 11, 1) and len(months) == prices.select(F.trunc("date", "MM")).distinct().count()
    part = mt.read_chunked(spark, table, ("2020-01-15", "2020-02-10"))
    assert rows(part) == rows(prices.where("date BETWEEN '2020-01-15' AND '2020-02-10'"))
    text = plan_text(part)
    assert "PartitionFilters: [isnotnull(month" in text and "GreaterThanOrEqual(date" in text
    part.collect()
    assert len(part.inputFiles()) > 0


def test_a_far_larger_month_is_split(spark, tmp_path):
    big = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")))
        .otherwise(F.lit("2024-05-05").cast("date")).alias("date"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        mt.write_chunked(big, str(tmp_path / "big"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = mt.storage_stats(spark, str(tmp_path / "big")).collect()
    sizes = {r.month: r.files for r in files}
    assert sizes[dt.date(2024, 5, 1)] > 3 and spark.read.parquet(str(tmp_path / "big")).count() == 200_000


def test_upsert_touches_only_its_months(spark, table, prices):
    before = {m: sorted(os.listdir(f"{table}/month={m}")) for m in mt.chunks(spark, table)}
    day = dt.date(2020, 1, 1)
    some = prices.where("date BETWEEN '2020-01-01' AND '2020-01-31'").withColumn("volume", F.lit(-1).cast("bigint")).withColumn("seq", F.lit(1))
    fresh = spark.createDataFrame([(dt.date(2030, 1, 1), Decimal(1), Decimal(1), Decimal(1), Decimal(1), 5, 1)], SCHEMA + ", seq int")
    months = mt.upsert_table(spark, table, some.unionByName(fresh).unionByName(some.withColumn("volume", F.lit(-2).cast("bigint")).withColumn("seq", F.lit(2))), ["date"], ["seq"])
    assert months == [day, dt.date(2030, 1, 1)]
    got = mt.read_chunked(spark, table)
    assert got.count() == prices.count() + 1
    assert {r.volume for r in mt.read_chunked(spark, table, ("2020-01-01", "2020-01-31")).collect()} == {-2}
    after = {m: sorted(os.listdir(f"{table}/month={m}")) for m in before}
    assert [m for m in before if before[m] != after[m]] == [day]
    with pytest.raises(ValueError):
        mt.upsert_table(spark, table, some, ["volume"], ["seq"])


@pytest.mark.parametrize("as_of", [dt.datetime(2024, 6, 10), dt.datetime(2024, 6, 1), dt.datetime(2024, 6, 2), dt.datetime(2024, 3, 31, 12)])
def test_refresh_equals_recompute_inside_only(spark, tmp_path, table, prices, as_of):
    path = str(tmp_path / "rollup")
    monthly_rollup(prices).withColumn("trading_days", F.lit(0).cast("bigint")).write.parquet(path)
    mt.refresh_rollup(spark, mt._chunk_schema(spark, table), path, as_of)
    right = {r.month: r.trading_days for r in monthly_rollup(prices).collect()}
    start = (as_of.replace(day=1) - dt.timedelta(days=100))
    inside = set()
    for month in right:
        end = (month.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        low = spark.range(1).select(F.expr(f"TIMESTAMP_NTZ'{as_of}' - INTERVAL 3 months").alias("x")).first().x
        if dt.datetime.combine(month, dt.time()) >= low and dt.datetime.combine(end, dt.time()) <= as_of - dt.timedelta(days=1):
            inside.add(month)
    got = {r.month: r.trading_days for r in spark.read.parquet(path).collect()}
    assert inside and got == {mth: (n if mth in inside else 0) for mth, n in right.items()}


def test_refresh_removes_months_that_vanished(spark, prices):
    base = prices.where("trunc(date, 'MM') <> '2024-04-01'")
    got = mt.refreshed_rollup(monthly_rollup(prices), base, TODAY)
    assert got.where("month = '2024-04-01'").count() == 0 and got.where("month = '2024-05-01'").count() == 1


def test_compaction_keeps_rows_and_orders_them(spark, tmp_path, prices):
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    for part in range(4):
        mt.write_chunked(prices.where(F.dayofmonth("date") % 4 == part), path)
    young = {m: sorted(os.listdir(f"{path}/month={m}")) for m in mt.chunks(spark, path) if m >= dt.date(2024, 3, 1)}
    done = mt.logged(spark, log, "compact", path, TODAY, lambda: mt.compact(spark, path, TODAY))
    assert max(done) == dt.date(2024, 2, 1) and rows(mt.read_chunked(spark, path)) == rows(prices)
    assert {m: sorted(os.listdir(f"{path}/month={m}")) for m in young} == young
    stats = {r.month: r.files for r in mt.storage_stats(spark, path).collect()}
    assert all(stats[m] == 1 for m in done)
    month = done[5]
    name = next(f for f in os.listdir(f"{path}/month={month}") if f.endswith(".parquet"))
    assert ".zstd." in name
    import pyarrow.parquet as pq

    dates = pq.ParquetFile(f"{path}/month={month}/{name}").read().column("date").to_pylist()
    assert dates == sorted(dates, reverse=True)
    assert mt.compacted_months(spark, log, path) == done
    assert mt.compact(spark, path, TODAY, done=done) == []
    entry = mt.maintenance_log(spark, log).first()
    assert entry.job == "compact" and entry.after_bytes < entry.before_bytes and entry.after.split()[1] in ("bytes", "kB", "MB")


def test_retention_drops_whole_chunks(spark, tmp_path, table, prices):
    gone = mt.retain(spark, table, TODAY)
    # 2017-06 ends on 2017-07-01, after the limit of 2017-06-10, so all of it stays.
    assert max(gone) == dt.date(2017, 5, 1)
    kept = prices.where("date >= '2017-06-01'")
    assert rows(mt.read_chunked(spark, table)) == rows(kept) == rows(mt.retained(prices, TODAY))
    assert mt.retain(spark, table, TODAY) == []


def test_append_and_read_back(spark, tmp_path, prices):
    path = str(tmp_path / "plain")
    append_rows(prices.limit(1), path)
    append_rows(prices.limit(5), path)
    assert read_table(spark, path).count() == 6 and read_table(spark, path).schema == prices.schema


@pytest.mark.parametrize("step", ["_rename", "delete_path"])
@pytest.mark.parametrize("fails_at", [1, 2, 3, 4])
def test_a_run_that_ends_early_can_be_repeated(spark, table, prices, monkeypatch, step, fails_at):
    real, calls = getattr(mt, step), []

    def dying(*args):
        calls.append(args)
        if len(calls) == fails_at:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(mt, step, dying)
    with pytest.raises(RuntimeError):
        mt.compact(spark, table, TODAY)
    monkeypatch.undo()
    again = mt.compact(spark, table, TODAY)
    assert len(again) > 50 and rows(mt.read_chunked(spark, table)) == rows(prices)
    assert not [name for name in os.listdir(table) if name.startswith(("_incoming", "_outgoing"))]


def test_months_come_from_folder_names(spark, table):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    assert len(mt.chunks(spark, table)) > 50
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_the_log_says_what_is_done(spark, table, tmp_path):
    log = str(tmp_path / "log")
    first = mt.logged(spark, log, "compact", table, TODAY, lambda: mt.compact(spark, table, TODAY, log=log))
    assert len(first) > 50 and mt.compact(spark, table, TODAY, log=log) == []


def overlapping(folder, column, low, high):
    """(row groups that may hold a value of the band, all row groups) of a folder of Parquet files, by their statistics."""
    import glob

    import pyarrow.parquet as pq

    held = total = 0
    for name in glob.glob(f"{folder}/month=*/*.parquet"):
        data = pq.ParquetFile(name).metadata
        at = data.schema.names.index(column)
        for i in range(data.num_row_groups):
            stats = data.row_group(i).column(at).statistics
            total += 1
            held += stats.min <= high and stats.max >= low
    return held, total


def test_clustered_chunks_skip_row_groups(spark, tmp_path):
    rng = random.Random(4)
    rows = [(dt.date(2024, 1 + i % 2, 1 + i // 2 % 28), i, rng.randrange(10**6), rng.random()) for i in range(6000)] + [(dt.date(2024, 1, 1), -1, None, None)]
    df = spark.createDataFrame(rows, "date date, id int, volume bigint, close double")
    path = str(tmp_path / "t")
    df.repartitionByRange(8, "date").write.mode("overwrite").parquet(str(tmp_path / "plain"))
    mt.write_chunked(df, path)
    flat = overlapping(path, "volume", 400_000, 420_000)
    assert flat[0] == flat[1]
    assert mt.cluster(spark, path, ["date", "volume", "close"], rows_per_file=100) == [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    for column, low, high in (("volume", 400_000, 420_000), ("close", 0.5, 0.52), ("date", dt.date(2024, 1, 5), dt.date(2024, 1, 6))):
        held, total = overlapping(path, column, low, high)
        assert total >= 50 and held < 0.5 * total, (column, held, total)
    band = mt.read_chunked(spark, path).where("volume BETWEEN 400000 AND 420000")
    assert "GreaterThanOrEqual(volume,400000)" in plan_text(band)
    assert sorted(r.id for r in band.collect()) == sorted(i for _, i, v, _ in rows if v is not None and 400_000 <= v <= 420_000)
    assert sorted(map(repr, mt.read_chunked(spark, path).select(*df.columns).collect())) == sorted(map(repr, df.collect()))
    # Some months only, a column of one value, and months that are not there.
    assert mt.cluster(spark, path, ["volume"], [dt.date(2024, 2, 1), dt.date(1999, 1, 1)]) == [dt.date(2024, 2, 1)]
    assert mt.read_chunked(spark, path).count() == len(rows)
    assert mt.cluster(spark, str(tmp_path / "none"), ["volume"]) == []


def test_interleaved_bits():
    import pyspark.sql.functions as F

    def plain(ranks, bits):
        return sum((r >> bit & 1) << (bit * len(ranks) + i) for bit in range(bits) for i, r in enumerate(ranks))

    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rng = random.Random(1)
    rows = [(rng.randrange(256), rng.randrange(256), rng.randrange(256)) for _ in range(200)]
    got = spark.createDataFrame(rows, "a int, b int, c int").select("a", "b", "c", mt.interleaved([F.col(x) for x in "abc"]).alias("k")).collect()
    assert all(r.k == plain((r.a, r.b, r.c), 8) for r in got)


def test_a_late_correction_is_refreshed_alone(spark, tmp_path):
    path, rollup, changes = (str(tmp_path / n) for n in ("t", "rollup", "changes"))
    rows = [(dt.date(2024, m, d), Decimal(m), Decimal(m + 1), Decimal(1), Decimal(m), 10 * m) for m in range(1, 7) for d in (1, 2)]
    mt.write_chunked(spark.createDataFrame(rows, SCHEMA), path)
    monthly_rollup(mt.read_chunked(spark, path)).where("month < DATE '2024-06-01'").write.parquet(rollup)
    assert mt.refresh_changed(spark, path, rollup, changes, TODAY) == []

    late = spark.createDataFrame([(dt.date(2024, 1, 2), Decimal(1), Decimal(2), Decimal(1), Decimal(1), 500), (dt.date(2024, 6, 2), Decimal(6), Decimal(7), Decimal(1), Decimal(6), 600)], SCHEMA)
    mt.upsert_table(spark, path, late.withColumn("at", F.lit(1)), ["date"], ["at"], changes=changes)
    # A month that did not change has lost its chunk, so reading it would fail the comparison.
    import shutil

    shutil.move(f"{path}/month=2024-03-01", str(tmp_path / "away"))
    spark.catalog.refreshByPath(path)
    assert mt.refresh_changed(spark, path, rollup, changes, TODAY) == [dt.date(2024, 1, 1)]  # June is not over
    got = {r.month.month: (r.trading_days, r.total_volume) for r in spark.read.parquet(rollup).collect()}
    assert got == {1: (2, 510), 2: (2, 40), 3: (2, 60), 4: (2, 80), 5: (2, 100)}
    live = {r.month.month: r.total_volume for r in mt.live_rollup(spark, path, rollup).collect()}
    assert live == {1: 510, 2: 40, 3: 60, 4: 80, 5: 100, 6: 660}
    assert mt.refresh_changed(spark, path, rollup, changes, TODAY) == []
    assert mt.refresh_changed(spark, path, rollup, changes, TODAY + dt.timedelta(days=60), start="1 day") == []  # outside the window: stays noted
    assert mt.refresh_changed(spark, path, rollup, changes, TODAY + dt.timedelta(days=60)) == [dt.date(2024, 6, 1)]
    assert mt.live_rollup(spark, path, rollup).count() == 6
