"""Upkeep of a time-series table kept as monthly chunks, and of its monthly rollup.

A chunk is one `month=` partition. New chunks are written whole beside the table and then change
places with the old ones by renaming, month by month. A run that ends in between leaves every month
either old or new, and the next run puts back what was on its way out, so a failed run can be
repeated.
"""

from __future__ import annotations

import json
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from hydrolens.functions.text import size_text
from hydrolens.functions.time import Moment, Range, ago, in_range, moment
from hydrolens.operators.ordered import position_of, rank_among
from hydrolens.operators.upsert import upsert_rows
from hydrolens.plans.prices import monthly_rollup
from hydrolens.session import delete_path, staging

MONTH = "month"
# Folders of chunks on their way in and out; names with a leading '_' are no part of the table.
IN, OUT = "_incoming-", "_outgoing-"


# --- chunks ------------------------------------------------------------------------------------


def _month(time: str) -> Column:
    return F.trunc(F.col(time).cast("date"), "MM")


def _by_chunk(df: DataFrame, *order: Column) -> DataFrame:
    """Gather each chunk; the rebalance step splits a chunk that is far larger than the others."""
    return df.hint("rebalance", MONTH).sortWithinPartitions(MONTH, *order)


def write_chunked(df: DataFrame, path: str, time: str = "date", mode: str = "append") -> None:
    """Write as monthly chunks, sorted by time so that row groups can be skipped."""
    _by_chunk(df.withColumn(MONTH, _month(time)), F.col(time)).write.mode(mode).partitionBy(MONTH).parquet(path)


def _chunk_schema(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.parquet(path)
    return table.withColumn(MONTH, F.col(MONTH).cast("date")) if table.schema[MONTH].dataType != T.DateType() else table


def read_chunked(spark: SparkSession, path: str, rng: Range = None, time: str = "date") -> DataFrame:
    """Rows in a closed time range; the chunk predicate lets the scan skip whole months."""
    table = _chunk_schema(spark, path)
    if rng is not None:
        day = [None if end is None else F.trunc(moment(end, T.DateType()), "MM") for end in rng]
        table = in_range(in_range(table, MONTH, (day[0], day[1])), time, rng)
    return table.drop(MONTH)


def chunks(spark: SparkSession, path: str) -> list[date]:
    """Months present, from the names of the folders alone."""
    found = [date.fromisoformat(name.partition("=")[2]) for name in _names(spark, path) if name.startswith(f"{MONTH}=")]
    return sorted(found)


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder."""
    system, target = _files(spark, path)
    return sorted(status.getPath().getName() for status in system.listStatus(target)) if system.exists(target) else []


def _rename(spark: SparkSession, old: str, new: str) -> None:
    system, source = _files(spark, old)
    if not system.rename(source, spark._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"{old} could not be renamed to {new}")


def recover(spark: SparkSession, path: str) -> None:
    """Finish what a run that ended early has left: old chunks without a new one come back, all other leftovers go."""
    names = _names(spark, path)
    for name in names:
        if name.startswith(OUT):
            chunk = f"{MONTH}={name.removeprefix(OUT)}"
            if chunk in names:
                delete_path(spark, f"{path}/{name}")
            else:
                _rename(spark, f"{path}/{name}", f"{path}/{chunk}")
        elif name.startswith(IN):
            delete_path(spark, f"{path}/{name}")


def _replace_chunks(df: DataFrame, path: str, **options) -> None:
    """Put the chunks of `df` in the place of the table's; other months stay as they are. `df` may read the table."""
    spark, fresh = df.sparkSession, f"{path}/{IN}{uuid.uuid4().hex}"
    df.write.options(compression="zstd", **options).partitionBy(MONTH).parquet(fresh)
    present = set(_names(spark, path))
    for chunk in [name for name in _names(spark, fresh) if name.startswith(f"{MONTH}=")]:
        old = f"{path}/{OUT}{chunk.partition('=')[2]}"
        if chunk in present:
            _rename(spark, f"{path}/{chunk}", old)
        _rename(spark, f"{fresh}/{chunk}", f"{path}/{chunk}")
        if chunk in present:
            delete_path(spark, old)
    delete_path(spark, fresh)
    spark.catalog.refreshByPath(path)


def upsert_table(
    spark: SparkSession, path: str, updates: DataFrame, keys: list[str], sequence: list[str], time: str = "date", changes: str | None = None
) -> list[date]:
    """Upsert into a chunked table, rewriting only the months the updates touch. A table that is not there yet is begun.

    With `changes`, a folder, the months are noted there before they change, for `refresh_changed`.
    """
    if time not in keys:
        raise ValueError("the key must contain the time column, which decides the chunk")
    recover(spark, path)
    with staging(spark) as keep:
        fresh = keep(updates.withColumn(MONTH, _month(time)), "updates")
        months = sorted(r[MONTH] for r in fresh.select(MONTH).distinct().collect())
        if months:
            if changes:
                spark.createDataFrame([(m,) for m in months], f"{MONTH} date").coalesce(1).write.mode("append").parquet(changes)
            touched = _chunk_schema(spark, path).where(F.col(MONTH).isin(months)) if chunks(spark, path) else fresh.limit(0)
            _replace_chunks(_by_chunk(upsert_rows(touched, fresh, [*keys, MONTH], sequence), F.col(time)), path)
    return months


# --- clustering --------------------------------------------------------------------------------

CLUSTER_BITS = 8


def interleaved(ranks: list[Column], bits: int = CLUSTER_BITS) -> Column:
    """One number from several of `bits` bits each, bit by bit in turn, so that near in it is near in all of them."""
    parts = []
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            taken = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            parts.append(F.shiftleft(taken, bit * len(ranks) + i))
    key = parts[0]
    for part in parts[1:]:
        key = key.bitwiseOR(part)
    return key


def cluster_key(df: DataFrame, columns: list[str], bits: int = CLUSTER_BITS) -> Column:
    """Position on a space-filling curve through `columns`, each ranked by its own quantiles; nulls rank first.

    The quantiles come from one pass and are at most 2^bits numbers for each column. They decide where rows lie, never which
    rows a query finds.
    """
    steps = [F.lit(i / (1 << bits)) for i in range(1, 1 << bits)]
    places = {c: position_of(df, c) for c in columns}
    number = {c: F.col(c).cast("double") if at is None else at for c, at in places.items()}
    row = df.agg(*[F.percentile_approx(number[c], F.array(*steps), F.lit(10_000)).alias(c) for c in columns]).first()
    ranks = []
    for c in columns:
        bounds = sorted(set(row[c] or []))
        listed = F.from_json(F.lit(json.dumps(bounds)), "array<double>")
        ranks.append(F.coalesce(rank_among(number[c], listed, len(bounds)), F.lit(0)))
    return interleaved(ranks, bits)


def cluster(spark: SparkSession, path: str, columns: list[str], months: list[date] | None = None, rows_per_file: int = 5_000_000) -> list[date]:
    """Rewrite chunks so that a filter on any of `columns` skips most files and row groups; returns their months.

    A chunk sorted by time has every volume in every file. Along the curve each file holds a narrow range of all
    columns at once, and the least and largest values that Parquet keeps for each file and row group let the scan pass over
    the others, without a table of its own to keep up to date. Ranges of the curve go to tasks, so a large month is
    spread over many.
    """
    recover(spark, path)
    months = sorted(set(chunks(spark, path)) & set(months)) if months is not None else chunks(spark, path)
    if months:
        rows = _chunk_schema(spark, path).where(F.col(MONTH).isin(months))
        keyed = rows.withColumn("_curve", cluster_key(rows, columns))
        ordered = keyed.repartitionByRange(MONTH, "_curve").sortWithinPartitions(MONTH, "_curve").drop("_curve")
        _replace_chunks(ordered, path, maxRecordsPerFile=rows_per_file)
    return months


# --- rollup ------------------------------------------------------------------------------------


def refresh_window(as_of: Moment, start: str = "3 months", end: str = "1 day") -> tuple[Column, Column]:
    """[first, last) months that lie wholly inside [as_of - start, as_of - end)."""
    low, high = ago(as_of, start, T.TimestampNTZType()), ago(as_of, end, T.TimestampNTZType())
    month = F.trunc(low.cast("date"), "MM")
    first = F.when(month.cast("timestamp_ntz") == low, month).otherwise(F.add_months(month, 1))
    return first, F.trunc(high.cast("date"), "MM")


def refreshed_rollup(rollup: DataFrame, base: DataFrame, as_of: Moment, start: str = "3 months", end: str = "1 day") -> DataFrame:
    """The rollup with the months inside the refresh window recomputed and all others as they are."""
    first, last = refresh_window(as_of, start, end)
    inside = (F.col(MONTH) >= first) & (F.col(MONTH) < last)
    source = base.where((F.col("date") >= first) & (F.col("date") < last))
    if MONTH in base.columns:
        source = source.where(inside)
    fresh = monthly_rollup(source.drop(MONTH))
    return rollup.where(~inside).unionByName(fresh.select(*rollup.columns))


def refresh_rollup(spark: SparkSession, base: DataFrame, path: str, as_of: Moment, start: str = "3 months", end: str = "1 day") -> None:
    """Refresh the stored rollup. It has one row per month, so it is rewritten as one small file."""
    with staging(spark) as keep:
        fresh = keep(refreshed_rollup(spark.read.parquet(path), base, as_of, start, end), "rollup")
        fresh.coalesce(1).write.mode("overwrite").parquet(path)


def refresh_changed(spark: SparkSession, path: str, rollup: str, changes: str, as_of: Moment, start: str | None = None, end: str = "1 day") -> list[date]:
    """Recompute the stored rollup of just the months noted in `changes`, however old; returns them.

    Only the chunks of those months are read. Months that are not over by `as_of - end`, or begin before `as_of - start`
    if that is given, stay noted for a later run. Notes are removed last and by file, so those of upserts that come meanwhile
    stay, and a run that dies is repeated.
    """
    notes = [f"{changes}/{name}" for name in _names(spark, changes) if name.endswith(".parquet")]
    if not notes:
        return []
    noted = spark.read.schema(f"{MONTH} date").parquet(*notes).distinct()
    over = closed_before(F.col(MONTH), as_of, end)
    inside = over if start is None else over & (F.col(MONTH).cast("timestamp_ntz") >= ago(as_of, start, T.TimestampNTZType()))
    marked = noted.withColumn("due", inside).collect()
    months = sorted(r[MONTH] for r in marked if r.due)
    if months:
        base = _chunk_schema(spark, path).where(F.col(MONTH).isin(months)).drop(MONTH)
        stored = spark.read.parquet(rollup)
        fresh = monthly_rollup(base).select(*stored.columns)
        with staging(spark) as keep:
            keep(stored.where(~F.col(MONTH).isin(months)).unionByName(fresh), "rollup").coalesce(1).write.mode("overwrite").parquet(rollup)
    later = [(r[MONTH],) for r in marked if not r.due]
    if later:
        spark.createDataFrame(later, f"{MONTH} date").coalesce(1).write.mode("append").parquet(changes)
    for note in notes:
        delete_path(spark, note)
    spark.catalog.refreshByPath(changes)
    return months


def live_rollup(spark: SparkSession, path: str, rollup: str) -> DataFrame:
    """The stored rollup, and the months after its last one worked out from the table: only their chunks are read."""
    stored = spark.read.parquet(rollup)
    mark = stored.agg(F.max(MONTH)).first()[0]
    base = _chunk_schema(spark, path)
    fresh = monthly_rollup((base if mark is None else base.where(F.col(MONTH) > F.lit(mark))).drop(MONTH))
    return stored.unionByName(fresh.select(*stored.columns))


# --- retention, compaction ---------------------------------------------------------------------


def closed_before(month: Column, as_of: Moment, age: str) -> Column:
    """The whole month lies before `as_of - age`."""
    return F.add_months(month, 1).cast("timestamp_ntz") <= ago(as_of, age, T.TimestampNTZType())


def retained(df: DataFrame, as_of: Moment, age: str = "7 years", time: str = "date") -> DataFrame:
    """Rows of the months that retention keeps. Whole months go, never parts of one."""
    return df.where(~closed_before(_month(time), as_of, age))


def _old_chunks(spark: SparkSession, path: str, as_of: Moment, age: str) -> list[date]:
    """Months that closed before `as_of - age`: the folder names, compared in one small job."""
    months = spark.createDataFrame([(m,) for m in chunks(spark, path)], f"{MONTH} date")
    return sorted(r[MONTH] for r in months.where(closed_before(F.col(MONTH), as_of, age)).collect())


def retain(spark: SparkSession, path: str, as_of: Moment, age: str = "7 years") -> list[date]:
    """Drop chunks that lie wholly before `as_of - age`; returns their months."""
    recover(spark, path)
    old = _old_chunks(spark, path, as_of, age)
    for month in old:
        delete_path(spark, f"{path}/{MONTH}={month.isoformat()}")
    spark.catalog.refreshByPath(path)
    return old


def compact(
    spark: SparkSession, path: str, as_of: Moment, age: str = "3 months", time: str = "date", done: list[date] = (), log: str | None = None
) -> list[date]:
    """Rewrite chunks older than `age` with newest rows first, in few zstd files; returns their months.

    Months compacted before are left alone: those in `done`, and those that `log` has (see `logged`).
    """
    recover(spark, path)
    before = {*done, *(compacted_months(spark, log, path) if log else ())}
    months = [m for m in _old_chunks(spark, path, as_of, age) if m not in before]
    if months:
        rows = _chunk_schema(spark, path).where(F.col(MONTH).isin(months))
        _replace_chunks(_by_chunk(rows, F.desc(time)), path)
    return months


def storage_stats(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes per chunk, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    month = F.regexp_extract("path", rf"/{MONTH}=([^/]+)/", 1).cast("date")
    return (
        files.groupBy(month.alias(MONTH))
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        .withColumn("size", size_text(F.col("bytes")))
    )


def total_bytes(spark: SparkSession, path: str) -> int:
    return storage_stats(spark, path).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]


# --- log ---------------------------------------------------------------------------------------

LOG = "job string, as_of timestamp_ntz, table string, months array<date>, before_bytes bigint, after_bytes bigint"


def logged(spark: SparkSession, log: str, job: str, path: str, as_of, run) -> list[date]:
    """Run a maintenance job `run() -> months` and append one row about it to the log table."""
    before = total_bytes(spark, path)
    months = run()
    row = (job, as_of, path, list(months or []), before, total_bytes(spark, path))
    spark.createDataFrame([row], LOG).write.mode("append").parquet(log)
    return months


def maintenance_log(spark: SparkSession, log: str) -> DataFrame:
    """All runs, with readable sizes."""
    return spark.read.schema(LOG).parquet(log).withColumns(
        {"before": size_text(F.col("before_bytes")), "after": size_text(F.col("after_bytes"))}
    )


def compacted_months(spark: SparkSession, log: str, path: str) -> list[date]:
    """Months the log says are compacted already; none while there is no log."""
    system, target = _files(spark, log)
    if not system.exists(target):
        return []
    runs = spark.read.schema(LOG).parquet(log).where((F.col("job") == "compact") & (F.col("table") == path))
    return sorted(r.m for r in runs.select(F.explode("months").alias("m")).distinct().collect())
