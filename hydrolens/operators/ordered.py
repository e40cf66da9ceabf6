"""Windows over one global order, without moving the table into one task.

The dashboards use `OVER (ORDER BY ts)` with no partition key. Spark runs that in a single task.
Here the order is cut into slices, whose sizes are counted, and runs of slices form blocks; each
block also receives the few slices that precede it, which hold at least `lookback` rows, so every
frame that looks back at most `lookback` rows is complete inside its block. The received rows are
dropped after the window.

Row placement is a pure function of the row's order key and of constants, so a recomputed task
gives the same rows after an executor loss. Where the cuts lie steers balance, never results.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from hydrolens.session import parallelism, stage as stage_rows

SLICES_PER_BLOCK = 16
MAX_BLOCKS = 16384
ONE_TASK_ROWS = 200_000  # an order of no more rows is sorted in one task, which takes less time than cutting it
MIN_CELLS = 4096
MIN_SLICE_ROWS = 64
SAMPLES_PER_SLICE = 20
MOST_SAMPLES = 200_000  # keys that may meet in one task; fewer for each slice only make the slices less even
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


@dataclass(frozen=True)
class Layout:
    """Where each slice of the order goes."""

    slice_id: Column
    targets: list[list[int]]  # slice -> own block, then the later blocks that look back into it
    offsets: list[int]  # block -> rows before it

    @property
    def blocks(self) -> int:
        return len(self.offsets)


def _literal(values: list, kind: str) -> Column:
    """A list as one constant, whatever its length."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _order_key(order: list[str]) -> Column:
    """Comparable struct with NULLs last, in the sort order used below."""
    parts = []
    for i, name in enumerate(order):
        parts += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"k{i}")]
    return F.struct(*parts)


def _sort(order: list[str]) -> list[Column]:
    return [F.asc_nulls_last(name) for name in order]


def position_of(df: DataFrame, name: str) -> Column | None:
    """A number that never falls as the column rises, for types that have a cheap one."""
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.IntegralType):
        return col.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        # By its fields, so that no time zone comes into it.
        return (F.unix_date(col.cast("date")) * 24 + F.hour(col)) * 3600.0 + F.minute(col) * 60 + F.second(col)
    return None


def _boundaries(keys: DataFrame, rows: int, slices: int) -> tuple[Column, int]:
    """Sampled slice boundaries as a constant array; at most a few per slice reach the driver."""
    slices = min(slices, MOST_SAMPLES // 2)
    wanted = min(slices * SAMPLES_PER_SLICE, MOST_SAMPLES)
    sample = keys if rows <= wanted else keys.sample(wanted / rows, seed=17)
    step = max(1, min(rows, wanted) // slices)
    picked = F.filter(F.sort_array(F.collect_list("key")), lambda _, i: i % step == step - 1)
    row = sample.agg(F.array_distinct(picked).alias("b")).select(F.to_json("b", _JSON).alias("text"), F.size("b").alias("n")).first()
    return F.from_json(F.lit(row.text), f"array<{keys.schema['key'].dataType.simpleString()}>", _JSON), row.n


def rank_among(key: Column, bounds: Column, size: int) -> Column:
    """Number of boundaries at or below the key, by binary search."""
    steps = F.array(*[F.lit(1 << p) for p in reversed(range(max(1, size.bit_length())))])

    def search(k: Column) -> Column:
        return F.aggregate(
            steps, F.lit(0), lambda at, jump: F.when(F.get(bounds, at + jump - 1) <= k, at + jump).otherwise(at)
        )

    # Through a one-element array, so that the key is built once and not at every step.
    return F.get(F.transform(F.array(key), search), 0)


def assign_targets(counts: dict[int, int], blocks: int, lookback: int) -> tuple[list[list[int]], list[int]]:
    """Group consecutive slices into about `blocks` blocks and route the lookback slices.

    Works for any slice sizes: a block shorter than `lookback` simply lets later blocks reach
    further back.
    """
    top = max(counts, default=0) + 1
    sizes = [counts.get(i, 0) for i in range(top)]
    quota = max(1, -(-sum(sizes) // blocks))
    own, offsets, before, used = [], [0], 0, 0
    for size in sizes:
        if used and used + size / 2 > quota:
            offsets.append(before)
            used = 0
        own.append(len(offsets) - 1)
        used += size
        before += size
    targets = [[block] for block in own]
    for block in range(1, len(offsets)):
        missing, at = lookback, bisect.bisect_left(own, block) - 1
        while missing > 0 and at >= 0:
            if sizes[at]:
                targets[at].append(block)
                missing -= sizes[at]
            at -= 1
    return targets, offsets


def _counts(df: DataFrame, *keys: Column) -> dict[tuple, int]:
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    return {tuple(r[:-1]): r.n for r in df.groupBy(*named).agg(F.count("*").alias("n")).collect()}


def _layout(df: DataFrame, order: list[str], lookback: int, block_rows: int) -> Layout:
    """Cut the order into slices of known size and the slices into blocks.

    The first order column is laid on an even grid, which costs a little arithmetic per row. Grid
    cells that hold too many rows (a busy hour, a third of the rows at one moment) are cut further
    at boundaries sampled from the whole key. A small order is one block and takes no more than the count.
    """
    position = position_of(df, order[0])
    ends = [F.min(position), F.max(position)] if position is not None else [F.lit(None), F.lit(None)]
    rows, low, high = df.agg(F.count("*"), *ends).first()
    if rows <= min(ONE_TASK_ROWS, block_rows):
        return Layout(F.lit(0), [[0]], [0])
    blocks = min(MAX_BLOCKS, max(parallelism(df.sparkSession), -(-rows // block_rows)))
    cells = max(MIN_CELLS, blocks * SLICES_PER_BLOCK) if low is not None else 1
    if low is None:
        cell, counts = F.lit(0), {0: rows}
    else:
        width = (high - low) / cells or 1.0
        cell = F.greatest(F.least(F.floor((position - low) / width), F.lit(cells - 1)), F.lit(0)).cast("int")
        cell = F.when(F.col(order[0]).isNull(), cells).otherwise(cell)
        counts = {k[0]: n for k, n in _counts(df, cell).items()}

    limit = max(MIN_SLICE_ROWS, rows // (blocks * SLICES_PER_BLOCK // 2))
    hot = {c for c, n in counts.items() if n > limit}
    if not hot:
        return Layout(cell, *assign_targets(counts, blocks, lookback))

    hot_rows = sum(counts[c] for c in hot)
    is_hot = F.get(_literal([c in hot for c in range(cells + 1)], "array<boolean>"), cell)
    key, crowded = _order_key(order), df.where(is_hot)
    bounds, size = _boundaries(crowded.select(key.alias("key")), hot_rows, max(2, 2 * hot_rows // limit))
    rank = rank_among(key, bounds, size)
    # Ranks rise with the key, so those of one cell are a run of numbers. Neighbouring cells may
    # share a rank; each keeps its own slice for it.
    parts = _counts(crowded, cell, rank)
    runs: dict[int, tuple[int, int]] = {}
    for c, r in sorted(parts):
        runs[c] = (runs.get(c, (r, r))[0], r)
    starts, sizes, at = [], {}, 0
    for c in range(cells + 1):
        first, last = runs.get(c, (0, 0))
        starts.append(at - first)
        for r in range(first, last + 1):
            sizes[at] = parts.get((c, r), 0) if c in runs else counts.get(c, 0)
            at += 1
    start = F.get(_literal(starts, "array<int>"), cell)
    slice_id = start + F.when(is_hot, rank).otherwise(0)
    return Layout(slice_id, *assign_targets(sizes, blocks, lookback))


def ordered_window(
    df: DataFrame,
    order: list[str],
    exprs: dict[str, Callable[[WindowSpec], Column]],
    lookback: int,
    series: list[str] | None = None,
    staged: bool = False,
    block_rows: int = 2_000_000,
) -> DataFrame:
    """Add window columns computed over `ORDER BY order` (optionally per `series`).

    `exprs` maps a new column name to a function of the window, e.g. {"prev": lambda w:
    F.lag("close").over(w)}; frames may reach back up to `lookback` rows and not forward.
    `order` must identify rows uniquely (add an id as the last column). `staged=True` writes a
    derived input once instead of recomputing it for each pass. Long series are cut like any
    other part of the order, so one series may hold most of the rows.

    Blocks are partitions in order and sorted inside, so the result comes out in the global order
    and needs no sort of its own.
    """
    df = stage_rows(df, "ordered") if staged else df
    full = [*(series or []), *order]
    plan = _layout(df, full, lookback, block_rows)
    targets = _literal(plan.targets, "array<array<int>>")
    placed = (
        df.withColumn("_slice", plan.slice_id)
        .select("*", F.posexplode(F.get(targets, F.col("_slice"))).alias("_copy", "_block"))
        .drop("_slice")
        .repartitionById(plan.blocks, F.col("_block"))
    )
    spec = Window.partitionBy("_block", *(series or [])).orderBy(*_sort(order))
    out = placed.select("*", *[make(spec).alias(name) for name, make in exprs.items()])
    return out.where(F.col("_copy") == 0).drop("_copy", "_block")


def dense_index(
    df: DataFrame,
    order: list[str],
    name: str = "row_index",
    staged: bool = False,
    block_rows: int = 2_000_000,
) -> DataFrame:
    """Add a gap-free 0-based position in the global order."""
    df = stage_rows(df, "indexed") if staged else df
    plan = _layout(df, order, 0, block_rows)
    own = _literal([t[0] for t in plan.targets], "array<int>")
    offsets = _literal(plan.offsets, "array<bigint>")
    spec = Window.partitionBy("_block").orderBy(*_sort(order))
    return (
        df.withColumn("_block", F.get(own, plan.slice_id))
        .repartitionById(plan.blocks, F.col("_block"))
        .withColumn(name, F.get(offsets, F.col("_block")) + F.row_number().over(spec) - 1)
        .drop("_block")
    )


def with_lookback(df: DataFrame, column: str, lower: Column, upper: Column, lookback: int) -> DataFrame:
    """Rows in [lower, upper] plus the `lookback` rows just before: all a backward frame needs.

    Lets a windowed alert on the newest rows read two pruned scans instead of the whole history.
    `column` identifies a row, as the date of a daily table does.
    """
    recent = df.where((F.col(column) >= lower) & (F.col(column) <= upper))
    prefix = df.where(F.col(column) < lower).orderBy(F.col(column).desc()).limit(lookback)
    return recent.unionByName(prefix)
