"""Alerts when a stream falls silent, raised by timers and not by rows.

A series is healthy while `floor` rows or more lie in the last `span`. It stops being so at the moment a row leaves that
span and too few have followed it; each such moment gives one alert, until the series has been healthy again. A timer
is set for the next row that will leave, so an alert needs no further row: with `clock="event"` time is that of the
rows and moves with the watermark, with `clock="arrival"` it is the clock of the cluster, which also runs on when no series gets
any row at all.

What a series remembers is bounded, however many rows it has: only the first and the last `floor` rows of each cell of
time can decide an alert (a row with `floor` or more after it in its cell never does, and no count beyond `floor` matters),
so other rows are dropped, first in the tasks that read them and again where a series is kept. A series with most of
the rows is thinned out before it meets in one task. Cells that cannot change any more are evaluated and forgotten.

Rows without a time are passed over; a row whose series is null belongs to a series of its own; rows behind the
watermark come too late to count. A series that never had a row raises nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hydrolens.functions.time import micros_of

ALERT = "series string, time timestamp, rows bigint"


def thinned(times: np.ndarray, cell: int, floor: int) -> np.ndarray:
    """The first and the last `floor` of the sorted `times` of each cell."""
    if len(times) <= 2 * floor:
        return times
    _, start, size = np.unique(times // cell, return_index=True, return_counts=True)
    nth = np.arange(len(times)) - np.repeat(start, size)
    return times[(nth < floor) | (nth >= np.repeat(size, size) - floor)]


def falls_silent(times: np.ndarray, due: int, span: int, floor: int) -> list[tuple[int, int]]:
    """(moment, rows left) for each of the first `due` of the sorted `times` with whose leaving the rows get too few."""
    leaving, held = np.unique(times[:due], return_counts=True)
    after = np.searchsorted(times, leaving, side="right")
    left = np.searchsorted(times, leaving + span, side="right") - after
    falls = (left < floor) & (left + held >= floor)
    return [(int(t) + span, int(n)) for t, n in zip(leaving[falls], left[falls])]


def silence_alerts(
    rows: DataFrame,
    time: str = "timestamp",
    series: str | None = None,
    span: str = "10 minutes",
    floor: int = 5,
    lateness: str = "10 minutes",
    cell: str = "1 minute",
    clock: str = "event",
) -> DataFrame:
    """A stream of (series, time, rows): when a series fell below `floor` rows in `span`, and how many were left.

    Without a `series` column all rows are one series, named ''. An alert is raised at most one `cell` after its moment
    (with the event clock, once the watermark is there).
    """
    if clock not in ("event", "arrival"):
        raise ValueError(f"a clock is 'event' or 'arrival', not {clock!r}")
    span_us, cell_us = micros_of(span), micros_of(cell)
    if cell_us > span_us or floor < 1:
        raise ValueError("a cell is no longer than the span, and the floor is 1 or more")
    by_event = clock == "event"
    moment = F.col(time).cast("timestamp") if by_event else F.current_timestamp()
    name = F.lit("") if series is None else F.coalesce(F.concat(F.lit("="), F.col(series).cast("string")), F.lit("null"))
    read = rows.select(name.alias("name"), F.unix_micros(moment).alias("at")).where("at IS NOT NULL")

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, at in batch.groupby("name")["at"]:
                yield pd.DataFrame({"at": thinned(np.sort(at.to_numpy()), cell_us, floor)}).assign(name=key)[["name", "at"]]

    few = read.mapInPandas(thin, "name string, at bigint").withColumn("moment", F.timestamp_micros("at"))

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = [np.array(state.get[0], np.int64)] if state.exists else []
        for batch in batches:
            parts.append(thinned(np.sort(batch["at"].to_numpy()), cell_us, floor))
        times = thinned(np.sort(np.concatenate(parts)), cell_us, floor) if parts else np.empty(0, np.int64)
        now = (state.getCurrentWatermarkMs() if by_event else state.getCurrentProcessingTimeMs()) * 1000
        # Whole cells are evaluated, once every row that can follow theirs within the span is there.
        due = int(np.searchsorted(times, (now - span_us) // cell_us * cell_us)) if now > span_us else 0
        alerts = falls_silent(times, due, span_us, floor)
        times = times[due:]
        if len(times):
            state.update((times.tolist(),))
            wake = -(-((times[0] // cell_us + 1) * cell_us + span_us) // 1000)
            if by_event:
                state.setTimeoutTimestamp(int(max(wake, now // 1000 + 1)))
            else:
                state.setTimeoutDuration(int(max(1, wake - now // 1000)))
        elif state.exists:
            state.remove()
        if not alerts:
            return
        said = None if key[0] == "null" else key[0].removeprefix("=")
        yield pd.DataFrame(
            {"series": [said] * len(alerts), "time": pd.to_datetime([t for t, _ in alerts], unit="us", utc=True), "rows": np.array([n for _, n in alerts], np.int64)}
        )

    timeout = GroupStateTimeout.EventTimeTimeout if by_event else GroupStateTimeout.ProcessingTimeTimeout
    kept = few.withWatermark("moment", lateness) if by_event else few
    return kept.groupBy("name").applyInPandasWithState(watch, ALERT, "times array<bigint>", "append", timeout)
