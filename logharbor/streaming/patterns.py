"""Running pattern counts that survive micro-batches and forget patterns not seen for a while."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from logharbor.operators.patterns import COUNTERS, pattern_summary

COUNTS = "pattern string, frequency long, last_seen timestamp, forgotten boolean"
STATE = "frequency long, last_ms long"


def _counter(ttl_ms: int) -> Callable:
    def count(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            frequency, last_ms = state.get
            state.remove()
            yield _row(key[0], frequency, last_ms, True)
            return
        frequency, last_ms = state.get if state.exists else (0, 0)
        for frame in frames:
            frequency += int(frame["rows"].sum())
            newest = frame["ts"].max()
            last_ms = max(last_ms, int(newest.value // 1_000_000))
        state.update((frequency, last_ms))
        state.setTimeoutTimestamp(max(last_ms + ttl_ms, state.getCurrentWatermarkMs() + 1))
        yield _row(key[0], frequency, last_ms, False)

    return count


def _row(pattern: str, frequency: int, last_ms: int, forgotten: bool) -> pd.DataFrame:
    seen = pd.Timestamp(last_ms, unit="ms")
    return pd.DataFrame(
        {"pattern": [pattern], "frequency": [frequency], "last_seen": [seen], "forgotten": [forgotten]}
    )


def _combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per pattern of an Arrow batch: its rows and its newest time."""
    for frame in frames:
        yield frame.assign(rows=1).groupby("pattern", as_index=False).agg({"rows": "sum", "ts": "max"})[["pattern", "rows", "ts"]]


def summary_writer(path: str, counters: int = COUNTERS) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch: bounded summaries of the patterns of each micro-batch, a folder for each epoch.

    However many patterns there are, an epoch adds a few rows per task and no state is kept; a repeated
    epoch overwrites its folder. `heavy_patterns` over any of the folders gives bounds of the frequencies.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        pattern_summary(batch, counters).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return write


def running_pattern_counts(hashed: DataFrame, ttl_seconds: int = 86_400, late: str = "10 minutes") -> DataFrame:
    """After each micro-batch, the count so far of every pattern in it.

    `hashed` is a stream with `pattern` and `ts`. A pattern unseen for `ttl_seconds` of event time is
    dropped from the state with a last row marked `forgotten`. Batches combine their rows first, so
    a pattern that fills a third of the stream reaches its task as one row per Arrow batch, and nothing is held.
    """
    rows = hashed.select("pattern", "ts").where("pattern is not null")
    rows = rows.mapInPandas(_combine, "pattern string, rows long, ts timestamp").withWatermark("ts", late)
    return rows.groupBy("pattern").applyInPandasWithState(
        _counter(ttl_seconds * 1000), COUNTS, STATE, "update", GroupStateTimeout.EventTimeTimeout
    )
