"""Alert conditions over a metric stream: fired and resolved events with state per timeline."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from logharbor.functions.timestamps import width_seconds
from logharbor.operators.alerts import apply_conditions
from logharbor.specs import AlertCondition

EVENTS = "alert string, series string, severity string, event string, ts timestamp, value double"
# microseconds since when the condition holds (-1: it does not), and the samples that wait for the watermark
STATE = "since long, fired boolean, us array<long>, tie array<double>, holds array<boolean>, value array<double>"


def _last_looks(samples: list[tuple], check_us: int) -> list[tuple]:
    """The last sample of each interval, by time and tie."""
    return list({s[0] // check_us: s for s in sorted(samples, key=lambda s: s[:2])}.values())


def _last_of_batch(check_us: int) -> Callable:
    line = ["alert", "series", "severity", "duration"]

    def reduced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            look = frame["ts"].astype("datetime64[us]").astype("int64") // check_us
            ordered = frame.assign(look=look).sort_values(["ts", "tie"])
            yield ordered.drop_duplicates([*line, "look"], keep="last").drop(columns="look")

    return reduced


def _follower(check_us: int) -> Callable:
    def follow(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """Advance one timeline as far as the watermark: remember since when the condition holds, fire and resolve once."""
        since, fired, *waiting = state.get if state.exists else (-1, False, [], [], [], [])
        samples = list(zip(*waiting))
        for frame in frames:
            us = frame["ts"].astype("datetime64[us]").astype("int64")
            samples += zip(us.tolist(), frame["tie"].tolist(), frame["holds"].tolist(), frame["value"].tolist())
            if check_us:
                samples = _last_looks(samples, check_us)
        samples.sort(key=lambda s: s[:2])
        passed = state.getCurrentWatermarkMs() * 1000
        if check_us:
            passed = passed // check_us * check_us
        due = [s for s in samples if s[0] < passed]
        samples = samples[len(due) :]
        out = []
        severity, duration = key[2], int(key[3])
        for us, _, holds, value in due:
            if holds:
                since = us if since < 0 else since
                if not fired and us - since >= duration * 1_000_000:
                    fired = True
                    out.append((key[0], key[1], severity, "fired", pd.Timestamp(us, unit="us"), value))
            else:
                if fired:
                    out.append((key[0], key[1], severity, "resolved", pd.Timestamp(us, unit="us"), value))
                since, fired = -1, False
        if samples or since >= 0:
            state.update((since, fired, *([s[k] for s in samples] for k in range(4))))
            if samples:
                state.setTimeoutTimestamp(max(samples[0][0] // 1000, state.getCurrentWatermarkMs()) + 1 + check_us // 1000)
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["alert", "series", "severity", "event", "ts", "value"])

    return follow


def alert_events(
    samples: DataFrame,
    conditions: list[AlertCondition],
    tie: str = "value",
    late: str = "10 minutes",
    check: str | None = None,
) -> DataFrame:
    """Events of each (alert, series); samples have series, name, ts, value and the numeric `tie` column.

    Samples wait until the watermark passes them, so those up to `late` behind the newest one are judged
    in the order of their times, as the batch job does; of equal times in the order of `tie`. Later ones
    are dropped, and Spark counts them in the progress of the query (numRowsDroppedByWatermark). With
    `check`, only the last sample of each such interval is judged, as after `last_per_check`: Arrow batches
    keep one sample per timeline and interval before they are grouped, and so does the state, so a series
    that fills a third of the stream is a few rows to its task. Without it the state of a timeline is the
    samples that wait for the watermark; `maxFilesPerTrigger` of the source bounds what a batch adds to
    them. While a condition holds, its state also has since when; else there is none.
    """
    columns = ["series", "name", "ts", "value", F.col(tie).cast("double").alias("tie")]
    line = ["alert", "series", "severity", "duration"]
    judged = apply_conditions(samples.select(*columns), conditions).select(*line, "ts", "tie", "holds", "value")
    check_us = int(width_seconds(check) * 1_000_000) if check else 0
    if check:
        judged = judged.mapInPandas(_last_of_batch(check_us), judged.schema)
    return judged.withWatermark("ts", late).groupBy("alert", "series", "severity", "duration").applyInPandasWithState(
        _follower(check_us),
        EVENTS, STATE, "append", GroupStateTimeout.EventTimeTimeout,
    )


def append_alerts(events: DataFrame, epoch: int, path: str) -> None:
    """Alert rows of one micro-batch as a folder of its epoch; a repeated epoch overwrites it."""
    events.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def alert_writer(path: str, handlers: Sequence[Callable[[DataFrame], None]] = ()) -> Callable[[DataFrame, int], None]:
    """A function for foreachBatch: append the alert rows, then give what was written to each handler.

    A handler that fails does not keep the others from running, nor the batch from being committed: its
    error goes to `<path>_errors`, in the folder of the epoch. Handlers see a repeated epoch again.
    """

    def write(events: DataFrame, epoch: int) -> None:
        append_alerts(events, epoch, path)
        rows = events.sparkSession.read.schema(EVENTS).parquet(f"{path}/epoch={epoch}")
        errors = []
        for handler in handlers:
            try:
                handler(rows)
            except Exception as error:
                errors.append((getattr(handler, "__name__", type(handler).__name__), type(error).__name__, str(error)))
        if errors:
            failed = events.sparkSession.createDataFrame(errors, "handler string, error_type string, error string")
            failed.write.mode("overwrite").parquet(f"{path}_errors/epoch={epoch}")

    return write
