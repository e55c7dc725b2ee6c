"""What the text operators share: reading tables, whole texts, Arrow batches, written intermediate tables."""

from __future__ import annotations

import ctypes
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logharbor.session import prepare, written  # noqa: F401

#: Rows of one Arrow batch; texts are long, so batches are smaller than Spark's default.
BATCH_ROWS = 256
#: Bytes of text that are worked on at a time, so that the arrays stay in the processor's cache.
SLICE = 1 << 18


def session(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and Arrow batches sized for long texts."""
    prepare(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str) -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def by_shuffle(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """The join of two sides that both grow with the corpus; neither is broadcast, however small Spark takes it to be.

    Spark sizes a side by the files and columns it is read from. It counts a list as one element, does not see that
    an explode or mapInArrow makes many rows of one, and may so collect far more than its threshold in the driver.
    """
    return left.join(right.hint("merge"), on, how)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


_HANDED = [0.0]


def hand_back(at_once: bool = False) -> None:
    """Give freed memory back to the system, at most every two seconds unless asked for at once: workers are
    reused, and what one job held the next one does not need."""
    now = time.monotonic()
    if at_once or now - _HANDED[0] > 2:
        _HANDED[0] = now
        pa.default_memory_pool().release_unused()
        if _TRIM:
            _TRIM(0)


def by_batch(work: Callable[[pa.RecordBatch], pa.Table | pa.RecordBatch | None]) -> Callable:
    """A function for mapInArrow that treats each batch on its own; it may return nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := work(batch)) is not None:
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]
            del batch
            hand_back()

    return run


def arrow_column(work: Callable[[pa.Array], pa.Array], kind: str, limit: int = SLICE) -> Callable[[Column], Column]:
    """A function of one column, applied to about `limit` bytes of its values at a time."""

    @F.arrow_udf(kind)
    def apply(values: pa.Array) -> pa.Array:
        batch = pa.record_batch({"value": values})
        out = pa.concat_arrays([work(part.column("value")) for part in text_slices(batch, "value", limit)])
        hand_back()
        return out

    return apply


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about `limit` bytes; a longer text is a run of its own."""
    values = batch.column(column)
    sizes = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
    begin = total = 0
    for row, size in enumerate(sizes.to_pylist()):
        if total and total + (size or 0) > limit:
            yield batch.slice(begin, row - begin)
            begin, total = row, 0
        total += size or 0
    yield batch.slice(begin)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold all rows of each of their keys, from batches that come sorted by the key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        changes = pc.indices_nonzero(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)))
        if held and keys[0] != held[-1].column(key)[-1]:
            yield pa.Table.from_batches(held)
            held = []
        if len(changes):
            cut = changes[-1].as_py() + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, batch = [], batch.slice(cut)
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins, and the end."""
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
