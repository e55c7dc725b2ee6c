"""States that merge: quantiles and distinct counts per series and time slot, answered over any range from the states alone.

A state has one row per key and slot, whatever the number of rows behind it, and states of different days,
tables or clusters are unions of rows. Answers carry the error that the sketch's size stands for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logharbor.functions.timestamps import as_timestamp, bin_time

#: Size of a quantile sketch; ranks are off by about 2.3 / size ** 0.9 (0.7 % of the rows at this size, in 99 of 100 cases).
QUANTILE_SIZE = 512
#: Base-2 logarithm of the registers of a distinct-count sketch; its relative error is 1.04 / sqrt(registers).
DISTINCT_BITS = 14


def quantile_state(samples: DataFrame, keys: list[str], every: str = "1 hour", column: str = "value", size: int = QUANTILE_SIZE) -> DataFrame:
    """Per key and slot: a quantile sketch of the values, how many there are, the least and the largest.

    Null and NaN values are left out; a slot without values has no row.
    """
    rows = samples.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    slot = bin_time(F.col("ts"), every).alias("slot")
    return rows.groupBy(*keys, slot).agg(
        F.kll_sketch_agg_double(F.col(column).cast("double"), size).alias("sketch"),
        F.count(F.lit(1)).alias("samples"),
        F.min(column).alias("lowest"),
        F.max(column).alias("highest"),
    )


def _within(state: DataFrame, since, until) -> DataFrame:
    if since is not None:
        state = state.where(F.col("slot") >= as_timestamp(since))
    return state if until is None else state.where(F.col("slot") < as_timestamp(until))


def quantiles(state: DataFrame, keys: list[str], ranks: dict[str, float], since=None, until=None) -> DataFrame:
    """Per key, the values at these ranks (name: share of the rows) over the slots from `since` to before `until`."""
    merged = _within(state, since, until).groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch").alias("sketch"),
        F.sum("samples").alias("samples"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
    )
    found = {name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(rank))) for name, rank in ranks.items()}
    return merged.withColumns(found).drop("sketch")


def distinct_state(
    rows: DataFrame, keys: list[str], columns: list[str], time: str = "TimeGenerated", every: str = "1 hour", bits: int = DISTINCT_BITS
) -> DataFrame:
    """Per key and slot: a distinct-count sketch of each column, the rows, and the first and last time.

    Nulls are not counted. Values are compared as text.
    """
    slot = bin_time(F.col(time), every).alias("slot")
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), bits).alias(f"{c}_sketch") for c in columns]
    return rows.groupBy(*keys, slot).agg(
        *sketches, F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_seen"), F.max(time).alias("last_seen")
    )


def distinct_counts(state: DataFrame, keys: list[str], columns: list[str], since=None, until=None) -> DataFrame:
    """Per key, the estimated number of different values of each column over the slots of a range, and its rows."""
    unions = [F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(c) for c in columns]
    return _within(state, since, until).groupBy(*keys).agg(
        *unions, F.sum("rows").alias("rows"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")
    )


def close_to(estimate: Column, exact: Column, bits: int = DISTINCT_BITS, sigmas: float = 4.0) -> Column:
    """Whether an estimate is as near to the exact count as sketches of this size are but once in many thousand times."""
    return F.abs(estimate - exact) <= F.greatest(exact * sigmas * 1.04 / 2 ** (bits / 2), F.lit(1.0))
