"""Clusters of equal rows, repeating sequences, enrichment and triage of log rows."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logharbor.functions.blocks import AT, Blocks, running_number, salted_join
from logharbor.operators.features import MISSING_PRIORITY
from logharbor.session import cut_lineage

# Window length, reporting limits, cluster size and the priority of urgent rows.
WINDOW = 5
REPEATS = 10
SIGNIFICANT = 100
TOP_PATTERNS = 10
MIN_CLUSTER = 5
#: Counters of a task in a summary of patterns.
COUNTERS = 1000
URGENT = 0.8


def _group_sizes(features: DataFrame, columns: list[str], ts: str, tie: str) -> DataFrame:
    """Size and first row of every group of equal features, written once for the uses that follow.

    Fractional values are refused: closer than the radius no longer means equal then.
    """
    sizes = features.groupBy(*columns).agg(F.count("*").alias("size"), F.min(F.struct(ts, tie)).alias("_at_first"))
    place = F.col("_at_first")
    sizes = cut_lineage(sizes.select(*columns, "size", place[ts].alias("_first"), place[tie].alias("_tie")))
    numeric = [f.name for f in sizes.select(*columns).schema if isinstance(f.dataType, T.NumericType)]
    parts = [F.coalesce(F.col(c) != F.floor(c), F.lit(False)) for c in numeric]
    if parts and not sizes.where(reduce(Column.__or__, parts)).isEmpty():
        raise ValueError("clusters are groups of equal rows only for whole-numbered features")
    return sizes


def _number_clusters(sizes: DataFrame, columns: list[str], min_size: int) -> DataFrame:
    numbered = running_number(sizes.where(F.col("size") >= min_size), [], ["_first", "_tie"], "_number")
    return numbered.select(*columns, "size", (F.col("_number") - 1).alias("cluster"))


def cluster_table(features: DataFrame, columns: list[str], ts: str, tie: str, min_size: int = MIN_CLUSTER) -> DataFrame:
    """Clusters of integer-valued features with their size and label.

    Rows whose features differ are at least 1 apart, so density clustering with a radius below 1 is
    grouping by equality. Labels number the clusters by their first row.
    """
    return _number_clusters(_group_sizes(features, columns, ts, tie), columns, min_size)


def label_clusters(
    features: DataFrame, columns: list[str], ts: str, tie: str, min_size: int = MIN_CLUSTER
) -> DataFrame:
    """Rows with their cluster label, -1 for noise; a very large cluster is spread over tasks.

    The rows are read twice: once for the sizes of the groups, once for the join.
    """
    sizes = _group_sizes(features, columns, ts, tie)
    clusters = _number_clusters(sizes, columns, min_size).drop("size")
    counts = sizes.select(*columns, F.col("size").alias("_rows"))
    joined = salted_join(features, clusters, columns, "left", [tie], counts)
    return joined.withColumn("cluster", F.coalesce("cluster", F.lit(-1).cast("bigint")))


def _sequenced(rows: DataFrame, keys: list[str], order: list[str], element: Column, length: int) -> DataFrame:
    """Adds `start_idx`, the position in the key, and `pattern`; keeps the slice column.

    A slice hands on its number of rows and its first `length` - 1 elements, which complete the windows
    at the end of the slices before it.
    """
    blocks = Blocks(rows, keys, order)
    df = blocks.df.withColumns({"_nth": F.row_number().over(blocks.window), "_element": element.cast("string")})
    head = F.when(F.col("_nth") < length, F.struct("_nth", F.col("_element").alias("v")))
    sums = df.groupBy(AT).agg(F.count(F.lit(1)).alias("_n"), F.sort_array(F.collect_list(head)).alias("_head"))
    following = F.flatten(F.collect_list("_head").over(blocks.neighbours(1, length - 1)))
    edges = sums.select(
        AT,
        F.coalesce(F.sum("_n").over(blocks.earlier), F.lit(0)).alias("_before"),
        F.transform(F.slice(following, 1, length - 1), lambda h: h["v"]).alias("_next"),
    )
    here = F.collect_list("_element").over(blocks.window.rowsBetween(0, length - 1))
    df = df.join(edges, AT).withColumn("_window", F.slice(F.concat(here, "_next"), 1, length))
    pattern = F.when(F.size("_window") == length, F.md5(F.array_join("_window", "\x1f")))
    start = (F.col("_nth") + F.col("_before") - 1).cast("bigint")
    return df.withColumns({"start_idx": start, "pattern": pattern}).drop("_nth", "_element", "_before", "_next", "_window")


def sequence_hashes(rows: DataFrame, keys: list[str], order: list[str], element: Column, length: int = WINDOW) -> DataFrame:
    """Adds `pattern`, the md5 of this and the next rows of the key.

    Rows with fewer than `length` rows from there on have no pattern.
    """
    return _sequenced(rows, keys, order, element, length).drop(AT, "start_idx")


def numbered_sequences(
    rows: DataFrame, keys: list[str], order: list[str], element: Column, length: int = WINDOW
) -> DataFrame:
    """Every row with its position in the key, its pattern and how often that has occurred so far.

    The rows with their patterns are written once; they are numbered per (key, pattern) from there.
    """
    hashed = cut_lineage(_sequenced(rows, keys, order, element, length).drop(AT))
    counted = running_number(hashed, [*keys, "pattern"], order, "_frequency")
    frequency = F.when(F.col("pattern").isNotNull(), F.col("_frequency"))
    return counted.withColumns({"frequency": frequency, "length": F.lit(length)}).drop("_frequency")


def repeat_sequences(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    element: Column,
    length: int = WINDOW,
    repeats: int = REPEATS,
) -> DataFrame:
    """Windows whose pattern has occurred more than `repeats` times in their key so far.

    The row a window starts at carries `start_idx`, `length` and `frequency` (the running count).
    """
    return numbered_sequences(rows, keys, order, element, length).where(F.col("frequency") > repeats)


def frequent_patterns(hashed: DataFrame, n: int = TOP_PATTERNS, significant: int = SIGNIFICANT) -> DataFrame:
    """The most frequent patterns and whether they are significant."""
    return (
        hashed.where(F.col("pattern").isNotNull())
        .groupBy("pattern")
        .agg(F.count("*").alias("frequency"))
        .orderBy(F.desc("frequency"), "pattern")
        .limit(n)
        .withColumn("significant", F.col("frequency") > significant)
    )


def pattern_summary(hashed: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Patterns that may be frequent, counted in bounded memory: a few rows from each task, whatever it read.

    Each task keeps `counters` counters. Where there are more patterns, all counters go down by the largest
    that does not fit any more, and the sum of what was taken is the task's `slack`: no pattern has lost
    more. Rows are pattern, counted and slack; every task has a row without a pattern for its slack and
    its number of rows. Summaries of several jobs are simply put together.
    """

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, slack, rows = pd.Series(dtype="int64"), 0, 0
        for frame in frames:
            rows += len(frame)
            held = held.add(frame["pattern"].value_counts(), fill_value=0).astype("int64")
            if len(held) > counters:
                cut = int(held.nlargest(counters + 1).iloc[-1])
                slack, held = slack + cut, held[held > cut] - cut
        found = pd.DataFrame({"pattern": held.index.astype("object"), "counted": held.to_numpy(), "slack": 0})
        yield pd.concat([found, pd.DataFrame({"pattern": [None], "counted": [rows], "slack": [slack]})])

    rows = hashed.select("pattern").where("pattern is not null")
    return rows.mapInPandas(summed, "pattern string, counted long, slack long")


def heavy_patterns(summary: DataFrame, share: float | None = None) -> DataFrame:
    """Patterns with bounds of their frequency (`at_least`, `at_most`), from a summary.

    A pattern that is not listed is at most as frequent as the sum of all slack, which is under the number
    of rows divided by the counters. With `share`, those that may make up so much of all rows: none is missed.
    """
    totals = summary.where("pattern is null").agg(F.coalesce(F.sum("counted"), F.lit(0)).alias("rows"), F.coalesce(F.sum("slack"), F.lit(0)).alias("slack"))
    found = summary.where("pattern is not null").groupBy("pattern").agg(F.sum("counted").alias("at_least"))
    found = found.withColumn("at_most", F.col("at_least") + totals.select("slack").scalar())
    return found if share is None else found.where(F.col("at_most") >= totals.select("rows").scalar() * F.lit(float(share)))


def attach_sequences(numbered: DataFrame, keys: list[str], repeats: int = REPEATS) -> DataFrame:
    """Rows of `numbered_sequences` with the first repeating sequence that covers each of them.

    Adds `sequence_id` (its start) and its `frequency`. The rows are written once, since the sequences
    are found in them and attached to them. A sequence names the few positions it covers,
    so the interval join is an equi join on (key, position), which is unique per row.
    """
    numbered = cut_lineage(numbered)
    found = numbered.where(F.col("frequency") > repeats)
    covered = found.select(
        *keys,
        F.explode(F.sequence("start_idx", F.col("start_idx") + F.col("length") - 1)).alias("_idx"),
        "start_idx",
        "frequency",
    )
    first = covered.groupBy(*keys, "_idx").agg(
        F.min("start_idx").alias("sequence_id"), F.min_by("frequency", "start_idx").alias("frequency")
    )
    rows = numbered.drop("frequency", "pattern", "length").withColumnRenamed("start_idx", "_idx")
    return rows.join(first, [*keys, "_idx"], "left").withColumnRenamed("_idx", "idx")


def enrich(rows: DataFrame) -> DataFrame:
    """Adds priority, is_anomaly and the nested insights, with defaults where a score is absent.

    Input may carry priority_score, anomaly_score, is_anomaly, sequence_id and frequency.
    """
    priority = F.coalesce("priority_score", F.lit(MISSING_PRIORITY))
    return rows.withColumns(
        {
            "priority": priority,
            "is_anomaly": F.coalesce("is_anomaly", F.lit(False)),
            "ml_insights": F.struct(
                priority.alias("priority_score"),
                F.coalesce("anomaly_score", F.lit(0.0)).alias("anomaly_score"),
                F.struct("sequence_id", "frequency").alias("pattern_info"),
            ),
        }
    )


def triage(rows: DataFrame) -> DataFrame:
    """Adds the processing priority and what it asks for."""
    urgent = ~F.col("is_anomaly") & (F.col("priority") > URGENT)
    return rows.withColumns(
        {
            "processing_priority": F.when(F.col("is_anomaly"), "critical").when(urgent, "high").otherwise("normal"),
            "requires_review": F.col("is_anomaly"),
            "requires_attention": urgent,
        }
    )


def priority_order(rows: DataFrame, position: list[str]) -> DataFrame:
    """Most urgent first: priority, anomaly, pattern frequency; ties in input order."""
    frequency = F.coalesce("frequency", F.lit(0))
    return rows.orderBy(F.desc("priority"), F.desc("is_anomaly"), frequency.desc(), *position)
