"""Metric tables: latest values, counter rates, quantiles, rollups and component reports.

Samples have `ts`, `value` and the columns that name a series. Ordered work runs through
`functions.blocks`, so every series is cut into slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logharbor.functions.blocks import AT, Blocks
from logharbor.functions.timestamps import lag_seconds
from logharbor.session import cut_lineage

# Histogram bounds in seconds, the healthy error rate, and the usual size of an alert list.
BUCKETS = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0)
HEALTHY_ERROR_RATE = 0.05
RECENT_ALERTS = 1000


def latest_metrics(samples: DataFrame, keys: list[str], tie: str = "value") -> DataFrame:
    """Latest value per key; of equal times the largest `tie`, so the order of the input does not matter."""
    newest = samples.groupBy(*keys).agg(F.max(F.struct("ts", F.col(tie).alias("tie"), "value")).alias("newest"))
    return newest.select(*keys, "newest.value", "newest.ts")


def pipeline_lag(samples: DataFrame, as_of, name: str, column: str = "name") -> DataFrame:
    """Seconds since the last sample of a metric, 0 when there is none."""
    newest = samples.where(F.col(column) == name).agg(F.max("ts").alias("ts"))
    return newest.select(F.coalesce(lag_seconds(F.col("ts"), as_of), F.lit(0.0)).alias("lag_seconds"))


def _gain() -> Column:
    """Growth since the sample before; a fall is a restart from zero, a first sample adds nothing."""
    fell = F.col("value") < F.col("_previous")
    return F.when(F.col("_previous").isNull(), 0.0).when(fell, F.col("value")).otherwise(
        F.col("value") - F.col("_previous")
    )


def _running_totals(samples: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """Adds `_total`, the growth of the counter from its first sample to this one, resets allowed for.

    A slice sums up its first and last value and the growth inside; the growth onto its first value and
    the total before it follow from the summaries alone.
    """
    blocks = Blocks(samples, keys, ["ts", tie])
    inside, order = F.lag("value").over(blocks.window), F.struct("ts", tie)
    df = blocks.df.withColumns({"_first": F.row_number().over(blocks.window) == 1, "_previous": inside})
    df = df.withColumn("_gain", F.coalesce(_gain(), F.lit(0.0)))
    boxed = F.struct(F.col("value").alias("v"))
    sums = df.groupBy(AT).agg(
        F.min_by(boxed, order)["v"].alias("value"), F.max_by(boxed, order).alias("_end"), F.sum("_gain").alias("_inner")
    )
    sums = sums.withColumn("_previous", F.last("_end").over(blocks.earlier)["v"])
    sums = sums.withColumn("_opening", F.coalesce(_gain(), F.lit(0.0)))
    before = F.coalesce(F.sum(F.col("_inner") + F.col("_opening")).over(blocks.earlier), F.lit(0.0))
    df = df.join(sums.select(AT, "_opening", before.alias("_before")), AT)
    gain = F.when(F.col("_first"), F.col("_opening")).otherwise(F.col("_gain"))
    total = F.col("_before") + F.sum(gain).over(blocks.running)
    return df.withColumn("_total", total).select(*samples.columns, "_total")


def counter_increase(samples: DataFrame, keys: list[str], tie: str, window_seconds: float) -> DataFrame:
    """At every sample, the growth of its counter over the window ending there, resets allowed for.

    The window is (t - w, t]; nothing is extrapolated to its edges. The growth over a window is the
    difference of two running totals: that of the sample, and the last one at or before t - w. The second
    is found by sorting every sample in twice, at t with its total and at t - w with its row, so neither
    the cost per row nor a slice grows with the window. The totals are written between the two. A sample without a time has no window, and its
    increase is null.
    """
    totals = cut_lineage(_running_totals(samples, keys, tie))
    back = F.col("ts") - F.make_dt_interval(secs=F.lit(float(window_seconds)))
    order, row = ["_time", "_mark", "_tie"], F.struct(*totals.columns)
    # samples of a time come before the looks back to it
    at = F.struct(F.col("ts").alias("_time"), F.lit(0).alias("_mark"), F.col(tie).alias("_tie"), "_total", F.when(F.lit(False), row).alias("_row"))
    look = F.struct(back.alias("_time"), F.lit(1).alias("_mark"), F.col(tie).alias("_tie"), F.lit(None).cast("double").alias("_total"), row.alias("_row"))
    blocks = Blocks(totals.select(*keys, F.inline(F.array(at, look))), keys, order)
    past = F.max_by(F.when(F.col("_mark") == 0, F.col("_total")), F.when(F.col("_mark") == 0, F.struct(*order)))
    df = blocks.carried(blocks.df, {"_past": past}, {"_carried": F.last("_past", ignorenulls=True).over(blocks.earlier)})
    here = F.coalesce(F.last("_total", ignorenulls=True).over(blocks.running), F.col("_carried"), F.lit(0.0))
    df = df.withColumn("_base", here).where("_mark = 1").select("_row.*", "_base")
    increase = F.when(F.col("ts").isNotNull(), F.col("_total") - F.col("_base"))
    return df.withColumn("increase", increase).drop("_total", "_base")


def counter_rate(samples: DataFrame, keys: list[str], tie: str, window_seconds: float) -> DataFrame:
    """Increase per second over the window."""
    grown = counter_increase(samples, keys, tie, window_seconds)
    return grown.withColumn("rate", F.col("increase") / F.lit(float(window_seconds)))


def sample_gains(samples: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """Adds `gain`, the growth of the counter since the sample before, resets allowed for."""
    stepped = Blocks(samples, keys, ["ts", tie]).previous({"_previous": "value"}).drop(AT)
    return stepped.withColumn("gain", _gain()).drop("_previous")


def counter_delta(samples: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """Growth from one snapshot to the next where it is positive; the first counts from zero."""
    stepped = Blocks(samples, keys, ["ts", tie]).previous({"_previous": "value"}).drop(AT)
    delta = F.col("value") - F.coalesce("_previous", F.lit(0.0))
    return stepped.withColumn("delta", delta).where(F.col("delta") > 0).drop("_previous")


def bucket_counts(samples: DataFrame, keys: list[str], bounds: tuple[float, ...] = BUCKETS) -> DataFrame:
    """Cumulative histogram rows (keys, le, count) from raw samples; the last bound is infinity."""
    counts = samples.groupBy(*keys).agg(
        *[F.count_if(F.col("value") <= b).alias(f"_b{i}") for i, b in enumerate(bounds)],
        F.count("value").alias("_all"),
    )
    rows = [F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("count")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit(float("inf")).alias("le"), F.col("_all").alias("count")))
    return counts.select(*keys, F.inline(F.array(*rows)))


def histogram_quantile(buckets: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Quantile from cumulative buckets, linear within the bucket that reaches it.

    Buckets of one histogram are a handful of rows, so they are folded as an array. A quantile in the
    infinite bucket is the highest finite bound.
    """
    summed = buckets.groupBy(*keys, "le").agg(F.sum("count").alias("count"))
    folded = summed.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("le", "count"))).alias("b"))
    rank = F.element_at("b", -1)["count"] * F.lit(float(q))
    hit = F.filter("b", lambda x: x["count"] >= F.col("_rank"))[0]
    below = F.filter("b", lambda x: x["count"] < F.col("_rank"))
    finite = F.filter("b", lambda x: x["le"] < F.lit(float("inf")))
    staged = folded.withColumn("_rank", rank)
    staged = staged.select(
        *keys,
        "_rank",
        hit.alias("_hit"),
        F.try_element_at(below, F.lit(-1)).alias("_below"),
        F.element_at(finite, -1)["le"].alias("_top"),
    )
    low = F.coalesce(F.col("_below.le"), F.lit(0.0))
    base = F.coalesce(F.col("_below.count"), F.lit(0))
    share = F.try_divide(F.col("_rank") - base, F.col("_hit.count") - base)
    inside = low + (F.col("_hit.le") - low) * F.coalesce(share, F.lit(0.0))
    value = F.when(F.col("_rank") <= 0, F.lit(None)).when(
        F.col("_hit.le") == float("inf"), F.col("_top")
    )
    return staged.select(*keys, value.otherwise(inside).alias("quantile"))


def component_state(batches: DataFrame, slots: list[str] | None = None) -> DataFrame:
    """Sums per component and error type (and time slot), from which the metrics follow; states of any slots add up.

    Input rows are batches with component, count, duration, batch_size and error_type (null = none).
    """
    return batches.groupBy("component", "error_type", *(slots or [])).agg(
        F.sum("count").alias("count"),
        F.sum("duration").alias("duration"),
        F.sum("batch_size").alias("size"),
        F.count("batch_size").alias("batches"),
        F.count("error_type").alias("errors"),
    )


def component_metrics(batches: DataFrame) -> DataFrame:
    """Per component: rows, errors, errors by type, mean times and sizes, error rate, health."""
    return metrics_of_state(component_state(batches))


def metrics_of_state(state: DataFrame) -> DataFrame:
    """The metrics of `component_metrics` from states; error types are counted first, so the map is built from few rows."""
    by_type = state.groupBy("component", "error_type").agg(*[F.sum(c).alias(c) for c in ("count", "duration", "size", "batches", "errors")])
    pair = F.when(F.col("error_type").isNotNull(), F.struct("error_type", "errors"))
    total = by_type.groupBy("component").agg(
        F.sum("count").alias("processed_count"),
        F.sum("errors").alias("error_count"),
        F.map_from_entries(F.array_sort(F.collect_list(pair))).alias("error_types"),
        F.sum("duration").alias("processing_time"),
        F.sum("size").alias("_size"),
        F.sum("batches").alias("_batches"),
    )
    zero = F.lit(0.0)
    rate = F.coalesce(F.try_divide("error_count", "processed_count"), zero)
    return total.select(
        "component",
        "processed_count",
        "error_count",
        "error_types",
        F.coalesce(F.try_divide("processing_time", "processed_count"), zero).alias("avg_processing_time"),
        F.coalesce(F.try_divide("_size", "_batches"), zero).alias("avg_batch_size"),
        rate.alias("error_rate"),
        F.when(rate < HEALTHY_ERROR_RATE, "healthy").otherwise("degraded").alias("status"),
    )


def error_tracking(errors: DataFrame, context: str = "component") -> DataFrame:
    """Errors and the time of the last one per context."""
    return errors.groupBy(context).agg(F.count("*").alias("error_count"), F.max("ts").alias("last_error"))


def metric_rollup(samples: DataFrame, labels: list[str]) -> DataFrame:
    """Counter, size and time summaries per label set."""
    return samples.groupBy(*labels).agg(
        F.count("*").alias("samples"),
        F.sum("value").alias("total"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
    )


def dashboard_snapshot(
    health: DataFrame, samples: DataFrame, alerts: DataFrame, tie: str, recent_alerts: int = RECENT_ALERTS
) -> DataFrame:
    """One listing of the latest health per component, latest metrics and the `recent_alerts` newest alerts."""
    place = F.struct("ts", F.col(tie).alias("tie"), "healthy")
    newest_health = health.groupBy("component").agg(F.max(place).alias("newest")).select("component", "newest.healthy", "newest.ts")
    newest = latest_metrics(samples, ["name"], tie)
    recent = alerts.orderBy(F.desc("ts"), F.desc(tie)).limit(recent_alerts)
    parts = [
        newest_health.select(F.lit("health").alias("part"), F.col("component").alias("item"), F.col("healthy").cast("double").alias("value"), "ts"),
        newest.select(F.lit("metric").alias("part"), F.col("name").alias("item"), "value", "ts"),
        recent.select(F.lit("alert").alias("part"), F.col("name").alias("item"), "value", "ts"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
