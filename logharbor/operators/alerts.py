"""Alert conditions over metric samples: episodes, stateless checks, notifications and streaks."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logharbor.functions.blocks import AT, Blocks, same_key
from logharbor.functions.timestamps import bin_time, width_seconds
from logharbor.operators.metrics import histogram_quantile
from logharbor.session import cut_lineage
from logharbor.specs import AlertCondition

# Equality tolerance, streak limits and notification intervals.
EQUAL_WITHIN = 0.001
FAILURES_TO_OPEN = 5
CALLS_TO_OPEN = 10
GROUP_INTERVAL = "5 minutes"
REPEAT_INTERVAL = "2 hours"


def holds(value: Column, operator: str, threshold: float) -> Column:
    limit = F.lit(float(threshold))
    tests = {
        "gt": value > limit,
        "lt": value < limit,
        "gte": value >= limit,
        "lte": value <= limit,
        "eq": F.abs(value - limit) < EQUAL_WITHIN,
    }
    return tests.get(operator, F.lit(False))


def apply_conditions(samples: DataFrame, conditions: list[AlertCondition], name: str = "name") -> DataFrame:
    """Samples repeated for each condition on their metric, with `holds` and the condition's fields."""
    arms = [
        F.when(
            F.col(name) == c.metric_name,
            F.struct(
                F.lit(c.name).alias("alert"),
                F.lit(c.severity).alias("severity"),
                F.lit(float(c.threshold)).alias("threshold"),
                F.lit(int(c.duration)).alias("duration"),
                F.coalesce(holds(F.col("value"), c.operator, c.threshold), F.lit(False)).alias("holds"),
            ),
        )
        for c in conditions
    ]
    matched = F.filter(F.array(*arms), lambda a: a.isNotNull())
    return samples.select("*", F.explode(matched).alias("_c")).select(*samples.columns, "_c.*")


def alert_episodes(judged: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """Fired episodes: when the condition began to hold, fired, and was resolved.

    Input rows carry `alert`, `severity`, `duration` and `holds`; each (alert, keys) is one timeline.
    A run of true samples fires at its first sample at least `duration` seconds after its start, and
    resolves at the next false sample. Only the start of the run needs the order: a slice hands on
    whether the condition held at its end and where the last run began; the episode itself is a
    grouped minimum.
    """
    line, order = ["alert", *keys], ["ts", tie]
    blocks = Blocks(judged, line, order)
    inside = F.lag("holds").over(blocks.window)
    df = blocks.df.withColumns({"_inside": inside, "_first": F.row_number().over(blocks.window) == 1})
    began = F.col("holds") & ~F.col("_inside")
    place = F.struct(*order)
    summary = {
        "_head": F.min_by(F.struct("ts", "holds"), place),
        "_tail": F.max_by("holds", place),
        "_began": F.max(F.when(began, F.col("ts"))),
    }
    before = F.coalesce(F.last("_tail").over(blocks.earlier), F.lit(False))
    # where the last run of a slice began: inside, or at its first sample if nothing held before that
    opens = F.when(F.col("_head.holds") & ~F.col("_before"), F.col("_head.ts"))
    sums = df.groupBy(AT).agg(*[c.alias(name) for name, c in summary.items()]).withColumn("_before", before)
    sums = sums.withColumn("_opened", F.coalesce("_began", opens))
    edges = sums.select(AT, "_before", F.last("_opened", ignorenulls=True).over(blocks.earlier).alias("_open_before"))
    df = df.join(edges, AT)
    held = F.when(F.col("_first"), F.col("_before")).otherwise(F.coalesce("_inside", F.lit(False)))
    opening = F.when(F.col("holds") & ~held, F.col("ts"))
    start = F.coalesce(F.last(opening, ignorenulls=True).over(blocks.running), F.col("_open_before"))
    df = df.withColumn("started_at", start).where(F.col("holds") | held)
    age = F.unix_micros("ts") - F.unix_micros("started_at")
    fires = F.when(F.col("holds") & (age >= F.col("duration").cast("bigint") * F.lit(1_000_000)), F.col("ts"))
    return (
        df.groupBy(*line, "severity", "started_at")
        .agg(
            F.min(fires).alias("fired_at"),
            F.min_by("value", fires).alias("value"),
            F.min(F.when(~F.col("holds"), F.col("ts"))).alias("resolved_at"),
        )
        .where(F.col("fired_at").isNotNull())
    )


def last_per_check(samples: DataFrame, keys: list[str], tie: str, check: str) -> DataFrame:
    """The last sample of each series and interval, for jobs that look at a metric once per interval."""
    newest = F.max_by(F.struct(*samples.columns), F.struct("ts", tie))
    return samples.groupBy(*keys, F.window("ts", check).alias("_w")).agg(newest.alias("_s")).select("_s.*")


def threshold_alerts(samples: DataFrame, conditions: list[AlertCondition], name: str = "name") -> DataFrame:
    """Every sample above its limit is an alert row."""
    judged = apply_conditions(samples, conditions, name)
    return judged.where(F.col("value") > F.col("threshold")).drop("holds", "duration")


def alert_notifications(
    alerts: DataFrame,
    group: list[str],
    interval: str = GROUP_INTERVAL,
    repeat: str = REPEAT_INTERVAL,
) -> DataFrame:
    """When each alert group notifies: at its first alert, then no sooner than `repeat` after.

    Groups are looked at once per `interval`, so alerts are first reduced to one row per group and
    interval. Each such tick points to the first one that is at least `repeat` later, and the ticks that
    notify are those reached from the first one: each round follows the pointers of all that are reached
    and then doubles the pointers, so the rounds grow with the logarithm of a group's notifications, and
    no task holds the history of a group.
    """
    tick = bin_time(F.col("ts"), interval).alias("tick")
    ticks = cut_lineage(alerts.groupBy(*group, tick).agg(F.count("*").alias("alerts")))
    step = cut_lineage(_next_ticks(ticks, group, width_seconds(repeat)))
    reached = ticks.groupBy(*group).agg(F.min("tick").alias("tick"))
    while True:
        same = same_key("r", "s", group) & (F.col("r.tick") == F.col("s.tick"))
        more = reached.alias("r").join(step.alias("s"), same).select(*[f"s.{c}" for c in group], F.col("s.following").alias("tick"))
        more = cut_lineage(more)
        if more.isEmpty():
            break
        reached = reached.unionByName(more)
        same = same_key("r", "s", group) & (F.col("r.following") == F.col("s.tick"))
        step = cut_lineage(step.alias("r").join(step.alias("s"), same).select(*[f"r.{c}" for c in group], "r.tick", "s.following"))
    same = same_key("t", "r", group) & (F.col("t.tick") == F.col("r.tick"))
    found = ticks.alias("t").join(reached.alias("r"), same, "left_semi")
    return found.select(*group, F.col("tick").alias("notified_at"), "alerts")


def _next_ticks(ticks: DataFrame, group: list[str], gap: float) -> DataFrame:
    """Each tick with the `following` one of its group that is at least `gap` seconds later, if there is one.

    Ticks are sorted backwards in time together with places `gap` after each; what stands last before
    such a place is the least tick so far.
    """
    us = F.unix_micros("tick")
    here = F.struct((-us).alias("_back"), F.lit(0).alias("_look"), F.col("tick").alias("_seen"))
    look = F.struct((-us - int(gap * 1_000_000)).alias("_back"), F.lit(1).alias("_look"), F.lit(None).cast("timestamp").alias("_seen"))
    both = ticks.select(*group, "tick", F.inline(F.array(here, look)))
    blocks = Blocks(both, group, ["_back", "_look"])
    df = blocks.carried(blocks.df, {"_least": F.min("_seen")}, {"_before": F.min("_least").over(blocks.earlier)})
    following = F.coalesce(F.min("_seen").over(blocks.running), F.col("_before"))
    df = df.withColumn("following", following).where((F.col("_look") == 1) & F.col("following").isNotNull())
    return df.select(*group, "tick", "following")


@dataclass(frozen=True)
class CounterRule:
    """`rate` or `increase` of a counter per `step` above a limit for `duration` seconds."""

    name: str
    metric_name: str
    kind: str
    threshold: float
    step: str
    duration: int
    severity: str


# The shipped rules on counters (limits, steps and holding times).
COUNTER_RULES = (
    CounterRule("ErrorRateHigh", "failed_records_total", "rate", 0.1, "5 minutes", 600, "critical"),
    CounterRule("IngestionFailures", "failed_records_total", "rate", 0.05, "5 minutes", 600, "critical"),
    CounterRule("ErrorRate", "processing_errors_total", "rate", 0.1, "5 minutes", 120, "critical"),
    CounterRule("DroppedLogsBurst", "dropped_logs_total", "increase", 200.0, "15 minutes", 300, "warning"),
    CounterRule("DroppedLogs", "dropped_logs_total", "increase", 100.0, "15 minutes", 300, "warning"),
)
# The shipped conditions on gauges.
GAUGE_RULES = (
    AlertCondition("HighProcessingLatency", "processing_latency_seconds", 300.0, "gt", 300, "warning"),
    AlertCondition("pipeline_lag", "pipeline_lag_seconds", 300.0, "gt", 300, "high"),
    AlertCondition("component_health", "component_health_status", 1.0, "lt", 300, "critical"),
)


@dataclass(frozen=True)
class QuantileRule:
    """A quantile of a histogram's growth over `step`, all series together, above a limit for `duration` seconds."""

    name: str
    metric_name: str
    quantile: float
    threshold: float
    step: str
    duration: int
    severity: str


# The shipped rule on a histogram.
QUANTILE_RULE = QuantileRule("LatencyP95High", "processing_latency_seconds_bucket", 0.95, 180.0, "5 minutes", 600, "warning")


def sliding_totals(gains: DataFrame, keys: list[str], step: str, every: str) -> DataFrame:
    """Growth over the last `step` at every look, once per `every`; looks without a gain in reach have no row.

    A gain counts at the looks t with t - step < ts <= t. Gains are first summed up over those that count
    at the same looks, one sum per series and `every`, and only the sums are repeated for their
    step / every looks; no window over a series is needed.
    """
    width, pace = int(width_seconds(step) * 1_000_000), int(width_seconds(every) * 1_000_000)
    us = F.unix_micros("ts")
    first = F.ceil(us / F.lit(pace)).cast("bigint")
    last = F.ceil((us + width) / F.lit(pace)).cast("bigint") - 1
    sums = gains.select(*keys, "gain", first.alias("_first"), last.alias("_last")).where("_first <= _last")
    sums = sums.groupBy(*keys, "_first", "_last").agg(F.sum("gain").alias("gain"))
    spread = sums.select(*keys, "gain", F.explode(F.sequence("_first", "_last")).alias("_look"))
    totals = spread.groupBy(*keys, "_look").agg(F.sum("gain").alias("total"))
    return totals.select(*keys, F.timestamp_micros(F.col("_look") * pace).alias("ts"), "total")


def sliding_rule_episodes(gains: DataFrame, rules: list[CounterRule], keys: list[str], every: str = "1 minute") -> DataFrame:
    """Episodes of rules on counters, over a range that slides: judged once per `every`, so no bin edge hides a burst."""
    judged = []
    for rule in rules:
        value = F.col("total") / F.lit(float(width_seconds(rule.step))) if rule.kind == "rate" else F.col("total")
        points = sliding_totals(gains.where(F.col("name") == rule.metric_name), keys, rule.step, every)
        judged.append(_judged_points(points.withColumn("value", value), rule, keys))
    return alert_episodes(cut_lineage(reduce(DataFrame.unionByName, judged)), keys, "value")


def quantile_rule_episodes(gains: DataFrame, rule: QuantileRule, every: str = "1 minute") -> DataFrame:
    """Episodes of a rule on a quantile; `gains` has name, le, ts and gain of cumulative bucket counters."""
    grown = sliding_totals(gains.where(F.col("name") == rule.metric_name), ["le"], rule.step, every)
    points = histogram_quantile(grown.withColumnRenamed("total", "count"), ["ts"], rule.quantile)
    return alert_episodes(cut_lineage(_judged_points(points.withColumnRenamed("quantile", "value"), rule, [])), [], "value")


def _judged_points(points: DataFrame, rule: CounterRule | QuantileRule, keys: list[str]) -> DataFrame:
    return points.select(
        F.lit(rule.name).alias("alert"),
        F.lit(rule.severity).alias("severity"),
        F.lit(rule.duration).alias("duration"),
        *keys,
        "ts",
        "value",
        F.coalesce(F.col("value") > F.lit(float(rule.threshold)), F.lit(False)).alias("holds"),
    )


def counter_rule_episodes(gains: DataFrame, rules: list[CounterRule], keys: list[str]) -> DataFrame:
    """Episodes of rules on counters, judged once per step; `gains` has name, ts and gain.

    Each rule reduces its counter to one value per series and step before the timeline is ordered.
    """
    judged = []
    for rule in rules:
        total = F.sum("gain")
        value = total / F.lit(float(width_seconds(rule.step))) if rule.kind == "rate" else total
        rows = gains.where(F.col("name") == rule.metric_name)
        points = rows.groupBy(*keys, bin_time(F.col("ts"), rule.step).alias("ts")).agg(value.alias("value"))
        judged.append(_judged_points(points, rule, keys))
    return alert_episodes(cut_lineage(reduce(DataFrame.unionByName, judged)), keys, "value")


def failure_streaks(
    calls: DataFrame,
    key: str,
    tie: str,
    min_failures: int = FAILURES_TO_OPEN,
    min_calls: int = CALLS_TO_OPEN,
) -> DataFrame:
    """Runs of failures long enough to open: length, first failure, and the call that opened.

    A run opens at its first call that is at least the `min_failures`-th failure in a row and the
    `min_calls`-th call of its key.
    """
    blocks = Blocks(calls, [key], ["ts", tie])
    df = blocks.df.withColumn("_nth", F.row_number().over(blocks.window))
    good = F.when(F.col("failed") == 0, F.col("_nth"))
    sums = df.groupBy(AT).agg(F.count(F.lit(1)).alias("_n"), F.max(good).alias("_good"))
    sums = sums.withColumn("_calls", F.coalesce(F.sum("_n").over(blocks.earlier), F.lit(0)))
    last_good = F.max(F.col("_calls") + F.col("_good")).over(blocks.earlier)
    df = df.join(sums.select(AT, "_calls", last_good.alias("_good_before")), AT)
    df = df.withColumn("_call", F.col("_nth") + F.col("_calls"))
    good = F.when(F.col("failed") == 0, F.col("_call"))
    since_good = F.coalesce(F.max(good).over(blocks.running), F.col("_good_before"), F.lit(0))
    runs = df.withColumn("_after", since_good).where(F.col("failed") == 1)
    nth = F.col("_call") - F.col("_after")
    opens = (nth >= min_failures) & (F.col("_call") >= min_calls)
    return (
        runs.groupBy(key, "_after")
        .agg(
            F.count("*").alias("failures"),
            F.min("ts").alias("first_failure"),
            F.min(F.when(opens, F.col("ts"))).alias("opened_at"),
        )
        .where(F.col("opened_at").isNotNull())
        .drop("_after")
    )
