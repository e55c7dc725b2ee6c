"""Metric tables, alerting and health reports over the fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from logharbor.functions.blocks import Blocks
from logharbor.operators import alerts, metrics, reports, sketches
from logharbor.plans.fixtures import AS_OF, view, with_views
from logharbor.plans.registry import query
from logharbor.session import scratch_dir
from logharbor.specs import AlertCondition

AS_OF_SQL = f"timestamp '{AS_OF.replace('T', ' ')}'"
KEYS = ["series", "name"]


def samples(spark, sf_dir):
    return view(spark, sf_dir, "metrics")


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "latest_metrics",
    with_views("metrics", "select series, name, arg_max(value, (ts, event_id)) as value, max(ts) as ts from metrics group by 1, 2"),
)
def _(spark, sf_dir):
    return metrics.latest_metrics(samples(spark, sf_dir), KEYS, "event_id")


@query(
    "latest_metrics_ties",
    with_views(
        "metrics",
        "select series, name, arg_max(value, (date_trunc('day', ts), event_id)) as value, max(date_trunc('day', ts)) as ts from metrics group by 1, 2",
    ),
)
def _(spark, sf_dir):
    """Many samples of one time: the largest event id decides."""
    daily = samples(spark, sf_dir).withColumn("ts", F.date_trunc("day", "ts"))
    return metrics.latest_metrics(daily, KEYS, "event_id")


@query(
    "pipeline_lag",
    with_views(
        "metrics",
        f"""select round(greatest((epoch_us({AS_OF_SQL}) - epoch_us(max(ts))) / 1000000.0::double, 0), 3) as lag_seconds
from metrics where name = 'purchase'""",
    ),
)
def _(spark, sf_dir):
    lag = metrics.pipeline_lag(samples(spark, sf_dir), AS_OF, "purchase")
    return lag.withColumn("lag_seconds", F.round("lag_seconds", 3))


# counters: the value of a series at each sample, which falls whenever the counter restarts
GAINS = """gains as (
  select *, case when value < prev then value when prev is null then 0 else value - prev end as gain
  from (select *, lag(value) over (partition by series, name order by ts, event_id) as prev from metrics) t)"""


def _increase_sql(seconds: int) -> str:
    return f"""sum(gain) over (partition by series, name order by epoch_us(ts)
    range between {seconds * 1_000_000 - 1} preceding and current row)"""


@query(
    "counter_increase",
    with_views(
        "metrics",
        f"with {GAINS} select event_id, series, name, ts, value, round({_increase_sql(900)}, 6) as increase from gains",
    ),
)
def _(spark, sf_dir):
    return rounded(metrics.counter_increase(samples(spark, sf_dir), KEYS, "event_id", 900), "increase")


@query(
    "counter_rate",
    with_views(
        "metrics",
        f"with {GAINS} select event_id, series, name, ts, round({_increase_sql(18000)} / 18000.0::double, 6) as rate from gains",
    ),
)
def _(spark, sf_dir):
    rates = metrics.counter_rate(samples(spark, sf_dir), KEYS, "event_id", 18000)
    return rounded(rates, "rate").drop("value", "increase")


@query(
    "counter_delta",
    with_views(
        "metrics",
        """
select event_id, series, name, round(value - coalesce(prev, 0), 6) as delta
from (select *, lag(value) over (partition by series, name order by ts, event_id) as prev from metrics) t
where value - coalesce(prev, 0) > 0""",
    ),
)
def _(spark, sf_dir):
    deltas = metrics.counter_delta(samples(spark, sf_dir), KEYS, "event_id")
    return rounded(deltas, "delta").select("event_id", "series", "name", "delta")


_BOUNDS = (5.0, 10.0, 20.0, 50.0, 100.0, 250.0)


def _buckets_sql() -> str:
    parts = [
        f"select name, time_bucket(interval '1 day', ts) as ts, {b}::double as le, count(*) filter (value <= {b}) as c from metrics group by 1, 2"
        for b in _BOUNDS
    ]
    parts.append("select name, time_bucket(interval '1 day', ts), 'infinity'::double, count(*) from metrics group by 1, 2")
    return "\n  union all ".join(parts)


@query(
    "histogram_quantile",
    with_views(
        "metrics",
        f"""with buckets as ({_buckets_sql()}),
steps as (select *, lag(le, 1, 0.0) over w as low, lag(c, 1, 0) over w as base, max(c) over (partition by name, ts) * 0.95::double as rank
  from buckets window w as (partition by name, ts order by le)),
hit as (select *, row_number() over (partition by name, ts order by le) as n from steps where c >= rank)
select name, ts, round(case when isinf(le) then {_BOUNDS[-1]} else low + (le - low) * (rank - base) / (c - base) end, 6) as quantile
from hit where n = 1""",
    ),
)
def _(spark, sf_dir):
    daily = samples(spark, sf_dir).withColumn("ts", F.date_trunc("day", "ts"))
    buckets = metrics.bucket_counts(daily, ["series", "name", "ts"], _BOUNDS)
    return rounded(metrics.histogram_quantile(buckets, ["name", "ts"], 0.95), "quantile")


@query(
    "component_metrics",
    with_views(
        "failures",
        """
with batches as (select component, records as cnt, records / 10.0::double as duration, records * 2 as size,
    case when status_code is not null or component = 'signup' then error_type end as error_type from failures),
typed as (select component, error_type, count(*) as n from batches where error_type is not null group by 1, 2),
totals as (select component, cast(sum(cnt) as bigint) as processed_count, count(error_type) as error_count,
  sum(duration) as duration, sum(size) as size, count(*) as batches from batches group by 1)
select component, processed_count, error_count,
  (select string_agg(concat(t.error_type, '=', cast(t.n as varchar)), ',' order by t.error_type) from typed t where t.component = totals.component) as error_types,
  round(coalesce(duration / nullif(processed_count, 0), 0), 6) as avg_processing_time, round(size::double / batches, 6) as avg_batch_size,
  round(error_count::double / processed_count, 6) as error_rate,
  case when error_count::double / processed_count < 0.05 then 'healthy' else 'degraded' end as status from totals""",
    ),
)
def _(spark, sf_dir):
    failed = F.col("status_code").isNotNull() | (F.col("component") == "signup")
    batches = view(spark, sf_dir, "failures").select(
        "component",
        F.col("records").alias("count"),
        (F.col("records") / F.lit(10.0)).alias("duration"),
        (F.col("records") * 2).alias("batch_size"),
        F.when(failed, F.col("error_type")).alias("error_type"),
    )
    report = metrics.component_metrics(batches)
    pairs = F.transform(F.array_sort(F.map_entries("error_types")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    shown = F.when(F.size("error_types") > 0, F.array_join(pairs, ","))
    return rounded(report.drop("processing_time"), "avg_processing_time", "avg_batch_size", "error_rate").withColumn("error_types", shown)


@query(
    "component_state",
    with_views(
        "applog",
        """
select component, count(*) as processed_count, count(*) filter (level = 'ERROR') as error_count,
  round(count(*) filter (level = 'ERROR')::double / count(*), 6) as error_rate
from applog where ts >= timestamp '2024-01-10 00:00:00' and ts < timestamp '2024-01-20 00:00:00' group by 1""",
    ),
)
def _(spark, sf_dir):
    """Metrics of ten days from hourly states that were written and read again."""
    one = F.lit(1).cast("bigint")
    batches = view(spark, sf_dir, "applog").select(
        "component", one.alias("count"), F.lit(0.0).alias("duration"), one.alias("batch_size"),
        F.when(F.col("level") == "ERROR", F.col("type")).alias("error_type"), F.date_trunc("hour", "ts").alias("slot"),
    )
    path = scratch_dir(spark, "component_state")
    metrics.component_state(batches, ["slot"]).write.parquet(path)
    state = spark.read.parquet(path).where("slot >= timestamp '2024-01-10 00:00:00' and slot < timestamp '2024-01-20 00:00:00'")
    return rounded(metrics.metrics_of_state(state).select("component", "processed_count", "error_count", "error_rate"), "error_rate")


@query(
    "quantile_state",
    with_views("metrics", "select name, q, count(*) as samples, true as close from metrics, (select unnest([0.5::double, 0.95::double, 0.99::double]) as q) t group by 1, 2"),
)
def _(spark, sf_dir):
    """Quantiles from hourly sketches that were written and read again: their true ranks are within a hundredth."""
    path, ranks = scratch_dir(spark, "quantile_state"), {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    rows = samples(spark, sf_dir)
    sketches.quantile_state(rows, KEYS).write.parquet(path)
    found = sketches.quantiles(spark.read.parquet(path), ["name"], ranks)
    asked = F.array(*[F.struct(F.lit(q).alias("q"), F.col(c).alias("estimate")) for c, q in ranks.items()])
    asked = found.select("name", "samples", F.inline(asked))
    below = rows.join(F.broadcast(asked), "name").groupBy("name", "q", "samples").agg(
        F.count_if(F.col("value") < F.col("estimate")).alias("under"), F.count_if(F.col("value") <= F.col("estimate")).alias("upto")
    )
    close = (F.col("under") <= (F.col("q") + 0.01) * F.col("samples")) & (F.col("upto") >= (F.col("q") - 0.01) * F.col("samples"))
    return below.select("name", "q", "samples", close.alias("close"))


@query(
    "component_health",
    with_views(
        "applog",
        """
select component, round(count(*) filter (level = 'ERROR')::double / count(*), 6) as error_rate,
  case when count(*) filter (level = 'ERROR')::double / count(*) < 0.05 then 'healthy' else 'degraded' end as status
from applog group by 1""",
    ),
)
def _(spark, sf_dir):
    logs = view(spark, sf_dir, "applog")
    one = F.lit(1).cast("bigint")
    batches = logs.select(
        "component", one.alias("count"), F.lit(0.0).alias("duration"), one.alias("batch_size"),
        F.when(F.col("level") == "ERROR", F.col("type")).alias("error_type"),
    )
    return rounded(metrics.component_metrics(batches).select("component", "error_rate", "status"), "error_rate")


@query(
    "error_tracking",
    with_views("failures", "select component, count(*) as error_count, max(ts) as last_error from failures group by 1"),
)
def _(spark, sf_dir):
    return metrics.error_tracking(view(spark, sf_dir, "failures"))


@query(
    "metric_rollup",
    with_views(
        "metrics",
        """select series, name, count(*) as samples, round(sum(value), 6) as total, min(value) as lowest, max(value) as highest
from metrics group by 1, 2""",
    ),
)
def _(spark, sf_dir):
    return rounded(metrics.metric_rollup(samples(spark, sf_dir), KEYS), "total")


@query(
    "dashboard_snapshot",
    with_views(
        "metrics",
        """
select 'health' as part, series as item, arg_max(case when value <= 100 then 1.0 else 0.0 end, (ts, event_id))::double as value, max(ts) as ts from metrics group by series
union all select 'metric', name, arg_max(value, (ts, event_id)), max(ts) from metrics group by name
union all select * from (select 'alert', name, value, ts from metrics where value > 100 order by ts desc, event_id desc limit 1000) t""",
    ),
)
def _(spark, sf_dir):
    rows = samples(spark, sf_dir)
    health = rows.select("event_id", "ts", F.col("series").alias("component"), (F.col("value") <= 100).alias("healthy"))
    return metrics.dashboard_snapshot(health, rows, rows.where(F.col("value") > 100), "event_id")


# ---- alerts --------------------------------------------------------------------------------------

CONDITIONS = [
    AlertCondition("high_view", "view", 40.0, "gt", 3600, "critical"),
    AlertCondition("low_click", "click", 60.0, "lte", 20000, "warning"),
    AlertCondition("odd_error", "error", 30.0, "gte", 0, "info"),
    AlertCondition("view_low", "view", 20.0, "lt", 7200, "warning"),
    AlertCondition("exact_signup", "signup", 12.31, "eq", 0, "info"),
]

_OPS = {"gt": "value > {0}", "lt": "value < {0}", "gte": "value >= {0}", "lte": "value <= {0}", "eq": "abs(value - {0}) < 0.001"}

JUDGED_SQL = "judged as (\n  {})".format(
    "\n  union all ".join(
        f"select '{c.name}' as alert, '{c.severity}' as severity, {c.duration} as duration, series, name, ts, event_id, value, "
        f"{_OPS[c.operator].format(f'{c.threshold}::double')} as holds from metrics where name = '{c.metric_name}'"
        for c in CONDITIONS
    )
)

EPISODES_SQL = f"""{JUDGED_SQL},
marked as (select *, coalesce(lag(holds) over w, false) as held from judged window w as (partition by alert, series order by ts, event_id)),
runs as (select *, max(case when holds and not held then ts end) over (partition by alert, series order by ts, event_id) as started_at from marked),
episodes as (
  select alert, series, severity, started_at, min(ts) filter (holds and epoch_us(ts) - epoch_us(started_at) >= duration * 1000000::bigint) as fired_at,
    arg_min(value, ts) filter (holds and epoch_us(ts) - epoch_us(started_at) >= duration * 1000000::bigint) as value,
    min(ts) filter (not holds) as resolved_at
  from runs where holds or held group by 1, 2, 3, 4 having fired_at is not null)"""


def episodes(spark, sf_dir):
    judged = alerts.apply_conditions(samples(spark, sf_dir), CONDITIONS)
    return alerts.alert_episodes(judged, ["series"], "event_id")


@query("alert_episodes", with_views("metrics", f"with {EPISODES_SQL} select * from episodes"))
def _(spark, sf_dir):
    return episodes(spark, sf_dir)


@query(
    "threshold_alerts",
    with_views(
        "metrics",
        """
select event_id, series, name, ts, value, 'pipeline_lag' as alert, 'high' as severity, 30.0::double as threshold from metrics where name = 'view' and value > 30
union all select event_id, series, name, ts, value, 'error_rate', 'high', 0.05 from metrics where name = 'error' and value > 0.05""",
    ),
)
def _(spark, sf_dir):
    limits = [
        AlertCondition("pipeline_lag", "view", 30.0, severity="high"),
        AlertCondition("error_rate", "error", 0.05, severity="high"),
    ]
    return alerts.threshold_alerts(samples(spark, sf_dir), limits)


RULES_SQL = """
points as (
  select 'error_rate_high' as alert, 'critical' as severity, 7200 as duration, series, bin as ts, total / 3600.0::double > 0.01 as holds, round(total / 3600.0::double, 6) as value
  from (select series, time_bucket(interval '1 hour', ts) as bin, sum(gain) as total from gains where name = 'error' group by 1, 2) t
  union all
  select 'dropped_burst', 'warning', 3600, series, bin, total > 20, round(total, 6)
  from (select series, time_bucket(interval '1 hour', ts) as bin, sum(gain) as total from gains where name = 'view' group by 1, 2) t),
marked as (select *, coalesce(lag(holds) over w, false) as held from points window w as (partition by alert, series order by ts)),
runs as (select *, max(case when holds and not held then ts end) over (partition by alert, series order by ts) as started_at from marked)
select alert, series, severity, started_at, min(ts) filter (holds and epoch_us(ts) - epoch_us(started_at) >= duration * 1000000::bigint) as fired_at,
  arg_min(value, ts) filter (holds and epoch_us(ts) - epoch_us(started_at) >= duration * 1000000::bigint) as value, min(ts) filter (not holds) as resolved_at
from runs where holds or held group by 1, 2, 3, 4 having fired_at is not null"""


@query("alert_rules", with_views("metrics", f"with {GAINS}, {RULES_SQL.strip()}"))
def _(spark, sf_dir):
    gained = metrics.sample_gains(samples(spark, sf_dir), KEYS, "event_id")
    rules = [
        alerts.CounterRule("error_rate_high", "error", "rate", 0.01, "1 hour", 7200, "critical"),
        alerts.CounterRule("dropped_burst", "view", "increase", 20.0, "1 hour", 3600, "warning"),
    ]
    return alerts.counter_rule_episodes(gained, rules, ["series"]).withColumn("value", F.round("value", 6))


# the shipped rules, on the counters and gauges that they name
_SHIPPED = {"error": "failed_records_total", "click": "processing_errors_total", "view": "dropped_logs_total", "purchase": "processing_latency_seconds", "signup": "pipeline_lag_seconds"}
_NAMED_SQL = "named as (select * replace (case name {} end as name) from metrics)".format(" ".join(f"when '{k}' then '{v}'" for k, v in _SHIPPED.items()))
_RUNS_SQL = """marked as (select *, coalesce(lag(holds) over w, false) as held from points window w as (partition by alert, series order by ts, value)),
runs as (select *, max(case when holds and not held then ts end) over (partition by alert, series order by ts, value) as started_at from marked)
select alert, series, severity, started_at, min(ts) filter (holds and epoch_us(ts) - epoch_us(started_at) >= duration * 1000000::bigint) as fired_at,
  min(ts) filter (not holds) as resolved_at
from runs where holds or held group by 1, 2, 3, 4 having fired_at is not null"""


def _sliding_sql(gains: str, keys: str, seconds: int) -> str:
    """Totals of the gains in (t - seconds, t] at every full minute t."""
    return f"""(select {keys}, make_timestamp(look * 60000000) as ts, sum(gain) as total from
    (select *, unnest(range(cast(ceil(epoch_us(ts) / 60000000.0::double) as bigint), cast(ceil((epoch_us(ts) + {seconds * 1000000}) / 60000000.0::double) as bigint))) as look from {gains}) t
    group by {keys}, look)"""


def _shipped_sql() -> str:
    parts = []
    for r in alerts.COUNTER_RULES:
        seconds = {"5 minutes": 300, "15 minutes": 900}[r.step]
        value = f"total / {float(seconds)}::double" if r.kind == "rate" else "total"
        rows = f"(select * from gains where name = '{r.metric_name}')"
        parts.append(
            f"select '{r.name}' as alert, '{r.severity}' as severity, {r.duration} as duration, series, ts, {value} as value, {value} > {r.threshold}::double as holds from {_sliding_sql(rows, 'series', seconds)} p"
        )
    gauges = [
        f"select '{c.name}', '{c.severity}', {c.duration}, series, ts, value, {_OPS[c.operator].format(f'{c.threshold}::double')} from named where name = '{c.metric_name}'"
        for c in alerts.GAUGE_RULES
    ]
    return f"{_NAMED_SQL}, {GAINS.replace('from metrics', 'from named')}, points as ({' union all '.join(parts + gauges)}), {_RUNS_SQL}"


@query("shipped_alert_rules", with_views("metrics", f"with {_shipped_sql()}"))
def _(spark, sf_dir):
    """Every shipped rule on counters and gauges, the counters over ranges that slide by a minute."""
    renamed = F.create_map(*[F.lit(x) for pair in _SHIPPED.items() for x in pair])[F.col("name")]
    named = samples(spark, sf_dir).withColumn("name", renamed)
    gained = metrics.sample_gains(named, KEYS, "event_id")
    on_counters = alerts.sliding_rule_episodes(gained, list(alerts.COUNTER_RULES), ["series"])
    judged = alerts.apply_conditions(named, list(alerts.GAUGE_RULES))
    on_gauges = alerts.alert_episodes(judged, ["series"], "value")
    columns = ["alert", "series", "severity", "started_at", "fired_at", "resolved_at"]
    return on_counters.select(*columns).unionByName(on_gauges.select(*columns))


_LATENCY_BOUNDS = (60.0, 120.0, 180.0, 240.0, float("inf"))


@query(
    "quantile_alert_rule",
    with_views(
        "metrics",
        f"""with seen as (select *, row_number() over (partition by series order by ts, event_id) as nth from metrics),
bounds as (select unnest([60.0::double, 120.0::double, 180.0::double, 240.0::double, 'inf'::double]) as le),
gains as (select le, ts, case when nth > 1 and value * 3 <= le then 1.0::double else 0.0::double end as gain from seen, bounds),
grown as {_sliding_sql("gains", "le", 300)},
ranked as (select ts, le, total, 0.95::double * max(total) over (partition by ts) as rank from grown),
hits as (select ts, rank, min(le) filter (total >= rank) as le, arg_min(total, le) filter (total >= rank) as total,
    coalesce(max(le) filter (total < rank), 0) as low, coalesce(max(total) filter (total < rank), 0) as base from ranked group by ts, rank),
points as (select 'LatencyP95High' as alert, 'warning' as severity, 600 as duration, '' as series, ts,
    case when rank <= 0 then null when le = 'inf'::double then 240.0::double else low + (le - low) * coalesce((rank - base) / nullif(total - base, 0), 0) end as value from hits),
judged as (select * replace (coalesce(value > 180, false) as holds) from (select *, false as holds from points)),
{_RUNS_SQL.replace("from points window", "from judged window").replace("alert, series, severity,", "alert, severity,").replace("group by 1, 2, 3, 4", "group by 1, 2, 3")}""",
    ),
)
def _(spark, sf_dir):
    """The 95th percentile of a histogram whose bucket counters grow with every sample."""
    latency = samples(spark, sf_dir).select("event_id", "series", "ts", (F.col("value") * 3).alias("value"))
    blocks = Blocks(latency, ["series"], ["ts", "event_id"])
    within = {f"b{k}": F.count_if(F.col("value") <= b) for k, b in enumerate(_LATENCY_BOUNDS)}
    before = {f"before{k}": F.coalesce(F.sum(f"b{k}").over(blocks.earlier), F.lit(0)) for k in range(len(within))}
    counted = blocks.carried(blocks.df, within, before)
    values = [(c.over(blocks.running) + F.col(f"before{k}")).cast("double").alias("value") for k, c in enumerate(within.values())]
    rows = F.array(*[F.struct(F.lit(b).alias("le"), v) for b, v in zip(_LATENCY_BOUNDS, values)])
    counters = counted.select("event_id", "series", "ts", rows.alias("b")).select("event_id", "series", "ts", F.inline("b"))
    counters = counters.withColumn("name", F.lit(alerts.QUANTILE_RULE.metric_name))
    gained = metrics.sample_gains(counters, ["series", "name", "le"], "event_id")
    return alerts.quantile_rule_episodes(gained, alerts.QUANTILE_RULE).drop("value")


@query(
    "alert_notifications",
    with_views(
        "metrics",
        f"""with recursive {EPISODES_SQL},
ticks as (select alert, severity, time_bucket(interval '5 minutes', fired_at) as tick, count(*) as alerts from episodes group by 1, 2, 3),
chain as (
  select alert, severity, min(tick) as tick from ticks group by 1, 2
  union all
  select c.alert, c.severity, (select min(t.tick) from ticks t where t.alert = c.alert and t.severity = c.severity and t.tick >= c.tick + interval '2 hours')
  from chain c where c.tick is not null)
select c.alert, c.severity, c.tick as notified_at, t.alerts from chain c join ticks t using (alert, severity, tick)""",
    ),
)
def _(spark, sf_dir):
    fired = episodes(spark, sf_dir).select("alert", "severity", F.col("fired_at").alias("ts"))
    return alerts.alert_notifications(fired, ["alert", "severity"])


@query(
    "failure_streaks",
    with_views(
        "calls",
        """
with numbered as (select *, row_number() over (partition by component order by ts, event_id) as call_no from calls),
islands as (select *, coalesce(max(case when failed = 0 then call_no end) over (partition by component order by ts, event_id), 0) as last_good from numbered)
select component, count(*) as failures, min(ts) as first_failure, min(ts) filter (call_no - last_good >= 5 and call_no >= 10) as opened_at
from islands where failed = 1 group by component, last_good having opened_at is not null""",
    ),
)
def _(spark, sf_dir):
    return alerts.failure_streaks(view(spark, sf_dir, "calls"), "component", "event_id")


# ---- batch failure reports -----------------------------------------------------------------------

CATEGORY_SQL = """case when error_type = 'HttpResponseError' then concat('azure_error:', coalesce(cast(status_code as varchar), 'unknown'))
  when lower(error_type) like '%timeout%' or lower(message) like '%timeout%' then 'network_timeout'
  when lower(error_type) like '%connection%' then 'network_connection'
  when lower(error_type) like '%validation%' then 'validation_error' else concat('unknown_error:', error_type) end"""


@query(
    "error_categories",
    with_views("failures", f"select event_id, {CATEGORY_SQL} as error_category from failures"),
)
def _(spark, sf_dir):
    return reports.categorise(view(spark, sf_dir, "failures")).select("event_id", "error_category")


ADVICE_SQL = """case when category like 'azure_error%' then concat('Azure API errors (', split_part(category, ':', 2), '): ', cast(failed_batches as varchar),
    ' occurrences. Check Azure Sentinel service health and DCR endpoint configuration.')
  when category like '%network%' then concat('Network issues (', category, '): ', cast(failed_batches as varchar), ' occurrences. Check network connectivity and firewall rules.')
  when category = 'validation_error' then concat('Validation errors: ', cast(failed_batches as varchar),
    ' occurrences. Check log schema compatibility with Sentinel table definitions.') end"""

def _outcomes(spark, sf_dir):
    """Batches that failed: those with a status code or a timeout message; the others passed."""
    failures = view(spark, sf_dir, "failures")
    failed = F.col("status_code").isNotNull() | F.col("message").contains("timeout") | (F.col("component") == "click")
    return failures.withColumn("failed", failed)


FAILED_SQL = f"""batches as (select *, status_code is not null or message like '%timeout%' or component = 'click' as failed from failures),
counts as (select {CATEGORY_SQL} as category, count(*) as failed_batches, cast(sum(records) as bigint) as failed_records
  from batches where failed group by 1),
every as (select count(*) as n from batches)"""


@query(
    "failed_batch_report",
    with_views(
        "failures",
        f"""with {FAILED_SQL}
select category as error_category, failed_batches, failed_records, cast(sum(failed_batches) over () as bigint) as total_failed_batches,
  (select n from every) as total_batches, round(sum(failed_batches) over () * 100.0::double / (select n from every), 2) as failure_rate_percent,
  {ADVICE_SQL} as recommendation from counts""",
    ),
)
def _(spark, sf_dir):
    return reports.failed_batch_report(_outcomes(spark, sf_dir))


@query(
    "top_failure_reasons",
    with_views(
        "failures",
        f"with {FAILED_SQL} select category as error_category, failed_batches from counts order by failed_batches desc, category limit 3",
    ),
)
def _(spark, sf_dir):
    return reports.top_failure_reasons(_outcomes(spark, sf_dir))


@query(
    "health_verdict",
    with_views(
        "failures",
        """
with t as (select component, count(*) as n, count(*) filter (status_code is not null) as failed,
    count(*) filter (message like '%timeout%') as dropped from failures group by 1)
select component, round(failed * 100.0::double / n, 2) as failure_rate_percent, round(dropped * 100.0::double / n, 2) as drop_rate_percent,
  case when component = 'signup' then 'degraded' when round(failed * 100.0::double / n, 2) > 5 then 'degraded'
    when round(dropped * 100.0::double / n, 2) > 10 then 'degraded' when failed > 0 then 'degraded' else 'healthy' end as status from t""",
    ),
)
def _(spark, sf_dir):
    totals = view(spark, sf_dir, "failures").groupBy("component").agg(
        F.count("*").alias("batches"),
        F.count("status_code").alias("failed_batches"),
        F.count("*").alias("rows"),
        F.count_if(F.col("message").contains("timeout")).alias("dropped_rows"),
        F.count("status_code").alias("failed_records"),
    )
    verdict = reports.health_verdict(totals.withColumn("breaker_open", F.col("component") == "signup"))
    return verdict.select("component", "failure_rate_percent", "drop_rate_percent", "status")
