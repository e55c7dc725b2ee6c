"""Detections and log reports over the fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from logharbor.operators import detections as det
from logharbor.operators import sketches
from logharbor.plans.fixtures import AS_OF, WHOLE_RANGE, view, with_views
from logharbor.plans.registry import query
from logharbor.session import scratch_dir


@query(
    "detect_bruteforce",
    with_views(
        "fw",
        """
select SourceIP, count(*) as AttemptCount, count(distinct DestinationIP) as TargetHosts,
  min(TimeGenerated) as FirstSeen, max(TimeGenerated) as LastSeen,
  case when count(*) >= 10 then 'High' when count(*) >= 5 then 'Medium' else 'Low' end as AlertSeverity
from fw where Action in ('deny','drop') and DestinationPort in (22,3389,23,5900)
group by SourceIP having count(*) >= 3""",
    ),
)
def _(spark, sf_dir):
    return det.detect_bruteforce(view(spark, sf_dir, "fw"), AS_OF, WHOLE_RANGE)


@query(
    "detect_bruteforce_week",
    with_views(
        "fw",
        """
select SourceIP, count(*) as AttemptCount, count(distinct DestinationIP) as TargetHosts,
  min(TimeGenerated) as FirstSeen, max(TimeGenerated) as LastSeen,
  case when count(*) >= 10 then 'High' when count(*) >= 5 then 'Medium' else 'Low' end as AlertSeverity
from fw where Action in ('deny','drop') and DestinationPort in (22,3389,23,5900)
  and TimeGenerated >= timestamp '2024-01-24 00:00:00'
group by SourceIP having count(*) >= 3""",
    ),
)
def _(spark, sf_dir):
    return det.detect_bruteforce(view(spark, sf_dir, "fw"), AS_OF, "7 days")


@query(
    "detect_exfiltration",
    with_views(
        "fw",
        """
select date_trunc('hour', TimeGenerated) as TimeGenerated, SourceIP,
  round(cast(sum(BytesTransferred) as double) / 1048576.0::double, 2) as TotalMB, count(*) as TransferCount,
  list_sort(list(distinct DestinationIP)) as DestinationIPs
from fw where lower(Action) = 'allow' and DestinationPort in (443,80,21,22)
group by 1, 2 having sum(BytesTransferred) > 100000000""",
    ),
)
def _(spark, sf_dir):
    return det.detect_exfiltration(view(spark, sf_dir, "fw"), AS_OF, WHOLE_RANGE)


@query(
    "block_summary_state",
    with_views("fw", "select RuleName, count(*) as BlockCount, true as close from fw where Action in ('deny','drop') group by RuleName"),
)
def _(spark, sf_dir):
    """Blocked traffic per rule over the whole range, from hourly states alone; the estimates are checked."""
    path, fw = scratch_dir(spark, "block_summary_state"), view(spark, sf_dir, "fw")
    sketches.distinct_state(fw.where(F.col("Action").isin(*det.BLOCKING)), ["RuleName"], ["SourceIP"]).write.parquet(path)
    found = sketches.distinct_counts(spark.read.parquet(path), ["RuleName"], ["SourceIP"])
    exact = det.block_summary(fw, AS_OF, WHOLE_RANGE).select("RuleName", "UniqueSourceIPs")
    close = sketches.close_to(F.col("SourceIP"), F.col("UniqueSourceIPs"))
    return found.alias("f").join(exact.alias("e"), F.col("f.RuleName").eqNullSafe(F.col("e.RuleName"))).select(
        "f.RuleName", F.col("rows").alias("BlockCount"), close.alias("close")
    )


@query(
    "detect_bruteforce_state",
    with_views(
        "fw",
        """
select SourceIP, count(*) as AttemptCount, count(distinct DestinationIP) as TargetHosts,
  min(TimeGenerated) as FirstSeen, max(TimeGenerated) as LastSeen
from fw where Action in ('deny','drop') and DestinationPort in (22,3389,23,5900) and TimeGenerated >= timestamp '2024-01-05 00:00:00'
group by SourceIP having count(*) >= 3""",
    ),
)
def _(spark, sf_dir):
    """Repeated attempts from daily states. So few hosts per source are counted without error by the sketches."""
    path = scratch_dir(spark, "detect_bruteforce_state")
    rows = view(spark, sf_dir, "fw").where(F.col("Action").isin(*det.BLOCKING) & F.col("DestinationPort").isin(*det.REMOTE_ACCESS_PORTS))
    sketches.distinct_state(rows, ["SourceIP"], ["DestinationIP"], every="1 day").write.parquet(path)
    found = sketches.distinct_counts(spark.read.parquet(path), ["SourceIP"], ["DestinationIP"], since="2024-01-05T00:00:00")
    return found.where("rows >= 3").select(
        "SourceIP", F.col("rows").alias("AttemptCount"), F.col("DestinationIP").alias("TargetHosts"),
        F.col("first_seen").alias("FirstSeen"), F.col("last_seen").alias("LastSeen"),
    )


@query(
    "block_summary",
    with_views(
        "fw",
        """
select RuleName, count(*) as BlockCount, count(distinct SourceIP) as UniqueSourceIPs,
  list_sort(list(distinct DestinationPort)) as TopTargetPorts
from fw where Action in ('deny','drop') group by RuleName""",
    ),
)
def _(spark, sf_dir):
    return det.block_summary(view(spark, sf_dir, "fw"), AS_OF, WHOLE_RANGE)


@query(
    "detect_high_volume_denies",
    with_views(
        "fw",
        """
select date_trunc('hour', TimeGenerated) as WindowStart, SourceIP, DestinationIP,
  min(TimeGenerated) as FirstSeen, max(TimeGenerated) as LastSeen, count(*) as DeniedEvents
from fw where lower(Action) in ('deny','drop') group by 1, 2, 3 having count(*) >= 2""",
    ),
)
def _(spark, sf_dir):
    return det.detect_high_volume_denies(
        view(spark, sf_dir, "fw"), AS_OF, WHOLE_RANGE, min_events=2, every="1 hour"
    )


@query(
    "ingest_volume",
    with_views(
        "fw vpn",
        """
select TableName, date_trunc('hour', TimeGenerated) as TimeGenerated, count(*) as Events
from (select 'Custom_Firewall_CL' as TableName, TimeGenerated from fw
      union all select 'Custom_VPN_CL', TimeGenerated from vpn) t group by 1, 2""",
    ),
)
def _(spark, sf_dir):
    tables = {
        "Custom_Firewall_CL": view(spark, sf_dir, "fw"),
        "Custom_VPN_CL": view(spark, sf_dir, "vpn"),
        "Custom_Missing_CL": None,
    }
    return det.ingest_volume(tables, AS_OF, WHOLE_RANGE)


@query(
    "top_denied",
    with_views(
        "fw",
        """
select SourceIP, count(*) as DeniedEvents from fw where lower(Action) in ('deny','drop')
group by SourceIP order by DeniedEvents desc, SourceIP limit 20""",
    ),
)
def _(spark, sf_dir):
    return det.top_denied(view(spark, sf_dir, "fw"), AS_OF, WHOLE_RANGE)


@query(
    "vpn_totals",
    with_views(
        "vpn",
        """
select count(*) as TotalSessions, cast(sum(BytesIn) as bigint) as TotalBytesIn,
  cast(sum(BytesOut) as bigint) as TotalBytesOut, round(avg(ConnectionDuration), 6) as AvgDuration,
  round(cast(sum(BytesIn) as double) / 1048576.0::double, 2) as TotalInMB,
  round(cast(sum(BytesOut) as double) / 1048576.0::double, 2) as TotalOutMB,
  round(avg(ConnectionDuration) / 3600.0::double, 2) as AvgDurationHours
from vpn""",
    ),
)
def _(spark, sf_dir):
    return det.vpn_totals(view(spark, sf_dir, "vpn")).withColumn("AvgDuration", F.round("AvgDuration", 6))


@query(
    "errors_by_component",
    with_views(
        "applog",
        """
select component, time_bucket(interval '5 minutes', ts) as ts, count(*) as error_count
from applog where level = 'ERROR' group by 1, 2""",
    ),
)
def _(spark, sf_dir):
    return det.errors_by_component(view(spark, sf_dir, "applog"), AS_OF, WHOLE_RANGE)


@query(
    "model_metrics",
    with_views(
        "metrics",
        """
select time_bucket(interval '5 minutes', ts) as ts,
  round(avg(case when name = 'view' then value end), 6) as AvgAccuracy,
  round(avg(case when name = 'click' then value end), 6) as AvgLatency
from metrics group by 1""",
    ),
)
def _(spark, sf_dir):
    samples = view(spark, sf_dir, "metrics").select(
        "ts",
        F.when(F.col("name") == "view", F.col("value")).alias("ModelAccuracy"),
        F.when(F.col("name") == "click", F.col("value")).alias("PredictionLatency"),
    )
    means = det.mean_metrics(
        samples, AS_OF, {"AvgAccuracy": "ModelAccuracy", "AvgLatency": "PredictionLatency"}, WHOLE_RANGE
    )
    return means.select("ts", *[F.round(c, 6).alias(c) for c in ("AvgAccuracy", "AvgLatency")])


@query(
    "hourly_events",
    with_views(
        "fw",
        "select date_trunc('hour', TimeGenerated) as TimeGenerated, count(*) as events from fw group by 1",
    ),
)
def _(spark, sf_dir):
    return det.hourly_events(view(spark, sf_dir, "fw"), AS_OF, WHOLE_RANGE)


@query(
    "recent_errors",
    with_views(
        "applog",
        """
select event_id, ts, message from applog where level = 'ERROR'
  and ts >= timestamp '2024-01-30 00:00:00'""",
    ),
)
def _(spark, sf_dir):
    return det.recent_rows(
        view(spark, sf_dir, "applog"),
        AS_OF,
        ["event_id", "ts", "message"],
        "24 hours",
        condition=F.col("level") == "ERROR",
    )


@query(
    "recent_records",
    with_views(
        "fw",
        """
select TimeGenerated, SourceIP, DestinationIP, Action, Protocol, BytesTransferred
from fw order by TimeGenerated desc, event_id desc limit 10""",
    ),
)
def _(spark, sf_dir):
    columns = ["TimeGenerated", "SourceIP", "DestinationIP", "Action", "Protocol", "BytesTransferred"]
    return det.recent_rows(view(spark, sf_dir, "fw"), AS_OF, columns, WHOLE_RANGE, "TimeGenerated", n=10, tie="event_id")
