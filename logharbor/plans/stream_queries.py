"""Streaming jobs run to completion over the given tables; results are read back as tables.

Checkpoints and outputs go to a new folder below the session's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logharbor.operators.patterns import heavy_patterns
from logharbor.plans.fixtures import AS_OF, firewall_lines, stream_view, table, with_views
from logharbor.plans.metric_queries import CONDITIONS, EPISODES_SQL
from logharbor.plans.registry import query
from logharbor.session import scratch_dir
from logharbor.sources.firewall import parse_firewall_lines
from logharbor.sources.lines import stream_lines
from logharbor.specs import FIREWALL
from logharbor.streaming import alerts, detections, ingest, patterns


def drain(df: DataFrame, root: str, mode: str = "append") -> str:
    """Run a stream until its source is empty; each epoch overwrites its own folder."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/epoch={epoch}")

    df.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint").foreachBatch(
        write
    ).trigger(availableNow=True).start().awaitTermination()
    return f"{root}/out"


def ingested(spark, sf_dir, root, write=ingest.write_batch):
    firewall_lines(spark, sf_dir).select(F.col("line").alias("value")).write.option("compression", "gzip").text(f"{root}/lines")
    lines = stream_lines(spark, f"{root}/lines").select("line")
    paths = ingest.IngestPaths.under(root)
    running = ingest.start_ingest(lines, lambda df: parse_firewall_lines(df, AS_OF), FIREWALL, paths, write)
    running.awaitTermination()
    return paths


@query(
    "stream_ingest",
    with_views(
        "fw",
        """select TimeGenerated, SourceIP, DestinationIP, lower(Action) as FirewallAction, DestinationPort, BytesTransferred,
  'Custom_Firewall_CL' as table_name from fw where event_id % 17 <> 0 and event_id % 19 <> 0""",
    ),
)
def _(spark, sf_dir):
    paths = ingested(spark, sf_dir, scratch_dir(spark, "stream_ingest"))
    return ingest.read_routed(spark, paths).select(
        "TimeGenerated", "SourceIP", "DestinationIP", "FirewallAction", "DestinationPort", "BytesTransferred", "table_name"
    )


@query(
    "stream_dead_letter",
    with_views(
        "fw",
        """select 'network_timeout' as error_category, cast(ceil(count(*) / 1000.0) as bigint) as batches, count(*) as records
from fw where event_id % 17 <> 0 and event_id % 19 <> 0""",
    ),
)
def _(spark, sf_dir):
    """A sink that times out: every accepted row ends in the dead-letter table."""

    def broken(rows, path):
        raise TimeoutError("upload timeout")

    paths = ingested(spark, sf_dir, scratch_dir(spark, "stream_dead_letter"), broken)
    return spark.read.parquet(paths.dead_letters).groupBy("error_category").agg(
        F.count("*").alias("batches"), F.sum("record_count").alias("records")
    )


@query(
    "stream_dead_letter_all",
    with_views(
        "fw",
        """select count(*) as input_rows, count(*) filter (event_id % 17 <> 0 and event_id % 19 <> 0) as dead_rows,
  count(*) filter (event_id % 17 = 0 or event_id % 19 = 0) as quarantined_rows from fw""",
    ),
)
def _(spark, sf_dir):
    """A sink that fails loses nothing: accepted rows are dead letters, quarantined ones are kept apart."""

    def broken(rows, path):
        raise OSError("no space left")

    paths = ingested(spark, sf_dir, scratch_dir(spark, "stream_dead_letter_all"), broken)
    dead = spark.read.parquet(paths.dead_letters).agg(F.sum("record_count").alias("dead_rows"))
    kept = spark.read.parquet(paths.quarantine).agg(F.count("*").alias("quarantined_rows"))
    rows = ingest.progress_metrics(spark, paths).where(F.col("name") == "input_rows").agg(F.sum("value").cast("long").alias("input_rows"))
    return rows.select("input_rows", dead.scalar().alias("dead_rows"), kept.scalar().alias("quarantined_rows"))


@query("stream_progress", "select count(*)::double as input_rows from events")
def _(spark, sf_dir):
    paths = ingested(spark, sf_dir, scratch_dir(spark, "stream_progress"))
    rows = ingest.progress_metrics(spark, paths).where(F.col("name") == "input_rows")
    return rows.agg(F.sum("value").alias("input_rows"))


@query(
    "stream_high_volume_denies",
    with_views(
        "fw",
        """
select date_trunc('hour', TimeGenerated) as WindowStart, SourceIP, DestinationIP, min(TimeGenerated) as FirstSeen,
  max(TimeGenerated) as LastSeen, count(*) as DeniedEvents
from fw where lower(Action) in ('deny','drop') group by 1, 2, 3 having count(*) >= 2
  and date_trunc('hour', min(TimeGenerated)) + interval '1 hour' <= (select max(TimeGenerated) - interval '10 minutes' from fw)""",
    ),
)
def _(spark, sf_dir):
    found = detections.high_volume_denies(stream_view(spark, sf_dir, "fw"), min_events=2)
    return spark.read.parquet(drain(found, scratch_dir(spark, "denies"))).drop("epoch")


@query(
    "stream_sliding_denies",
    with_views(
        "fw",
        """
with starts as (
  select *, unnest([time_bucket(interval '30 minutes', TimeGenerated), time_bucket(interval '30 minutes', TimeGenerated) - interval '30 minutes']) as WindowStart
  from fw where lower(Action) in ('deny','drop'))
select WindowStart, SourceIP, DestinationIP, min(TimeGenerated) as FirstSeen, max(TimeGenerated) as LastSeen, count(*) as DeniedEvents
from starts group by 1, 2, 3 having count(*) >= 2
  and WindowStart + interval '1 hour' <= (select max(TimeGenerated) - interval '10 minutes' from fw)""",
    ),
)
def _(spark, sf_dir):
    """Windows of an hour that begin every half hour."""
    found = detections.high_volume_denies(stream_view(spark, sf_dir, "fw"), min_events=2, slide="30 minutes")
    return spark.read.parquet(drain(found, scratch_dir(spark, "sliding_denies"))).drop("epoch")


@query(
    "stream_large_outbound",
    with_views(
        "fw",
        """
select date_trunc('hour', TimeGenerated) as WindowStart, SourceIP, cast(sum(BytesTransferred) as bigint) as total, count(*) as TransferCount
from fw where lower(Action) = 'allow' and DestinationPort in (443,80,21,22) group by 1, 2 having sum(BytesTransferred) > 100000000
  and date_trunc('hour', min(TimeGenerated)) + interval '1 hour' <= (select max(TimeGenerated) - interval '10 minutes' from fw)""",
    ),
)
def _(spark, sf_dir):
    found = detections.large_outbound(stream_view(spark, sf_dir, "fw"))
    rows = spark.read.parquet(drain(found, scratch_dir(spark, "outbound"))).drop("epoch")
    return rows.withColumn("total", F.col("total").cast("bigint"))


# samples that the last watermark has passed, judged in order
_WAITED_SQL = "waited as (select * from metrics where ts < (select date_trunc('millisecond', max(ts)) - interval '10 minutes' from metrics))"


def _events_sql(samples: str) -> str:
    episodes = EPISODES_SQL.replace("from metrics", f"from {samples}")
    episodes = episodes.replace("min(ts) filter (not holds) as resolved_at", "min(ts) filter (not holds) as resolved_at, arg_min(value, ts) filter (not holds) as resolved_value")
    return f"""{episodes}
select alert, series, severity, 'fired' as event, fired_at as ts, value from episodes
union all select alert, series, severity, 'resolved', resolved_at, resolved_value from episodes where resolved_at is not null"""


@query("stream_alerts", with_views("metrics", f"with {_WAITED_SQL}, {_events_sql('waited')}"))
def _(spark, sf_dir):
    events = alerts.alert_events(stream_view(spark, sf_dir, "metrics"), CONDITIONS, "event_id")
    return spark.read.parquet(drain(events, scratch_dir(spark, "alerts"))).drop("epoch")


@query(
    "alert_table",
    with_views("metrics", f"with {_WAITED_SQL}, {_events_sql('waited')}").replace(
        "\nselect alert, series, severity, 'fired'", ", rows as (select alert, series, severity, 'fired'"
    )
    + ") select alert, event, count(*) as rows from rows group by 1, 2",
)
def _(spark, sf_dir):
    """Alert rows appended per epoch to a table; every epoch is written twice, which changes nothing."""
    events = alerts.alert_events(stream_view(spark, sf_dir, "metrics"), CONDITIONS, "event_id")
    root = scratch_dir(spark, "alert_table")

    write = alerts.alert_writer(f"{root}/alerts")

    def twice(batch: DataFrame, epoch: int) -> None:
        for _ in range(2):
            write(batch, epoch)

    events.writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(twice).trigger(
        availableNow=True
    ).start().awaitTermination()
    return spark.read.parquet(f"{root}/alerts").groupBy("alert", "event").agg(F.count("*").alias("rows"))


@query(
    "stream_patterns",
    "select md5(concat(event_type, '/', cast(user_id % 5 as varchar))) as pattern, count(*) as frequency from events group by 1",
)
def _(spark, sf_dir):
    pattern = F.md5(F.concat("name", F.lit("/"), F.substring("series", 2, 1)))
    hashed = stream_view(spark, sf_dir, "metrics").withColumn("pattern", pattern)
    counts = patterns.running_pattern_counts(hashed, ttl_seconds=400 * 86_400)
    rows = spark.read.parquet(drain(counts, scratch_dir(spark, "patterns"), "update"))
    return rows.groupBy("pattern").agg(F.max("frequency").alias("frequency"))


_KIND = "case when event_type = 'error' then concat('error/', cast(user_id % 40 as string)) else event_type end"


@query(
    "stream_heavy_patterns",
    f"""with counts as (select md5({_KIND}) as pattern, count(*) as frequency from events group by 1)
select pattern, frequency, true as within from counts where frequency >= 0.01 * (select sum(frequency) from counts)""",
)
def _(spark, sf_dir):
    """Patterns of a hundredth of the stream or more, from summaries of 20 counters a task without any state."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir)
    pattern = F.md5(F.expr(_KIND)).alias("pattern")
    root = scratch_dir(spark, "heavy_patterns")
    events.select(pattern).writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(
        patterns.summary_writer(f"{root}/out", 20)
    ).trigger(availableNow=True).start().awaitTermination()
    heavy = heavy_patterns(spark.read.parquet(f"{root}/out"), share=0.01)
    counts = table(spark, sf_dir, "events").groupBy(pattern).agg(F.count("*").alias("frequency"))
    total = counts.agg(F.sum("frequency").alias("n")).select("n").scalar()
    within = F.coalesce(F.col("frequency").between(F.col("at_least"), F.col("at_most")), F.lit(False))
    return counts.where(F.col("frequency") >= 0.01 * total).join(heavy, "pattern", "left").select("pattern", "frequency", within.alias("within"))
