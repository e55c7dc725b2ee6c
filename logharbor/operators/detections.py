"""Detections and log reports as declarative aggregations.

Every aggregation combines map-side, distinct counts are planned as a two-level aggregation, and
sets are built from rows already reduced to their distinct members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logharbor.functions.blocks import same_key
from logharbor.functions.sums import megabytes, wide_sum
from logharbor.functions.timestamps import bin_time, since

# Watched ports, blocking actions, thresholds and severities.
REMOTE_ACCESS_PORTS = (22, 3389, 23, 5900)
TRANSFER_PORTS = (443, 80, 21, 22)
BLOCKING = ("deny", "drop")
OUTBOUND_BYTES = 100_000_000
HIGH_VOLUME_DENIES = 100


def _distinct(column: str, approx: bool) -> Column:
    return F.approx_count_distinct(column) if approx else F.count_distinct(column)


def detect_bruteforce(
    fw: DataFrame, as_of, lookback: str = "24 hours", min_attempts: int = 3, approx: bool = False
) -> DataFrame:
    """Sources with repeated blocked attempts on remote-access ports."""
    attempts = F.col("AttemptCount")
    return (
        fw.where(since(F.col("TimeGenerated"), as_of, lookback))
        .where(F.col("Action").isin(*BLOCKING) & F.col("DestinationPort").isin(*REMOTE_ACCESS_PORTS))
        .groupBy("SourceIP")
        .agg(
            F.count("*").alias("AttemptCount"),
            _distinct("DestinationIP", approx).alias("TargetHosts"),
            F.min("TimeGenerated").alias("FirstSeen"),
            F.max("TimeGenerated").alias("LastSeen"),
        )
        .where(attempts >= min_attempts)
        .withColumn(
            "AlertSeverity", F.when(attempts >= 10, "High").when(attempts >= 5, "Medium").otherwise("Low")
        )
        .orderBy(F.desc("AttemptCount"), "SourceIP")
    )


def detect_exfiltration(
    fw: DataFrame,
    as_of,
    lookback: str = "24 hours",
    min_bytes: int = OUTBOUND_BYTES,
    bin_width: str = "1 hour",
) -> DataFrame:
    """Sources sending more than `min_bytes` to transfer ports within one time bin.

    Rows are first reduced to one per (source, bin, target). Targets are collected only for the sums that
    pass the limit, so an innocent source with many targets is never gathered.
    """
    per_target = (
        fw.where(since(F.col("TimeGenerated"), as_of, lookback))
        .where((F.lower("Action") == "allow") & F.col("DestinationPort").isin(*TRANSFER_PORTS))
        .groupBy("SourceIP", bin_time(F.col("TimeGenerated"), bin_width).alias("TimeGenerated"), "DestinationIP")
        .agg(wide_sum(F.col("BytesTransferred")).alias("bytes"), F.count("*").alias("rows"))
    )
    keys = ["TimeGenerated", "SourceIP"]
    totals = per_target.groupBy(*keys).agg(F.sum("bytes").alias("total"), F.sum("rows").alias("TransferCount"))
    totals = totals.where(F.col("total") > F.lit(min_bytes))
    named = per_target.alias("d").join(totals.alias("e"), same_key("d", "e", keys))
    named = named.select(*[f"d.{c}" for c in keys], "DestinationIP", "total", "TransferCount")
    found = named.groupBy(*keys, "total", "TransferCount").agg(F.array_sort(F.collect_list("DestinationIP")).alias("DestinationIPs"))
    return found.select(*keys, megabytes(F.col("total")).alias("TotalMB"), "TransferCount", "DestinationIPs").orderBy(F.desc("TotalMB"), "TimeGenerated", "SourceIP")


def block_summary(fw: DataFrame, as_of, lookback: str = "24 hours", approx: bool = False) -> DataFrame:
    """Blocked traffic per rule: events, distinct sources, ports aimed at.

    Ports are reduced to one row per (rule, port) apart from the sources, so that no set is carried
    through the distinct count; a rule has at most 65536 ports.
    """
    rows = fw.where(since(F.col("TimeGenerated"), as_of, lookback) & F.col("Action").isin(*BLOCKING))
    counts = rows.groupBy("RuleName").agg(F.count("*").alias("BlockCount"), _distinct("SourceIP", approx).alias("UniqueSourceIPs"))
    ports = rows.groupBy("RuleName", "DestinationPort").agg(F.lit(1).alias("_one"))
    ports = ports.groupBy("RuleName").agg(F.array_sort(F.collect_list("DestinationPort")).alias("TopTargetPorts"))
    joined = counts.alias("d").join(ports.alias("e"), same_key("d", "e", ["RuleName"]))
    return joined.select("d.RuleName", "BlockCount", "UniqueSourceIPs", "TopTargetPorts").orderBy(F.desc("BlockCount"), "RuleName")


def detect_high_volume_denies(
    fw: DataFrame,
    as_of,
    lookback: str = "1 hour",
    min_events: int = HIGH_VOLUME_DENIES,
    every: str | None = None,
) -> DataFrame:
    """Source/target pairs with many blocked events; with `every`, judged per time bin."""
    rows = fw.where(since(F.col("TimeGenerated"), as_of, lookback) & F.lower("Action").isin(*BLOCKING))
    keys = ["SourceIP", "DestinationIP"]
    if every:
        rows = rows.withColumn("WindowStart", bin_time(F.col("TimeGenerated"), every))
        keys = ["WindowStart", *keys]
    return (
        rows.groupBy(*keys)
        .agg(
            F.min("TimeGenerated").alias("FirstSeen"),
            F.max("TimeGenerated").alias("LastSeen"),
            F.count("*").alias("DeniedEvents"),
        )
        .where(F.col("DeniedEvents") >= min_events)
    )


def union_tables(tables: dict[str, DataFrame | None], origin: str = "TableName") -> DataFrame:
    """Union that tolerates absent tables and columns and tags each row with its table."""
    present = [df.withColumn(origin, F.lit(name)) for name, df in tables.items() if df is not None]
    if not present:
        raise ValueError("none of the tables exists")
    out = present[0]
    for df in present[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def existing_tables(spark: SparkSession, names: list[str]) -> dict[str, DataFrame | None]:
    return {n: spark.table(n) if spark.catalog.tableExists(n) else None for n in names}


def ingest_volume(
    tables: dict[str, DataFrame | None], as_of, lookback: str = "24 hours", bin_width: str = "1 hour"
) -> DataFrame:
    """Events by table and time bin over whichever tables exist."""
    return (
        union_tables(tables)
        .where(since(F.col("TimeGenerated"), as_of, lookback))
        .groupBy("TableName", bin_time(F.col("TimeGenerated"), bin_width).alias("TimeGenerated"))
        .agg(F.count("*").alias("Events"))
        .orderBy("TimeGenerated", "TableName")
    )


def top_denied(fw: DataFrame, as_of, lookback: str = "24 hours", n: int = 20) -> DataFrame:
    """The sources with most blocked events."""
    return (
        fw.where(since(F.col("TimeGenerated"), as_of, lookback) & F.lower("Action").isin(*BLOCKING))
        .groupBy("SourceIP")
        .agg(F.count("*").alias("DeniedEvents"))
        .orderBy(F.desc("DeniedEvents"), "SourceIP")
        .limit(n)
    )


def vpn_totals(vpn: DataFrame) -> DataFrame:
    """Sessions, bytes and mean duration over all rows, with MB and hours."""
    totals = vpn.agg(
        F.count("*").alias("TotalSessions"),
        wide_sum(F.col("BytesIn")).alias("in_bytes"),
        wide_sum(F.col("BytesOut")).alias("out_bytes"),
        F.avg("ConnectionDuration").alias("AvgDuration"),
    )
    return totals.select(
        "TotalSessions",
        F.col("in_bytes").try_cast("bigint").alias("TotalBytesIn"),
        F.col("out_bytes").try_cast("bigint").alias("TotalBytesOut"),
        "AvgDuration",
        megabytes(F.col("in_bytes")).alias("TotalInMB"),
        megabytes(F.col("out_bytes")).alias("TotalOutMB"),
        F.round(F.col("AvgDuration") / F.lit(3600.0), 2).alias("AvgDurationHours"),
    )


def errors_by_component(
    logs: DataFrame, as_of, lookback: str = "1 hour", bin_width: str = "5 minutes", level: str = "ERROR"
) -> DataFrame:
    """Error rows per component and time bin."""
    return (
        logs.where(since(F.col("ts"), as_of, lookback) & (F.upper("level") == level.upper()))
        .groupBy("component", bin_time(F.col("ts"), bin_width).alias("ts"))
        .agg(F.count("*").alias("error_count"))
    )


def mean_metrics(
    samples: DataFrame, as_of, columns: dict[str, str], lookback: str = "1 hour", bin_width: str = "5 minutes"
) -> DataFrame:
    """Mean of the given columns per time bin; `columns` maps output to input names."""
    return (
        samples.where(since(F.col("ts"), as_of, lookback))
        .groupBy(bin_time(F.col("ts"), bin_width).alias("ts"))
        .agg(*[F.avg(source).alias(name) for name, source in columns.items()])
    )


def hourly_events(
    table: DataFrame, as_of, lookback: str = "24 hours", bin_width: str = "1 hour", time: str = "TimeGenerated"
) -> DataFrame:
    """Rows per time bin of one table."""
    return (
        table.where(since(F.col(time), as_of, lookback))
        .groupBy(bin_time(F.col(time), bin_width).alias(time))
        .agg(F.count("*").alias("events"))
    )


def recent_rows(
    table: DataFrame,
    as_of,
    columns: list[str],
    lookback: str = "1 hour",
    time: str = "ts",
    condition: Column | None = None,
    n: int | None = None,
    tie: str | None = None,
) -> DataFrame:
    """Recent rows, newest first, of equal times the largest `tie` first; `n` makes it a top-n listing."""
    rows = table.where(since(F.col(time), as_of, lookback))
    if condition is not None:
        rows = rows.where(condition)
    listing = rows.orderBy(F.desc(time), *([F.desc(tie)] if tie else [])).select(*columns)
    return listing.limit(n) if n is not None else listing
