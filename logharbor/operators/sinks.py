"""Writing routed rows, keeping what could not be written, replaying it and expiring old rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logharbor.functions.blocks import running_number
from logharbor.functions.tagging import REASON
from logharbor.functions.timestamps import as_timestamp, lag_seconds
from logharbor.operators.redaction import redact_frame
from logharbor.session import cut_lineage
from logharbor.sources.manifest import list_folder
from logharbor.specs import TABLES

DLQ_KEYS = ["table_name", "error_category", "day", "batch_no"]


def write_routed(
    rows: DataFrame,
    path: str,
    spec,
    mode: str = "append",
    time: str = "TimeGenerated",
    fmt: str = "json",
    rows_per_file: int | None = None,
    rebalance: bool = False,
) -> None:
    """Accepted rows as gzip files partitioned by table and day.

    `rows_per_file` bounds the files, e.g. to the batch size of a consumer that takes one file at a
    time. `rebalance` spends a shuffle on evenly sized files: adaptive execution gathers small days and
    splits large ones.
    """
    out = rows.withColumns({"table_name": F.lit(spec.table_name), "day": F.to_date(time)})
    if rebalance:
        out = out.hint("rebalance", "day")
    writer = out.write.mode(mode).partitionBy("table_name", "day").option("compression", "gzip")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.format(fmt).save(path)


def with_batch_counts(counts: DataFrame, specs=None) -> DataFrame:
    """Adds how many batches of the table's size the processed rows make."""
    size = F.lit(None).cast("int")
    for spec in (specs or TABLES).values():
        size = F.when(F.col("table_name") == spec.table_name, F.lit(spec.batch_size)).otherwise(size)
    return counts.withColumn("batch_count", F.ceil(F.col("processed") / size).cast("bigint"))


def dead_letter_batches(
    failed: DataFrame, batch_size: int, order: list[str], identity: Column, redact: bool = True
) -> DataFrame:
    """Failed rows as batches of at most `batch_size` records.

    Input: table_name, failed_at, error, error_category and `record` (struct). Rows are numbered per
    table, category and day, so one group never holds more than a batch. The id is the md5 of the
    identities of the members in order. What is numbered is written first, so that finding out what failed
    is done once.
    """
    rows = cut_lineage(failed.withColumns({"day": F.to_date("failed_at"), "_identity": identity}))
    rows = running_number(rows, DLQ_KEYS[:3], order, "_position")
    if redact:
        rows = redact_frame(rows, columns=["record"])
    rows = rows.withColumn("batch_no", F.floor((F.col("_position") - 1) / batch_size).cast("bigint"))
    member = F.struct("_position", "_identity", "record")
    grouped = rows.groupBy(*DLQ_KEYS).agg(
        F.min("failed_at").alias("failed_at"),
        F.min("error").alias("error"),
        F.array_sort(F.collect_list(member), _by_position).alias("_members"),
    )
    return grouped.select(
        F.md5(F.array_join("_members._identity", ",")).alias("batch_id"),
        *DLQ_KEYS,
        "failed_at",
        "error",
        F.lit(0).alias("retry_count"),
        F.size("_members").cast("bigint").alias("record_count"),
        F.col("_members.record").alias("data"),
    )


def _by_position(left: Column, right: Column) -> Column:
    return (left["_position"] - right["_position"]).cast("int")


def replay(batches: DataFrame, reroute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Re-route every record; a batch is archived when all of its records pass.

    `reroute` maps the records (their fields plus batch_id) to rows tagged with `reason`.
    """
    records = batches.select("batch_id", F.explode("data").alias("record")).select("batch_id", "record.*")
    outcome = reroute(records).groupBy("batch_id").agg(
        F.count_if(F.col(REASON).isNull()).alias("replayed_records"), F.count(REASON).alias("_bad")
    )
    joined = batches.drop("data").join(outcome, "batch_id", "left")
    return joined.withColumns(
        {
            "replayed_records": F.coalesce("replayed_records", F.lit(0)),
            "archived": F.coalesce(F.col("_bad") == 0, F.lit(True)),
        }
    ).drop("_bad")


def replay_folder(
    spark: SparkSession,
    dlq: str,
    archive: str,
    routed: str,
    spec,
    reroute: Callable[[DataFrame], DataFrame],
    run: str,
) -> DataFrame:
    """Replay the dead-letter table at `dlq`: passed rows go to `routed`, passed batches to `archive`.

    Everything is written below `run=<run>`, which a repeated run overwrites, so a replay that stopped
    half-way is repeated as a whole. The failures go to `<dlq>_left/run=<run>`, which is what the next
    run reads. Each batch is re-routed once and its outcome written first. Records are only as good as
    they were kept: addresses that were redacted in a dead letter do not parse again. Returns the
    summary row.
    """
    place = f"run={run}"
    batches = spark.read.parquet(dlq)
    outcome = f"{archive}/outcome/{place}"
    replay(batches, reroute).select("batch_id", "archived").write.mode("overwrite").parquet(outcome)
    outcome = spark.read.schema("batch_id string, archived boolean").parquet(outcome)
    done = outcome.where("archived").select("batch_id")
    passed_batches = batches.join(done, "batch_id", "left_semi")
    records = passed_batches.select("batch_id", F.explode("data").alias("record")).select("batch_id", "record.*")
    passed = reroute(records).where(F.col(REASON).isNull()).drop(REASON, "batch_id")
    write_routed(passed, f"{routed}/{place}", spec, mode="overwrite")
    passed_batches.write.mode("overwrite").parquet(f"{archive}/batches/{place}")
    batches.join(done, "batch_id", "left_anti").write.mode("overwrite").parquet(f"{dlq.rstrip('/')}_left/{place}")
    return outcome.agg(
        F.count("*").alias("processed"),
        F.count_if(F.col("archived")).alias("archived"),
        F.count_if(~F.col("archived")).alias("failed"),
    )


def backlog(batches: DataFrame, as_of) -> DataFrame:
    """Number of waiting batches and the age in seconds of the oldest, 0 when there are none."""
    age = F.max(lag_seconds(F.col("failed_at"), as_of))
    return batches.agg(F.count("*").alias("batches"), F.coalesce(age, F.lit(0.0)).alias("oldest_age_seconds"))


def is_expired(time: Column, as_of, days: int) -> Column:
    return time < as_timestamp(as_of) - F.expr(f"interval {int(days)} days")


def retention_report(
    rows: DataFrame, as_of, days: int, time: str = "TimeGenerated", size: str = "size", label: str | None = None
) -> DataFrame:
    """Dry run of the age rule: rows examined, rows expired, bytes they hold."""
    old = is_expired(F.col(time), as_of, days)
    report = rows.agg(
        F.count("*").alias("examined"),
        F.count_if(old).alias("expired"),
        F.coalesce(F.sum(F.when(old, F.col(size))), F.lit(0)).alias("bytes_reclaimed"),
    )
    return report if label is None else report.select(F.lit(label).alias("table_name"), "*")


def expire_partitions(spark: SparkSession, path: str, as_of, days: int) -> list[str]:
    """Delete the day partitions of a routed table that lie wholly before the cutoff.

    The listing of the folder names the days, so no data is read. A day is deleted by overwriting its
    partition with no rows, which Spark does on any file system that it writes to, through SQL alone;
    its empty folder stays. Returns the folders of the deleted days.
    """
    cutoff = F.to_date(as_timestamp(as_of) - F.expr(f"interval {int(days)} days")).cast("string")
    place = F.regexp_extract("Key", r"^(.*/table_name=[^/]*/day=[^/]*)/[^/]*$", 1).alias("place")
    days_found = list_folder(spark, path).select(place).distinct().withColumn("day", F.substring_index("place", "day=", -1))
    old = sorted(r.place for r in days_found.where((F.col("place") != "") & (F.col("day") < cutoff)).select("place").collect())
    if old:
        name = f"expiring_{uuid.uuid4().hex}"
        quoted = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} (any STRING, table_name STRING, day STRING) USING text PARTITIONED BY (table_name, day) LOCATION '{quoted}'")
        try:
            for place in old:
                table_name, day = (part.split("=", 1)[1].replace("'", "\\'") for part in place.rsplit("/", 2)[1:])
                spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (table_name = '{table_name}', day = '{day}') SELECT 'x' WHERE false")
        finally:
            spark.sql(f"DROP TABLE {name}")
    return old
