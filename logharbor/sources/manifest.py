"""Which objects to read, and what came of each of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logharbor.functions.timestamps import as_timestamp

# Extensions that hold logs and name parts of unfinished uploads.
LOG_EXTENSIONS = (".log", ".json", ".gz", ".csv", ".txt")
UNFINISHED_PARTS = ("temp", "partial", "incomplete", "_tmp")


def is_log_key(
    key: Column,
    extensions: Sequence[str] = LOG_EXTENSIONS,
    excluded: Sequence[str] = UNFINISHED_PARTS,
) -> Column:
    name = F.lower(key)
    wanted, unwanted = F.lit(False), F.lit(False)
    for extension in extensions:
        wanted = wanted | name.endswith(extension.lower())
    for part in excluded:
        unwanted = unwanted | name.contains(part.lower())
    return wanted & ~unwanted


def select_objects(
    listing: DataFrame,
    prefix: str = "",
    newer_than=None,
    limit: int | None = None,
    extensions: Sequence[str] = LOG_EXTENSIONS,
    excluded: Sequence[str] = UNFINISHED_PARTS,
) -> DataFrame:
    """Objects to ingest from a listing with columns Key, Size and LastModified."""
    chosen = listing.where(F.col("Key").startswith(prefix)) if prefix else listing
    chosen = chosen.where((F.col("Size") > 0) & is_log_key(F.col("Key"), extensions, excluded))
    if newer_than is not None:
        chosen = chosen.where(F.col("LastModified") > as_timestamp(newer_than))
    return chosen if limit is None else chosen.orderBy("Key").limit(limit)


def list_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Listing of a folder; only file metadata is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(
        F.col("path").alias("Key"),
        F.col("length").alias("Size"),
        F.col("modificationTime").alias("LastModified"),
    )


def clocked(rows: DataFrame, name: str = "read_ms") -> DataFrame:
    """Adds when each row was worked on, in milliseconds of the executor's clock; put right after the read."""
    return rows.withColumn(name, F.reflect(F.lit("java.lang.System"), F.lit("currentTimeMillis")).cast("bigint"))


def file_outcomes(tagged: DataFrame, clock: str = "read_ms") -> DataFrame:
    """Per object: rows, bad rows, bytes and whether every row was usable.

    `tagged` has path, size and reason; hot files combine map-side before the shuffle. Rows that were
    `clocked` also give each object's `duration_seconds`, from its first row to its last over all tasks, and
    `bytes_per_second`, null where the clock did not move in between.
    """
    timed = clock in tagged.columns
    seconds = (F.max(clock) - F.min(clock)) / F.lit(1000.0) if timed else None
    per_file = tagged.groupBy("path").agg(
        F.count("*").alias("rows"),
        F.count("reason").alias("bad_rows"),
        F.max("size").alias("bytes"),
        F.min("reason").alias("first_reason"),
        *([seconds.alias("duration_seconds")] if timed else []),
    )
    if timed:
        per_file = per_file.withColumn("bytes_per_second", F.try_divide("bytes", "duration_seconds"))
    return per_file.withColumn(
        "status", F.when(F.col("bad_rows") == 0, "successful").otherwise("failed")
    )


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    """Totals over objects with the share that succeeded (0 when there are none)."""
    good = F.count_if(F.col("status") == "successful")
    total = F.count("*")
    return outcomes.agg(
        total.alias("total_files"),
        good.alias("successful_files"),
        (total - good).alias("failed_files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.try_divide(good, total), F.lit(0.0)).alias("success_rate"),
    )
