"""Continuous ingest: files -> parsed rows -> routed table, with quarantine and dead letters."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logharbor.functions.tagging import REASON
from logharbor.operators.reports import error_category
from logharbor.operators.sinks import dead_letter_batches

Writer = Callable[[DataFrame, str], None]
STATUS = "status"


def write_batch(rows: DataFrame, path: str) -> None:
    """Parquet partitioned by status; overwriting one epoch's folder makes a repeated epoch harmless."""
    rows.write.mode("overwrite").partitionBy(STATUS).parquet(path)


@dataclass(frozen=True)
class IngestPaths:
    """Folders of one ingest job, all on storage every executor reaches."""

    routed: str
    dead_letters: str
    quarantine: str
    progress: str
    checkpoint: str

    @classmethod
    def under(cls, root: str) -> IngestPaths:
        return cls(*[f"{root}/{name}" for name in ("routed", "dead_letters", "quarantine", "progress", "checkpoint")])


def route_batch(
    tagged: DataFrame, epoch: int, paths: IngestPaths, spec, category: Callable[[Exception], Column], write: Writer
) -> None:
    """Write one micro-batch; if the write fails, keep every row of it.

    Accepted rows then become dead letters, and quarantined ones go to a folder of their own. Every
    output is a folder of the epoch that a repeated epoch overwrites, the metrics of the batch included.
    The parsed batch is kept for its uses, so it is parsed once.
    """
    status = F.when(F.col(REASON).isNull(), "accepted").otherwise("quarantined")
    kept = tagged.persist()
    began, failed = time.time(), False
    try:
        try:
            rows = kept.withColumns({"table_name": F.lit(spec.table_name), STATUS: status})
            write(rows, f"{paths.routed}/epoch={epoch}")
        except Exception as error:
            failed = True
            _keep_failed(kept, epoch, paths, spec, error, category(error))
        counts = kept.agg(F.count(F.lit(1)).alias("input_rows"), F.count(REASON).alias("quarantined_rows")).first().asDict()
    finally:
        kept.unpersist()
    counts |= {"batch_seconds": time.time() - began, "failed": float(failed)}
    samples = [(epoch, datetime.now(timezone.utc), name, float(value)) for name, value in counts.items()]
    progress = tagged.sparkSession.createDataFrame(samples, PROGRESS)
    progress.coalesce(1).write.mode("overwrite").parquet(f"{paths.progress}/epoch={epoch}")


def _keep_failed(tagged: DataFrame, epoch: int, paths: IngestPaths, spec, error: Exception, category: Column) -> None:
    record = F.struct(*[c for c in tagged.columns if c != REASON])
    failed = tagged.where(F.col(REASON).isNull()).select(
        F.lit(spec.table_name).alias("table_name"),
        F.col("ProcessingTime").alias("failed_at"),
        F.lit(str(error)).alias("error"),
        category.alias("error_category"),
        record.alias("record"),
        F.sha2(F.to_json(record), 256).alias("_id"),
    )
    batches = dead_letter_batches(failed, spec.batch_size, ["failed_at", "_id"], F.col("_id"))
    batches.write.mode("overwrite").parquet(f"{paths.dead_letters}/epoch={epoch}")
    tagged.where(F.col(REASON).isNotNull()).write.mode("overwrite").parquet(f"{paths.quarantine}/epoch={epoch}")


def default_category(error: Exception) -> Column:
    """The category that the failure reports would give this error."""
    status = F.lit(getattr(error, "status_code", None)).cast("string")
    kind = "ValueError" if isinstance(error, ValueError) else type(error).__name__
    return error_category(F.lit(kind), F.lit(str(error)), status)


def start_ingest(
    lines: DataFrame,
    parse: Callable[[DataFrame], DataFrame],
    spec,
    paths: IngestPaths,
    write: Writer = write_batch,
    category: Callable[[Exception], Column] = default_category,
    every: str | None = None,
) -> StreamingQuery:
    """Start the job; with `every` it polls on that interval, else it drains what is there and stops."""
    writer = (
        parse(lines)
        .writeStream.option("checkpointLocation", paths.checkpoint)
        .foreachBatch(lambda df, epoch: route_batch(df, epoch, paths, spec, category, write))
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def read_routed(spark: SparkSession, paths: IngestPaths, status: str = "accepted") -> DataFrame:
    rows = spark.read.parquet(paths.routed).where(F.col(STATUS) == status)
    return rows.drop(STATUS, "epoch")


PROGRESS = "batch long, ts timestamp, name string, value double"


def progress_metrics(spark: SparkSession, paths: IngestPaths) -> DataFrame:
    """Metric samples of every batch that was committed: rows, quarantined rows, seconds, whether the write failed."""
    return spark.read.schema(PROGRESS).parquet(paths.progress)
