"""Detections over event-time windows of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logharbor.functions.sums import wide_sum
from logharbor.operators.detections import BLOCKING, HIGH_VOLUME_DENIES, OUTBOUND_BYTES, TRANSFER_PORTS


def _window(width: str, slide: str | None):
    return F.window("TimeGenerated", width, slide) if slide else F.window("TimeGenerated", width)


def high_volume_denies(
    fw: DataFrame,
    min_events: int = HIGH_VOLUME_DENIES,
    width: str = "1 hour",
    slide: str | None = None,
    late: str = "10 minutes",
) -> DataFrame:
    """Source/target pairs with many blocked events per window; the watermark bounds the state."""
    return (
        fw.withWatermark("TimeGenerated", late)
        .where(F.lower("Action").isin(*BLOCKING))
        .groupBy(_window(width, slide).alias("w"), "SourceIP", "DestinationIP")
        .agg(
            F.min("TimeGenerated").alias("FirstSeen"),
            F.max("TimeGenerated").alias("LastSeen"),
            F.count("*").alias("DeniedEvents"),
        )
        .where(F.col("DeniedEvents") >= min_events)
        .select(F.col("w.start").alias("WindowStart"), "SourceIP", "DestinationIP", "FirstSeen", "LastSeen", "DeniedEvents")
    )


def large_outbound(
    fw: DataFrame, min_bytes: int = OUTBOUND_BYTES, width: str = "1 hour", slide: str | None = None, late: str = "10 minutes"
) -> DataFrame:
    """Bytes per source and target in each window, for the sums over `min_bytes` of a source.

    The state holds one row per (window, source, target); targets are listed by the batch detection.
    """
    return (
        fw.withWatermark("TimeGenerated", late)
        .where((F.lower("Action") == "allow") & F.col("DestinationPort").isin(*TRANSFER_PORTS))
        .groupBy(_window(width, slide).alias("w"), "SourceIP")
        .agg(wide_sum(F.col("BytesTransferred")).alias("total"), F.count("*").alias("TransferCount"))
        .where(F.col("total") > F.lit(min_bytes))
        .select(F.col("w.start").alias("WindowStart"), "SourceIP", "total", "TransferCount")
    )
