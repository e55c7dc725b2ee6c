"""Reading raw log objects as rows; gzip is decoded by the file source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_COLUMNS = ("path", "size", "modified")


def _file_columns() -> list:
    meta = F.col("_metadata")
    return [
        meta["file_path"].alias("path"),
        meta["file_size"].alias("size"),
        meta["file_modification_time"].alias("modified"),
    ]


def file_options(glob: str | None, newer_than: str | None) -> dict[str, str]:
    options = {"recursiveFileLookup": "true"}
    if glob:
        options["pathGlobFilter"] = glob
    if newer_than:
        options["modifiedAfter"] = newer_than
    return options


def read_lines(
    spark: SparkSession, folder: str, glob: str | None = None, newer_than: str | None = None
) -> DataFrame:
    """One row per line: `line` and the file it came from. Bad bytes become U+FFFD."""
    raw = spark.read.options(**file_options(glob, newer_than)).text(folder)
    return raw.select(F.make_valid_utf8("value").alias("line"), *_file_columns())


def read_objects(
    spark: SparkSession, folder: str, glob: str | None = None, newer_than: str | None = None
) -> DataFrame:
    """One row per object with its whole text, for formats that span lines."""
    raw = spark.read.options(**file_options(glob, newer_than)).text(folder, wholetext=True)
    return raw.select(F.make_valid_utf8("value").alias("content"), *_file_columns())


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int = 10) -> DataFrame:
    """The same rows as `read_lines`, discovered file by file; the checkpoint keeps each file once."""
    raw = (
        spark.readStream.option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(folder)
    )
    return raw.select(F.make_valid_utf8("value").alias("line"), *_file_columns())
