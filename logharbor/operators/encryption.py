"""Column encryption with AES-GCM and re-encryption under a new key."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts of a versioned table; a rotation that stopped goes on with the parts that are not done.
PARTS = 16


def encrypt_columns(df: DataFrame, columns: list[str], key: Column, context: Column | None = None) -> DataFrame:
    """Replace text columns by base64 ciphertext; `context` is authenticated, not encrypted."""
    extra = [F.lit("GCM"), F.lit("DEFAULT"), F.lit("").cast("binary")]
    tail = [*extra, context] if context is not None else [F.lit("GCM")]
    return df.withColumns(
        {c: F.base64(F.aes_encrypt(F.col(c).cast("binary"), key, *tail)) for c in columns}
    )


def decrypt_columns(df: DataFrame, columns: list[str], key: Column, context: Column | None = None) -> DataFrame:
    """The inverse; text that does not decrypt becomes null."""
    tail = [F.lit("GCM"), F.lit("DEFAULT"), *([context] if context is not None else [])]
    return df.withColumns(
        {c: F.try_aes_decrypt(F.unbase64(F.col(c)), key, *tail).cast("string") for c in columns}
    )


def rotate_columns(
    df: DataFrame, columns: list[str], old_key: Column, new_key: Column, context: Column | None = None
) -> DataFrame:
    """Ciphertext under the old key to ciphertext under the new one, in one pass."""
    return encrypt_columns(decrypt_columns(df, columns, old_key, context), columns, new_key, context)


def rotate_table(spark, source: str, target: str, columns: list[str], old_key: Column, new_key: Column) -> None:
    """Write a re-encrypted copy of a table; the source is left for the caller to retire."""
    rotated = rotate_columns(spark.read.parquet(source), columns, old_key, new_key)
    rotated.write.mode("errorifexists").parquet(target)


def create_versioned(df: DataFrame, root: str, columns: list[str], key: Column, row_key: list[str], version: int = 1, parts: int = PARTS) -> None:
    """Write a table whose columns are encrypted under a numbered key, in parts by the hash of `row_key`."""
    part = F.pmod(F.xxhash64(*row_key), F.lit(parts)).cast("int")
    out = encrypt_columns(df, columns, key).withColumns({"key_version": F.lit(version), "part": part})
    out.write.mode("errorifexists").partitionBy("part").parquet(f"{root}/data/version={version}")
    _point_to(df.sparkSession, root, version)


def _point_to(spark: SparkSession, root: str, version: int) -> None:
    spark.range(1).select(F.lit(version).alias("version")).write.mode("overwrite").parquet(f"{root}/pointer/to={version}")


def _rows_or_none(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A written folder, empty if nothing was written there yet."""
    try:
        return spark.read.parquet(path).select(*[c.split()[0] for c in schema.split(", ")])
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def current_version(spark: SparkSession, root: str) -> int:
    """The version that readers are pointed to: the largest one that was completed."""
    return spark.read.parquet(f"{root}/pointer").agg(F.max("version")).first()[0]


def read_versioned(spark: SparkSession, root: str) -> DataFrame:
    """The table as of its pointer, still encrypted, with the `key_version` of each row."""
    return spark.read.parquet(f"{root}/data/version={current_version(spark, root)}").drop("part")


def rotate_versioned(spark: SparkSession, root: str, columns: list[str], old_key: Column, new_key: Column, at_once: int | None = None) -> bool:
    """Re-encrypt the table part by part under the next version; true once readers are pointed to it.

    Parts are staged next to the old version and noted when they are whole, so a rotation that was stopped
    at any point is repeated by calling it again: noted parts are skipped, a part that was being written
    is overwritten, and each row is there once. Until the last part is staged, readers see the old
    version. `at_once` ends a call after so many parts.
    """
    version = current_version(spark, root)
    old, staged, notes = f"{root}/data/version={version}", f"{root}/data/version={version + 1}", f"{root}/staged/version={version + 1}"
    done = {r[0] for r in _rows_or_none(spark, notes, "part int").collect()}
    table = spark.read.parquet(old)
    waiting = sorted(r[0] for r in table.select("part").distinct().collect() if r[0] not in done)
    for part in waiting[:at_once]:
        rows = rotate_columns(table.where(F.col("part") == part).drop("part"), columns, old_key, new_key)
        rows.withColumn("key_version", F.lit(version + 1)).write.mode("overwrite").parquet(f"{staged}/part={part}")
        spark.range(1).select(F.lit(part).alias("part")).write.mode("overwrite").parquet(f"{notes}/of={part}")
    if at_once is not None and len(waiting) > at_once:
        return False
    _point_to(spark, root, version + 1)
    return True
