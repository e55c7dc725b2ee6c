"""Exact dedup with DataFrame operations only: local, salted and global merging of equal texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logharbor.llm.common import whole_text, written

#: Parts that a group of equal texts is merged in before its parts are combined; at most 64, one bit each.
SALTS = 32


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def text_groups(rows: DataFrame, salts: int) -> DataFrame:
    """One row per distinct content: digest, content, largest id, number of rows, bits of the salts it has rows in.

    Rows are grouped by their full content each time: within a task (the partial aggregate), within a
    salt, and over all salts. The aggregates are fixed-width, so a group of any size is combined
    before it is shuffled, and its final merge reads one row per salt.
    """
    salted = rows.groupBy("salt", "digest", "content").agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("n"))
    bit = F.expr("shiftleft(1L, salt)")
    return salted.groupBy("digest", "content").agg(
        F.max("id").alias("keep_id"), F.sum("n").alias("group_size"), F.bit_or(bit).alias("salt_bits")
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest=content_digest
) -> DataFrame:
    """Every row with the group of rows whose text is identical; the row with the largest id stays.

    Returns id, keep_id, group_size, kept, digest (binary). Null text counts as empty. A null id is
    smaller than any id; a group with null ids only has keep_id null and keeps its rows. Rows that
    repeat both id and text are one document and agree in every column. An empty table gives an empty
    result, and other columns are not read.

    The way back from groups to rows is a join on (digest, salt), so a large group comes in `salts`
    parts, and no text is shuffled for it. Should two different texts share a digest, the rows of that
    digest are joined on their content instead.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), whole_text(text_col).alias("content"))
    rows = rows.withColumns({"digest": digest(F.col("content")), "salt": F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")})
    per_digest = text_groups(rows, salts).groupBy("digest").agg(
        F.count(F.lit(1)).alias("contents"),
        F.max("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size"),
        F.bit_or("salt_bits").alias("salt_bits"),
    )
    per_digest = written(per_digest, "exact-dedup")
    salt = F.explode(F.expr(f"filter(sequence(0, {salts - 1}), s -> getbit(salt_bits, s) = 1)"))
    single = per_digest.where("contents = 1").select("digest", salt.alias("salt"), "keep_id", "group_size")
    found = rows.drop("content").join(single, ["digest", "salt"]).select("id", "digest", "keep_id", "group_size")
    shared = per_digest.where("contents > 1").select("digest")
    if not shared.isEmpty():
        clash = rows.join(shared, "digest", "left_semi")
        groups = text_groups(clash, salts).drop("salt_bits")
        found = found.unionByName(clash.join(groups, ["digest", "content"]).select(*found.columns))
    return found.withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def digest_rows(docs: DataFrame) -> DataFrame:
    found = exact_dedup(docs)
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


ORACLE = """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id is not distinct from max(doc_id) over g as kept, sha256(coalesce(text, '')) as text_sha256
from documents window g as (partition by coalesce(text, ''))
"""
