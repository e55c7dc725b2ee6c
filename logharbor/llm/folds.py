"""The fold a row is held out in, and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: One row in so many is held out from training.
FOLDS = 5


def held_out(column: str = "doc_id") -> Column:
    """True where crc32 of the id as text is divisible by FOLDS; false for a null id."""
    return F.coalesce(F.crc32(F.col(f"`{column}`").cast("string")) % FOLDS == 0, F.lit(False))


def training_labels(labels: DataFrame, name: str) -> DataFrame:
    """`doc_id, label` of the rows that may be learned from; without null ids and null labels, one per id.

    Where a row is repeated with another label, the larger one holds.
    """
    rows = labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col(f"`{name}`").isNotNull())
    return rows.groupBy("doc_id").agg(F.max(F.col(f"`{name}`").cast("int")).alias("label"))


def first_by_hash(ids: DataFrame, bound: int, column: str = "doc_id") -> DataFrame:
    """At most `bound` different ids, the same ones on each run: those with the least hash.

    An id counts once however often it is repeated. Only the lowest hashes, about four times as many as
    wanted, are sorted, so that the sort does not grow with the number of partitions. `ids` has the id
    column only.
    """
    spread = F.xxhash64(F.col(column), F.lit(23))
    share = 4 * bound / max(ids.agg(F.approx_count_distinct(column)).first()[0], 1)
    if share < 1:
        ids = ids.where(spread < F.lit(int(share * 2**64) - 2**63))
    return ids.distinct().orderBy(spread, column).limit(bound)


def one_text_per_id(rows: DataFrame, picked: DataFrame, name: str, text: str) -> DataFrame:
    """The rows whose `name` is picked, one for each name and further column of `picked`: that with the least digest."""
    found = rows.select(name, text).join(F.broadcast(picked), name)
    return found.groupBy(*picked.columns).agg(F.min_by(text, F.sha2(text, 256)).alias(text))
