"""Documents to token ids: toxic rows out, lines once, one of each near-duplicate group, no benchmark text, BPE ids.

Each stage gets (spark, docs, sf_dir) and returns what it keeps; all but the last return the columns of
documents. Rows of any stage may be null, empty or repeated, and may have further columns, which are passed on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logharbor.llm import bpe, contamination, lines, minhash, toxicity
from logharbor.llm.common import read_table, session, whole_text, written

#: The stages together have no SQL: the first is a fitted model. tests/llm has a brute-force version.
ORACLE_SQL = None


def _row_key() -> Column:
    """What names a document when an operator's result is joined back: its id and whole text."""
    return lines.row_key(F.col("doc_id").cast("long"), whole_text("text"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity is below the threshold. The model is fitted on the labels that are not held out."""
    model = toxicity.train(docs, read_table(session(spark), sf_dir, "labels"))
    kept = "__toxicity"
    return toxicity.score(docs, model, out=kept).where(F.col(kept) < toxicity.THRESHOLD).drop(kept)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with the lines that no earlier row has; rows that lose all their text go, others keep n_chars in step."""
    found = lines.line_dedup(docs).where("n_dropped > 0")
    found = found.select(F.col("key").alias("__key"), F.col("text").alias("__text")).dropDuplicates(["__key"])
    joined = docs.join(found, _row_key() == F.col("__key"), "left")
    changed = F.col("__key").isNotNull()
    joined = joined.where(~changed | (F.trim(F.regexp_replace("__text", r"\s+", " ")) != ""))
    joined = joined.withColumn("n_chars", F.when(changed, F.char_length("__text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return joined.withColumn("text", F.coalesce("__text", "text")).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest id. Rows without words stay."""
    gone = minhash.near_duplicates(docs).where("not kept").select(F.col("key").alias("__key")).distinct()
    return docs.join(gone, _row_key() == F.col("__key"), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    kept = "__items"
    found = contamination.contained_items(docs, read_table(session(spark), sf_dir, "benchmark"), out=kept)
    return found.where(F.size(kept) == 0).drop(kept)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining texts, and digests of the ids and of the decoded text."""
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), decoded="decoded")
    return coded.select(
        "doc_id",
        "lang",
        "source",
        "token_ids",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("minhash_dedup", dedup_near),
    ("decontaminate", drop_contaminated),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = read_table(session(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
