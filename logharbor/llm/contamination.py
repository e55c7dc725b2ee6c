"""Benchmark items inside documents: containment search with size-partitioned MinHash signatures.

Items are put in partitions by the size of their shingle set. An item's signature is its k least
shingle hashes, with one k for each partition that is large enough: a document that holds the
threshold's share of an item holds at least one of them. Membership of a signature's minima in the
document's set replaces comparing minima of both sides, which a long document would spoil. Candidates
are verified by exact containment.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logharbor.llm.common import arrow_column, by_batch, by_shuffle, read_table, session, text_slices, whole_text
from logharbor.llm.shingles import WORDS, shingle_hashes, shingle_sets, shingle_sql

#: Share of an item's shingles, in percent, from which a document holds it.
PERCENT = 75
#: Most shingles of all items for which the index is sent to every worker (16 bytes each).
INDEX_SHINGLES = 4_000_000

_FOUND = "array<struct<item: bigint, shared: bigint, size: bigint>>"


def signature_length(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Minima that the items of a size partition need: more than the shingles that the largest may lack.

    The partition of a size holds all sizes with as many binary digits.
    """
    largest = (1 << np.ceil(np.log2(np.maximum(size, 1) + 1)).astype(np.int64)) - 1
    return largest * (100 - percent) // 100 + 1


class Index:
    """Shingle sets of items, ascending, and their signatures ordered by hash."""

    def __init__(self, hashes: np.ndarray, starts: np.ndarray, percent: int = PERCENT):
        self.hashes, self.starts, self.percent = hashes, starts, percent
        sizes = np.diff(starts)
        length = np.minimum(signature_length(sizes, percent), sizes)
        owner = np.repeat(np.arange(len(sizes)), length)
        place = np.arange(length.sum()) - np.repeat(np.concatenate([[0], np.cumsum(length)])[:-1], length)
        minima = hashes[place + starts[:-1][owner]]
        order = np.argsort(minima, kind="stable")
        self.minima, self.owner = minima[order], owner[order]
        self.bits = np.uint64(min(max(len(minima), 1).bit_length() + 4, 26))
        self.known = np.zeros(1 << int(self.bits), bool)
        self.known[(minima >> (np.uint64(64) - self.bits)).astype(np.int64)] = True

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        """Items with a signature minimum among the hashes."""
        near = hashes[self.known[(hashes >> (np.uint64(64) - self.bits)).astype(np.int64)]]
        low, high = (np.searchsorted(self.minima, near, side) for side in ("left", "right"))
        hit = high > low
        if not hit.any():
            return np.zeros(0, np.int64)
        low, high = np.unique(low[hit]), np.unique(high[hit])
        return np.unique(np.concatenate([self.owner[a:b] for a, b in zip(low, high)]))

    def contained(self, hashes: np.ndarray) -> list[tuple[int, int, int]]:
        """Items that a document with these shingles holds: number, shared shingles, shingles."""
        out = []
        items = self.candidates(hashes)
        if len(items):
            own = np.unique(hashes)
            for item in items.tolist():
                wanted = self.hashes[self.starts[item] : self.starts[item + 1]]
                shared = int((own[np.minimum(np.searchsorted(own, wanted), len(own) - 1)] == wanted).sum())
                if 100 * shared >= self.percent * len(wanted):
                    out.append((item, shared, len(wanted)))
        return out


def _signature_rows(batch: pa.RecordBatch) -> pa.Table:
    hashes, starts = shingle_sets(batch.column("content"), WORDS)
    index = Index(hashes, starts)
    return pa.table({"entry": batch.column("entry").take(pa.array(index.owner)), "minimum": pa.array(index.minima.view(np.int64))})


def _document_rows(batch: pa.RecordBatch) -> pa.Table:
    tables = []
    for part in text_slices(batch, "content"):
        hashes, starts = shingle_sets(part.column("content"), WORDS)
        owner = np.repeat(np.arange(len(part)), np.diff(starts))
        tables.append(pa.table({"key": part.column("key").take(pa.array(owner)), "minimum": pa.array(hashes.view(np.int64))}))
    return pa.concat_tables(tables)


def _verify(batch: pa.RecordBatch) -> pa.Table | None:
    docs, items = (shingle_sets(batch.column(c), WORDS) for c in ("content", "wanted"))
    shared, size = [], []
    for row in range(batch.num_rows):
        own = docs[0][docs[1][row] : docs[1][row + 1]]
        wanted = items[0][items[1][row] : items[1][row + 1]]
        shared.append(int(np.isin(wanted, own, assume_unique=True).sum()))
        size.append(len(wanted))
    kept = 100 * np.array(shared) >= PERCENT * np.array(size)
    out = {"key": batch.column("key"), "item": batch.column("item"), "shared": pa.array(shared, pa.int64()), "size": pa.array(size, pa.int64())}
    return pa.table(out).filter(pa.array(kept))


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    out: str = "found",
    index_shingles: int = INDEX_SHINGLES,
) -> DataFrame:
    """The table with a list of the items that each row holds at least 75 % of, by five-word shingles.

    The list has item, shared shingles and the item's shingles, ordered by them. A text with fewer than
    five words is one shingle; items without words are held by nothing, and null texts are empty. Items
    that repeat id and text count once; two texts under one id are two entries. Repeated documents are
    judged each on its own. Without items every list is empty; an empty table of documents stays empty.
    Other columns are passed on; one that is named `out` is replaced.

    While all items together have at most `index_shingles` shingles, their index is sent to the workers
    and nothing is shuffled. Beyond that the minima are joined with the documents' shingles, and the
    candidates are verified on their texts.
    """
    wanted = items.select(F.col(f"`{item_id_col}`").cast("long").alias("item"), whole_text(item_text_col).alias("content")).distinct()
    # a text of n bytes has at most (n + 1) / 2 words, and no more shingles
    size = wanted.agg(F.sum(F.octet_length("content") + 1)).first()[0] or 0
    if size // 2 > index_shingles:
        return _by_join(docs, wanted, text_col, out)
    table = wanted.orderBy("item", "content").toArrow()  # bounded by the check above
    index = Index(*shingle_sets(table.column("content").combine_chunks(), WORDS))
    shipped = docs.sparkSession.sparkContext.broadcast((index, table.column("item").to_pylist()))
    kind = pa.list_(pa.struct([("item", pa.int64()), ("shared", pa.int64()), ("size", pa.int64())]))

    def work(texts: pa.Array) -> pa.Array:
        index, numbers = shipped.value
        hashes, starts = shingle_hashes(texts, WORDS)
        lists = [index.contained(hashes[a:b]) for a, b in zip(starts, starts[1:])]
        return pa.array([[{"item": numbers[i], "shared": s, "size": n} for i, s, n in row] for row in lists], kind)

    return docs.withColumn(out, F.array_sort(arrow_column(work, _FOUND)(whole_text(text_col))))


def _by_join(docs: DataFrame, wanted: DataFrame, text_col: str, out: str) -> DataFrame:
    key = F.unhex(F.md5(whole_text(text_col)))
    texts = docs.select(key.alias("key"), whole_text(text_col).alias("content"))
    signed = wanted.withColumn("entry", F.unhex(F.md5(F.concat_ws(":", F.col("item").cast("string"), "content"))))
    minima = signed.mapInArrow(by_batch(_signature_rows), "entry binary, minimum long")
    shingles = texts.mapInArrow(by_batch(_document_rows), "key binary, minimum long")
    pairs = by_shuffle(shingles, minima, "minimum").select("key", "entry").distinct()
    whole = signed.select("entry", "item", F.col("content").alias("wanted"))
    pairs = pairs.join(texts.dropDuplicates(["key"]), "key").join(whole, "entry").select("key", "content", "item", "wanted")
    found = pairs.mapInArrow(by_batch(_verify), "key binary, item long, shared long, size long")
    lists = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("item", "shared", "size"))).alias("lists"))
    joined = docs.drop(out).join(lists.withColumnRenamed("key", "__key"), key == F.col("__key"), "left")
    return joined.withColumn(out, F.coalesce("lists", F.array().cast(_FOUND))).drop("__key", "lists")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(session(spark), sf_dir, "documents")
    found = contained_items(docs.select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("found.item").alias("item_ids"),
        F.size("found").cast("long").alias("n_items"),
        F.coalesce(F.array_max(F.transform("found", lambda f: f.shared / f.size)), F.lit(0.0)).alias("containment"),
        (F.size("found") == 0).alias("kept"),
    )


ORACLE = f"""
with d as ({shingle_sql("documents", "doc_id")}), i as ({shingle_sql("benchmark", "item_id")}),
sizes as (select item_id, count(*) as size from i group by item_id),
held as (
  select doc_id, item_id, count(*) as shared, any_value(size) as size
  from d join i using (shingle) join sizes using (item_id) group by doc_id, item_id
  having 100 * count(*) >= {PERCENT} * any_value(size))
select doc_id, coalesce(list(item_id order by item_id) filter (item_id is not null), []) as item_ids,
       count(item_id) as n_items, coalesce(max(shared / size), 0.0) as containment, count(item_id) = 0 as kept
from documents left join held using (doc_id) group by doc_id
"""
