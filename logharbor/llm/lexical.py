"""Ranked lexical search by pipelined term partitioning, in integers.

Every task turns its documents into parts: the lengths of up to `PART_DOCS` documents and, for each term
that some item asks for, the documents of the part that hold it and how often. Terms are owned by stages,
cut by how many documents hold them, so that every stage owns about as many postings and the rarest terms
come first. Items travel in bundles. A bundle visits the owners in turn: a cogroup on (part, bundle) brings
together the accumulators that the bundle carries for a part and the postings of the stage's terms, adds the
integer contributions, and lets go of documents that cannot reach the k best of the part any more, whatever
the terms still to come add. What is left after the last stage is selected and ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logharbor.functions.blocks import running_number
from logharbor.llm.common import hand_back, read_table, runs, session, text_slices, whole_text, written
from logharbor.llm.shingles import mixed, powers, text_bytes

#: Results of an item.
TOP = 10
#: Stages that own terms, and items of a bundle.
STAGES = 4
BUNDLE = 128
#: Documents and postings of a part, whichever is reached first.
PART_DOCS = 2048
PART_POSTINGS = 1 << 19
#: Terms of all items that tasks may hold at once; beyond it postings of all terms are kept, and joined by a shuffle.
INDEX_TERMS = 1 << 19
#: What a document can get from one occurrence list at most, before the weight of its term.
MOST = 1_000_000
#: Parts that joins on few keys are dealt out in.
DEAL = 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = np.random.default_rng(29).integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUE[65:91] = _VALUE[97:123]
_INSIDE = np.zeros(256, bool)
_INSIDE[128:] = True
_INSIDE[48:58] = _INSIDE[65:91] = _INSIDE[97:123] = True

_PART = "part long, term long, docs binary, counts binary, ids array<long>, lengths binary, texts long, words long"
_STATE = pa.schema(
    [
        ("part", pa.int64()),
        ("bundle", pa.int32()),
        ("ids", pa.list_(pa.int64())),
        ("lengths", pa.binary()),
        ("rest", pa.list_(pa.int64())),
        ("items", pa.binary()),
        ("docs", pa.binary()),
        ("scores", pa.binary()),
    ]
)
_STATE_SQL = "part long, bundle int, ids array<long>, lengths binary, rest array<long>, items binary, docs binary, scores binary"


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts in their order, and where each text begins.

    Terms are maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased.
    """
    body, starts = text_bytes(texts)
    if not len(body):
        return np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
    inside = _INSIDE[body]
    before, after = np.zeros(len(body), bool), np.zeros(len(body), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = starts[1:-1]
    before[edges[edges < len(body)]] = False
    after[edges[edges > 0] - 1] = False
    first, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(_VALUE[body] * powers(_BASE, len(body)), out=sums[1:])
    hashes = mixed((sums[end] - sums[first]) * powers(_INVERSE, len(body))[first] + (end - first).astype(np.uint64))
    return hashes.view(np.int64), np.searchsorted(first, starts)


def _parts(wanted: np.ndarray | None) -> Callable:
    """Documents of a task as parts: a row with ids and lengths, and a row per term with its postings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, lengths, keys, docs, counts = [], [], [], [], []

        def flushed() -> Iterator[pa.RecordBatch]:
            nonlocal number
            if not ids:
                return
            key, doc, count = (np.concatenate(x) for x in (keys, docs, counts))
            order = np.argsort(key, kind="stable")  # documents come in order, so they stay so within a term
            key, doc, count = key[order], doc[order].astype("<u2"), count[order].astype("<u4")
            edges = runs(key) if len(key) else np.zeros(1, np.int64)
            begins, ends, size = edges[:-1], edges[1:], len(edges) - 1
            posting = [[None] + [x[b:e].tobytes() for b, e in zip(begins, ends)] for x in (doc, count)]
            many, head = np.array(lengths, "<u4"), [None] * size
            arrays = [
                pa.array([number] * (size + 1), pa.int64()),
                pa.array([None, *key[begins].tolist()], pa.int64()),
                *(pa.array(p, pa.binary()) for p in posting),
                pa.array([list(ids), *head], pa.list_(pa.int64())),
                pa.array([many.tobytes(), *head], pa.binary()),
                pa.array([int((many > 0).sum()), *head], pa.int64()),
                pa.array([int(many.sum()), *head], pa.int64()),
            ]
            yield pa.record_batch(arrays, ["part", "term", "docs", "counts", "ids", "lengths", "texts", "words"])
            number += 1
            for held in (ids, lengths, keys, docs, counts):
                held.clear()

        for batch in batches:
            for rows in (part.slice(b, PART_DOCS) for part in text_slices(batch, "text") for b in range(0, len(part), PART_DOCS)):
                hashes, starts = term_hashes(rows.column("text"))
                owner = np.repeat(np.arange(len(rows)), np.diff(starts))
                if wanted is not None:
                    known = np.zeros(len(hashes), bool)
                    if len(wanted):
                        known = wanted[np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)] == hashes
                    hashes, owner = hashes[known], owner[known]
                order = np.lexsort((hashes, owner))
                hashes, owner = hashes[order], owner[order]
                fresh = np.ones(len(hashes), bool)
                fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
                fresh = np.flatnonzero(fresh)
                count = np.diff(np.append(fresh, len(hashes)))
                if len(ids) + len(rows) > PART_DOCS or sum(map(len, keys)) + len(fresh) > PART_POSTINGS:
                    yield from flushed()
                keys.append(hashes[fresh])
                docs.append(owner[fresh] + len(ids))
                counts.append(count)
                lengths += np.diff(starts).tolist()
                ids += rows.column("id").to_pylist()
            hand_back()
        yield from flushed()

    return run


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, starts = term_hashes(batch.column("text"))
        owner = np.repeat(batch.column("item").to_numpy(), np.diff(starts))
        yield pa.record_batch([pa.array(owner, pa.int64()), pa.array(hashes, pa.int64())], ["item", "term"])


def weight(having: Column, total: int) -> Column:
    """floor(1000 ln((2 N + 2) / (2 df + 1))), in doubles."""
    return F.floor(1000 * F.log(F.lit(float(2 * total + 2)) / (2 * having + 1)))


def impacts(counts: np.ndarray, lengths: np.ndarray, total: int, words: int) -> np.ndarray:
    """What occurrences add to the scores of documents of these lengths, before the weight of their term."""
    counts, norm = counts.astype(np.int64), 25 + (75 * lengths.astype(np.int64) * total) // words
    return (1_000_000_000 * counts) // (1000 * counts + 8 * norm)


def _stage(k: int, total: int, words: int, stage: int) -> Callable:
    """One owner's turn: adds its terms to the accumulators that a bundle carries for a part.

    The right side has the postings that the part has of the stage's terms, each with the items of the
    bundle that ask for it. `rest` is what later stages can add to an item at most, for each item and stage.
    """

    def run(carried: pa.Table, postings: pa.Table) -> pa.Table:
        if not carried.num_rows:
            return _STATE.empty_table()
        (row,) = carried.to_pylist()
        lengths = np.frombuffer(row["lengths"], "<u4")
        table = np.zeros((BUNDLE, len(lengths)), np.int64)
        items, docs, scores = (np.frombuffer(row[c] or b"", t) for c, t in (("items", "<u2"), ("docs", "<u2"), ("scores", "<i8")))
        table[items, docs] = scores
        lists, counts, weights, asked = (postings.column(c).to_pylist() for c in ("docs", "counts", "weight", "asked"))
        at, edges = np.frombuffer(b"".join(lists), "<u2"), np.cumsum([0] + [len(x) // 2 for x in lists])
        gains = impacts(np.frombuffer(b"".join(counts), "<u4"), lengths[at], total, words) * np.repeat(np.array(weights, np.int64), np.diff(edges))
        for begin, end, asks in zip(edges, edges[1:], asked):
            for ask in asks:
                table[ask["place"], at[begin:end]] += ask["times"] * gains[begin:end]
        # a document that stands under the part's k-th best by more than the rest can add is out
        if len(lengths) > k:
            rest = np.array(row["rest"], np.int64).reshape(BUNDLE, -1)[:, stage]
            kth = np.partition(table, len(lengths) - k, axis=1)[:, len(lengths) - k]
            table[table + rest[:, None] < kth[:, None]] = 0
        items, docs = np.nonzero(table)
        row |= {"items": items.astype("<u2").tobytes(), "docs": docs.astype("<u2").tobytes(), "scores": table[items, docs].astype("<i8").tobytes()}
        hand_back()
        return pa.Table.from_pylist([row], _STATE)

    return run


def _selected(k: int) -> Callable:
    """The k best documents of each item of a bundle in a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, ids, *packed in zip(*(batch.column(c).to_pylist() for c in ("bundle", "ids", "items", "docs", "scores"))):
                items, docs, scores = (np.frombuffer(x or b"", t) for x, t in zip(packed, ("<u2", "<u2", "<i8")))
                names = np.array([np.iinfo(np.int64).max if i is None else i for i in ids], np.int64)
                order = np.lexsort((names[docs], -scores, items))
                order = order[np.arange(len(order)) - np.searchsorted(items[order], items[order]) < k]
                found = bundle * BUNDLE + items[order].astype(np.int64), [ids[d] for d in docs[order]], scores[order]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in found], ["item", "doc_id", "score"])

    return run


def staged(owned: DataFrame, stages: int) -> DataFrame:
    """Adds the stage that owns a term: the rarest terms first, cut at powers of two of `having` so that the
    stages own about as many postings. The driver sees a count for each power of two."""
    power = F.floor(F.log2("having")).cast("int")
    sizes = sorted(owned.groupBy(power.alias("power")).agg(F.sum("having")).collect())
    total, before, owner = sum(n for _, n in sizes), 0, F.lit(0)
    for at, size in sizes:
        number = min(stages - 1, int(stages * (before + size / 2) / total))
        owner, before = F.when(power >= at, F.lit(number)).otherwise(owner), before + size
    return owned.withColumn("stage", owner)


def ranked(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = TOP,
    stages: int = STAGES,
    index_terms: int = INDEX_TERMS,
) -> DataFrame:
    """The k documents with the highest score above 0 for each item, with their rank from 1.

    Returns item_id, rank, doc_id and score. Scores are sums of integers as the README states; equal scores
    are ranked by ascending doc_id, null last. Null and empty texts have no terms; items without terms have
    no results, and documents without terms do not count. Every row is a document, also one that repeats
    another. Items equal in id and text are one item; items that share an id only are ranked each on their
    own, and so is a null item id. Without documents or items the result is empty; other columns are not read.

    Documents are read once and whole. The postings of the terms that items ask for are written, about four
    bytes each; while the items have no more than `index_terms` terms, which is counted first, the tasks
    hold these to leave other terms out at once, and beyond that the join with the items' terms does it. A
    group of the cogroups is one part of the documents and one bundle of the items, both of bounded size.
    Terms are compared as 64-bit hashes.
    """
    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    asked = running_number(written(asked.where("text is not null").distinct(), "lexical-items"), [], ["item_id", "text"], "nth")
    asked = written(asked.withColumn("item", F.col("nth") - 1), "lexical-items")
    terms = asked.select("item", "text").mapInArrow(_item_terms, "item long, term long")
    terms = written(terms.groupBy("item", "term").agg(F.count(F.lit(1)).alias("times")), "lexical-terms")
    held = terms.count() <= index_terms
    wanted = np.unique(terms.select("term").toArrow().column("term").to_numpy()) if held else None

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), whole_text(text_col).alias("text"))
    parts = written(texts.mapInArrow(_parts(wanted), _PART), "lexical-parts")
    heads, lists = parts.where("term is null"), parts.where("term is not null").select("part", "term", "docs", "counts")
    total, words = heads.agg(F.coalesce(F.sum("texts"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()

    having = lists.groupBy("term").agg((F.sum(F.octet_length("docs")) / 2).cast("long").alias("having"))
    owned = written(having.join(terms.select("term").distinct(), "term").withColumn("weight", weight(F.col("having"), total)), "lexical-owners")
    place = {"bundle": F.floor(F.col("item") / BUNDLE).cast("int"), "place": F.pmod("item", F.lit(BUNDLE)).cast("int")}
    asks = written(terms.join(staged(owned, stages), "term").withColumns(place), "lexical-asks")

    most = F.col("weight") * F.col("times") * MOST
    later = [F.sum(F.when(F.col("stage") > s, most).otherwise(0)).alias(f"s{s}") for s in range(stages)]
    rest = asks.groupBy("bundle", "place").agg(*later).select("bundle", "place", F.array(*[f"s{s}" for s in range(stages)]).alias("rest"))
    rest = rest.groupBy("bundle").agg(F.map_from_entries(F.collect_list(F.struct("place", "rest"))).alias("rest"))
    none = F.array(*[F.lit(0).cast("long")] * stages)
    rest = rest.select("bundle", F.flatten(F.transform(F.sequence(F.lit(0), F.lit(BUNDLE - 1)), lambda p: F.coalesce(F.try_element_at("rest", p), none))).alias("rest"))

    def dealt(few: DataFrame) -> DataFrame:
        return few.select("*", F.explode(F.sequence(F.lit(0), F.lit(DEAL - 1))).alias("deal"))

    deal = F.pmod(F.xxhash64("part"), F.lit(DEAL)).cast("int").alias("deal")
    empty = [F.lit(None).cast("binary").alias(c) for c in ("items", "docs", "scores")]
    state = heads.select("part", "ids", "lengths", deal).join(dealt(rest), "deal").select("part", "bundle", "ids", "lengths", "rest", *empty)
    per_term = asks.groupBy("stage", "bundle", "term", "weight").agg(F.collect_list(F.struct("place", "times")).alias("asked"))
    per_term = F.broadcast(per_term) if held else dealt(per_term)
    lists = lists if held else lists.select("*", deal)
    for stage in range(stages):
        postings = lists.join(per_term.where(F.col("stage") == stage), ["term"] if held else ["term", "deal"])
        # both sides come from the same tables, so the columns they meet by get names of their own
        postings = postings.select(F.col("part").alias("p"), F.col("bundle").alias("b"), "docs", "counts", "weight", "asked")
        state = state.groupBy("part", "bundle").cogroup(postings.groupBy("p", "b")).applyInArrow(_stage(k, total, words, stage), _STATE_SQL)
    found = state.mapInArrow(_selected(k), "item long, doc_id long, score long").where("score > 0")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = session(spark)
    return ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _terms_sql(table: str, key: str) -> str:
    upper, lower = (", ".join(f"chr({c + k})" for c in range(26)) for k in (65, 97))
    folded = f"translate(coalesce(text, ''), concat({upper}), concat({lower}))"
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return f"""select {key}, term, count(*) as times from (
      select rowid_of, {key}, unnest(regexp_extract_all({folded}, '{term}')) as term
      from (select row_number() over () as rowid_of, {key}, text from {table})) group by rowid_of, {key}, term"""


ORACLE = f"""
with found as ({_terms_sql("documents", "doc_id")}),
asked as ({_terms_sql("benchmark", "item_id")}),
sizes as (select doc_id, sum(times)::bigint as n from found group by doc_id),
everything as (select count(*)::bigint as total, sum(n)::bigint as words from sizes),
having_term as (select term, count(*)::bigint as df from found group by term),
weights as (select term, floor(1000 * ln((2 * total + 2)::double / (2 * df + 1)))::bigint as w from having_term, everything),
norms as (select doc_id, 25 + (75 * n * total) // words as m from sizes, everything),
scores as (
  select item_id, doc_id, sum(a.times * w * ((1000000000 * f.times) // (1000 * f.times + 8 * m)))::bigint as score
  from asked a join found f using (term) join weights using (term) join norms using (doc_id) group by item_id, doc_id)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
where rank <= {TOP}
"""
