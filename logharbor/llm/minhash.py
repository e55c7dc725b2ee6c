"""Near-duplicate documents: minhash bands, signature verification, exact links, connected components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logharbor.llm.common import by_batch, by_shuffle, runs, text_slices, whole_groups, whole_text, written
from logharbor.llm.components import components
from logharbor.llm.lines import row_key
from logharbor.llm.shingles import WORDS, mixed, shingle_sets, shingle_sql

#: Minima of a signature and minima of a band. A pair at the threshold shares no band with a chance of 5e-6.
MINIMA, BAND = 128, 4
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Signature agreement below which a pair is not looked at: four standard deviations under the threshold.
AGREE = 0.60
#: Rows of either side that one task compares in a bucket.
BLOCK = 1000
#: Rows of a bucket outside its most frequent component, a block of them, from which rows meet by rare shingles instead.
CROWD = BLOCK

_DRAW = np.random.default_rng(5).integers(0, 1 << 63, (2, MINIMA), dtype=np.uint64)
_SCALE, _SHIFT = (_DRAW[0] << np.uint64(1)) | np.uint64(1), _DRAW[1]
_SIGNATURE = "key binary, id long, n_shingles long, digest binary, bands array<long>, sketch binary"


def signatures_of(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minima of MINIMA universal hashes (multiply, add, take the high half) over each non-empty run."""
    out = np.empty((len(starts) - 1, MINIMA), np.uint32)
    for k in range(MINIMA):
        spread = ((hashes * _SCALE[k] + _SHIFT[k]) >> np.uint64(32)).astype(np.uint32)
        out[:, k] = np.minimum.reduceat(spread, starts[:-1])
    return out


def bands_of(signatures: np.ndarray) -> np.ndarray:
    """One key for each band of a signature; the number of the band is part of the key."""
    parts = signatures.astype(np.uint64).reshape(len(signatures), MINIMA // BAND, BAND)
    key = np.arange(1, MINIMA // BAND + 1, dtype=np.uint64) * np.ones((len(signatures), 1), np.uint64)
    for k in range(BAND):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _sign(batch: pa.RecordBatch) -> pa.Table:
    tables = []
    for part in text_slices(batch, "content"):
        hashes, starts = shingle_sets(part.column("content"), WORDS)
        sizes = np.diff(starts)
        full = np.flatnonzero(sizes)
        runs = np.concatenate([starts[:-1][full], starts[-1:]])
        signatures = signatures_of(hashes, runs) if len(full) else np.empty((0, MINIMA), np.uint32)
        bands, sketches = bands_of(signatures), signatures.astype(np.uint8)
        at = np.full(len(sizes), -1)
        at[full] = np.arange(len(full))
        columns = {
            "key": part.column("key"),
            "id": part.column("id"),
            "n_shingles": pa.array(sizes, pa.int64()),
            "digest": [_digest(hashes[i:j]) for i, j in zip(starts, starts[1:])],
            "bands": pa.array([bands[k] if k >= 0 else [] for k in at], pa.list_(pa.int64())),
            "sketch": pa.array([sketches[k].tobytes() if k >= 0 else b"" for k in at], pa.binary()),
        }
        tables.append(pa.table(columns))
    return pa.concat_tables(tables)


def _agreement(batch: pa.RecordBatch) -> pa.Table | None:
    left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, MINIMA) for c in ("sketch_a", "sketch_b"))
    agree = (left == right).sum(1)
    out = pa.table({"a": batch.column("a"), "b": batch.column("b"), "agree": pa.array(agree, pa.int32())})
    return out.filter(pa.array(agree >= AGREE * MINIMA))


def _confirm(batch: pa.RecordBatch) -> pa.Table | None:
    """The pairs whose full shingle sets pass the threshold; the set of a repeated text is made once."""
    sets: dict[int, np.ndarray] = {}
    for side in "ab":
        fresh = pa.table({"id": batch.column(side), "text": batch.column(f"text_{side}")})
        rows = {i: row for row, i in enumerate(fresh.column("id").to_pylist()) if i not in sets}
        texts = fresh.column("text").take(pa.array(list(rows.values()), pa.int64())).combine_chunks()
        hashes, starts = shingle_sets(texts, WORDS)
        sets |= {i: hashes[starts[k] : starts[k + 1]] for k, i in enumerate(rows)}
    kept = []
    for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
        one, two = sets[a], sets[b]
        if not len(one) or not len(two):
            kept.append(False)
            continue
        common = np.count_nonzero(two[np.minimum(np.searchsorted(two, one), len(two) - 1)] == one)
        kept.append(100 * common >= PERCENT * (len(one) + len(two) - common))
    return pa.table({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(kept))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links by their full sets. Both joins may be split at a hot node."""
    for side in "ab":
        named = texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
        pairs = pairs.join(named, side)
    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(by_batch(_confirm), "a long, b long")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a block across components, one for each probe and other component.

    A pair is looked at in the first band that it shares, and if its signatures agree; it is a link by its full sets.
    """
    for table in whole_groups(batches, "part"):
        table = table.combine_chunks()
        columns = {c: table.column(c).to_numpy() for c in ("part", "bucket", "node", "component", "n_shingles", "probe", "loose")}
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, MINIMA)
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, MINIMA // BAND)
        rows, inverse = np.unique(columns["node"], return_index=True, return_inverse=True)[1:]
        hashes, starts = shingle_sets(table.column("text").take(pa.array(rows)).combine_chunks(), WORDS)
        sets = [hashes[starts[k] : starts[k + 1]] for k in range(len(rows))]
        edges, banded = runs(columns["part"]), table.column("banded").to_numpy()
        found = [np.zeros((0, 2), np.int64)]
        for begin, end in zip(edges, edges[1:]):
            here = slice(begin, end)
            bucket, node, component, n, probe, loose = (columns[c][here] for c in list(columns)[1:])
            fixed = np.flatnonzero(~probe)
            kept, codes = sketch[here][fixed], bands[here][fixed]
            for x in np.flatnonzero(probe):
                agree = (kept == sketch[here][x]).sum(1)
                less, more = np.minimum(n[fixed], n[x]), np.maximum(n[fixed], n[x])
                ok = (agree >= AGREE * MINIMA) & (component[fixed] != component[x]) & (100 * less >= PERCENT * more)
                ok &= ~loose[fixed] | (node[fixed] > node[x])
                at = np.flatnonzero(ok)
                if len(at) and banded[begin]:
                    same = codes[at] == bands[here][x]
                    at = at[codes[at, same.argmax(1)] == bucket[x]]
                if len(at):
                    own = sets[inverse[begin + x]]
                    others = [sets[k] for k in inverse[begin + fixed[at]]]
                    size = np.array([len(o) for o in others])
                    joined = np.concatenate(others)
                    hit = own[np.minimum(np.searchsorted(own, joined), len(own) - 1)] == joined
                    shared = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(size)[:-1]]))
                    at = fixed[at[100 * shared >= PERCENT * (size + len(own) - shared)]]
                    at = at[np.unique(component[at], return_index=True)[1]]
                    found.append(np.stack([np.full(len(at), node[x]), node[at]], 1))
        a, b = np.concatenate(found).T
        yield pa.record_batch({"a": a, "b": b})


def _shingled(batch: pa.RecordBatch) -> pa.Table:
    tables = []
    for part in text_slices(batch, "text"):
        hashes, starts = shingle_sets(part.column("text"), WORDS)
        sizes = np.diff(starts)
        owner, n = pa.array(np.repeat(np.arange(len(part)), sizes)), pa.array(np.repeat(sizes, sizes))
        tables.append(pa.table({"node": part.column("node").take(owner), "bucket": pa.array(hashes.view(np.int64)), "n": n}))
    return pa.concat_tables(tables)


def _by_rare_shingles(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Buckets (bucket, node) in which any two of these nodes that are links meet: their shingles that are rare among them.

    In an order that all sets share, here from rare to frequent, sets of a similarity of 75 % have a common
    shingle among the first quarter of either and one more (prefix filtering).
    """
    shingles = texts.join(nodes, "node", "left_semi").mapInArrow(by_batch(_shingled), "node long, bucket long, n long")
    shingles = written(shingles, "minhash")
    counts = shingles.groupBy("bucket").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # shingles of one node only come first in the order, and take their places in its prefix
    shared = by_shuffle(shingles, counts, "bucket")
    own = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("node"))
    nth = F.row_number().over(Window.partitionBy("node").orderBy("df", "bucket"))
    least = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1
    return shared.withColumn("nth", nth + own).where(F.col("nth") <= least).select("bucket", "node")


def _across(members: DataFrame, classes: DataFrame, texts: DataFrame, found: DataFrame) -> DataFrame:
    """Links (a, b) of rows that share a bucket and are not in one component yet; enough to join their components.

    In each bucket the rows outside its most frequent component are compared with all others. Both sides
    are cut into blocks, so no task holds a whole bucket, and only links leave a task. Many components in
    one bucket are pages of one template rather than copies: where a block of rows or more lies outside the
    most frequent one, the rows of the bucket meet in buckets of rare shingles instead.
    """
    placed = by_shuffle(members, found, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component"))
    sizes = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("bucket").agg((F.sum("n") - F.max("n")).alias("loose"))
    crowded = written(sizes.where(F.col("loose") >= CROWD).select("bucket"), "minhash")
    nodes = written(placed.join(crowded, "bucket", "left_semi").select("node").distinct(), "minhash")
    rare = _by_rare_shingles(nodes, texts).withColumn("banded", F.lit(False))
    banded = placed.join(crowded, "bucket", "left_anti").select("bucket", "node").withColumn("banded", F.lit(True))
    placed = by_shuffle(written(banded.unionByName(rare), "minhash"), found, "node", "left")
    placed = placed.select("bucket", "node", "banded", F.coalesce("component", "node").alias("component"))
    counts = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("bucket").agg(
        F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts")
    )
    main = main.where("parts > 1").select(
        "bucket",
        F.col("main.component").alias("main"),
        F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("n") - F.col("main.n")) / BLOCK).cast("int").alias("probes"),
    )
    rows = placed.join(main, "bucket").withColumn("loose", F.expr("component <> main")).drop("main")
    spread = F.xxhash64("node", F.lit(7))
    fixed = rows.withColumns({"probe": F.lit(False), "i": F.pmod(spread, "blocks").cast("int"), "j": F.explode(F.expr("sequence(0, probes - 1)"))})
    probe = rows.where("loose").withColumns({"probe": F.lit(True), "j": F.pmod(spread, "probes").cast("int"), "i": F.explode(F.expr("sequence(0, blocks - 1)"))})
    blocks = fixed.unionByName(probe).select("bucket", "node", "component", "probe", "loose", "banded", F.xxhash64("bucket", "banded", "i", "j").alias("part"))
    blocks = blocks.join(classes.select("node", "n_shingles", "bands", "sketch"), "node").join(texts, "node")
    return blocks.repartition("part").sortWithinPartitions("part").mapInArrow(_compare, "a long, b long")


def _best(pairs: DataFrame) -> DataFrame:
    """For each node the partner whose signature agrees best."""
    return pairs.groupBy("a").agg(F.max(F.struct("agree", "b")).alias("best")).select("a", "best.b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`key, id, n_shingles, component_id, kept` for every row; rows in one component are chained by links.

    Two rows are linked when their sets of five-word shingles have a Jaccard similarity of at least 0.75.
    Null and empty texts have no set and no link; a shorter text is one shingle. Rows with equal sets
    are one class, for which the text of one row stands, so repeated rows, null ids and ties take part
    once. `component_id` is the smallest id of the component; a null id counts as larger than any, and a
    row is kept if its id is the component's. `key` names id and text. An empty table gives an empty
    result, and other columns are not read.

    A class meets, in each band, the smallest class of its bucket; of these the one whose signature
    agrees best is confirmed on the full sets. Where a bucket then still holds several components, its
    rows are compared across them, or, if a block of rows or more stands apart in it, meet by rare shingles.
    So a large group is joined by few links, and pages of one template are not compared all with all. Of
    the pairs that could join two components those are left out that share no band (5e-6 at the threshold)
    or whose signatures agree in less than AGREE of their minima (four standard deviations under it).
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), whole_text(text_col).alias("content"))
    rows = rows.withColumn("key", row_key(F.col("id"), F.col("content")))
    signed = written(rows.mapInArrow(by_batch(_sign), _SIGNATURE), "minhash")
    classes = signed.where("n_shingles > 0").groupBy("digest").agg(
        F.min("id").alias("id"), F.min("key").alias("key"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch")]
    )
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "minhash")

    banded = classes.select("node", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    members = written(by_shuffle(banded, shared.drop("last"), "bucket"), "minhash")
    wanted = by_shuffle(members.select("node").distinct(), classes.select("node", "key"), "node")
    texts = rows.join(wanted, "key").select("node", F.col("content").alias("text"))
    texts = written(texts.dropDuplicates(["node"]), "minhash")  # rows that repeat id and text share a key

    stars = members.where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct()
    for side in "ab":
        stars = by_shuffle(stars, classes.select(F.col("node").alias(side), F.col("sketch").alias(f"sketch_{side}")), side)
    stars = _best(stars.mapInArrow(by_batch(_agreement), "a long, b long, agree int"))
    links = written(_confirmed(stars, texts), "minhash")
    links = links.unionByName(_across(members, classes, texts, components(links)))

    placed = by_shuffle(classes.select("digest", "id", "node"), components(links), "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    labels = placed.join(least, "component").select("digest", "component_id")
    out = signed.select("key", "id", "n_shingles", "digest").join(labels, "digest", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    out = out.select("key", "id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def component_rows(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


ORACLE = f"""
with recursive d as ({shingle_sql("documents", "doc_id")}), sizes as (select doc_id, count(*) as n from d group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as common from d a join d b using (shingle) where a.doc_id <> b.doc_id group by all),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= {PERCENT} * (x.n + y.n - common)),
reach as (select doc_id as node, doc_id as seen from sizes union select node, b from reach join links on a = seen),
least as (select node, min(seen) as component_id from reach group by node)
select doc_id, coalesce(n, 0) as n_shingles, coalesce(component_id, doc_id) as component_id,
       doc_id = coalesce(component_id, doc_id) as kept
from documents left join sizes using (doc_id) left join least on node = doc_id
"""
