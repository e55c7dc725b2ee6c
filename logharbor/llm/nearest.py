"""Exact top-k search by inner product: columnar branch and bound.

Vectors are turned into integers and stored in blocks in vertical layout, one byte string per dimension. A
block of queries meets a block of candidates by an equi join on the block numbers. In there, the products
of a query are added up some dimensions at a time, those in which the query is largest first. By the
inequality of Cauchy and Schwarz, what the dimensions not yet seen can add is at most the root of the
remaining mass of the query times that of the candidate, so candidates that cannot reach the k-th best
score so far leave, and the rest are compacted before the next dimensions. Everything is integers, the
bound is rounded up, and every row that could be among the k best is scored in full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logharbor.llm.common import hand_back, written

#: Results of a query.
TOP = 10
#: One id in so many is a query of the registered search.
EVERY = 100
#: What components are multiplied with before they are rounded down.
SCALE = 1024
#: Candidates and queries of a block.
CANDIDATES = 8192
QUERIES = 2048
#: Parts that the pairing of blocks is dealt out in.
PARTS = 64
#: Dimensions that are added up before candidates leave, and candidates that are worked on at a time.
STEP = 16
CHUNK = 2048
#: Components at or beyond this cannot be scored in 64 bits by vectors of up to 8192 dimensions.
LARGEST = 1 << 15

_BLOCK = "dims int, ids array<long>, columns array<binary>"
_FOUND = "query_id long, vec_id long, score long"


def _packed(size: int) -> Callable:
    """Valid vectors of a task as blocks of up to `size` rows in vertical layout, apart for each number of dimensions."""

    def vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        column = batch.column("vector")
        lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
        for dims in np.unique(lengths[lengths >= 0]):
            rows = np.flatnonzero(lengths == dims)
            values = pc.fill_null(column.take(pa.array(rows)).flatten().cast(pa.float64()), np.nan)
            values = values.to_numpy(zero_copy_only=False).reshape(len(rows), dims)
            good = (np.abs(values) < LARGEST).all(axis=1)  # false for what is not finite
            yield int(dims), rows[good], np.floor(values[good] * SCALE).astype(np.int32)

    def block(dims: int, ids: list, table: np.ndarray) -> pa.RecordBatch:
        columns = [np.ascontiguousarray(c).tobytes() for c in table.T]
        arrays = [pa.array([dims], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([columns], pa.list_(pa.binary()))]
        return pa.record_batch(arrays, ["dims", "ids", "columns"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            names = batch.column("id").to_pylist()
            for dims, rows, values in vectors(batch):
                ids, tables = held.setdefault(dims, ([], []))
                ids += [names[r] for r in rows]
                tables.append(values)
                while len(ids) >= size:
                    table = np.concatenate(tables)
                    yield block(dims, ids[:size], table[:size])
                    del ids[:size]
                    tables[:] = [table[size:]]
            hand_back()
        for dims, (ids, tables) in held.items():
            if ids:
                yield block(dims, ids, np.concatenate(tables))

    return run


def _matrix(columns: pa.ListScalar, n: int) -> np.ndarray:
    """The vertical layout again: a row per dimension."""
    data = b"".join(columns.as_py())
    return np.frombuffer(data, np.int32).reshape(len(data) // (4 * n), n)


def best_rows(query: np.ndarray, own: int, table: np.ndarray, squares: np.ndarray, owner: np.ndarray, k: int, step: int = STEP, chunk: int = CHUNK):
    """Places and scores of the best rows of the k best ids for one query, best first.

    `table` has a row per dimension and a column per candidate, `squares` its squares; `owner` numbers the
    ids of the columns and ascends, so of equal scores the earlier column wins. Columns of `own` are left out.
    """
    order = np.argsort(-np.abs(query), kind="stable")
    mass = np.concatenate([np.cumsum((query[order].astype(np.float64) ** 2)[::-1])[::-1], [0.0]])
    best, places = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for begin in range(0, len(owner), chunk):
        alive = begin + np.flatnonzero(owner[begin : begin + chunk] != own)
        score, left = np.zeros(len(alive), table.dtype), squares[:, alive].sum(axis=0)
        for at in range(0, len(order), step):
            dims = order[at : at + step]
            score = score + query[dims] @ table[np.ix_(dims, alive)]
            if len(best) == k and at + step < len(order):
                left = np.maximum(left - squares[np.ix_(dims, alive)].sum(axis=0), 0.0)
                reach = np.sqrt(mass[at + len(dims)] * left) * (1 + 1e-9) + 1
                # later columns have larger ids, so an equal score does not suffice
                stay = np.flatnonzero(score + reach > best[-1])
                alive, score, left = alive[stay], score[stay], left[stay]
            if not len(alive):
                break
        best, places = np.concatenate([best, score.astype(np.int64)]), np.concatenate([places, alive])
        first = np.lexsort((places, -best))
        best, places = best[first], places[first]
        once = np.sort(np.unique(owner[places], return_index=True)[1])[:k]
        best, places = best[once], places[once]
    return places, best


def _searched(k: int) -> Callable:
    """The k best candidates of each query, for a group of one block of queries and one of candidates."""

    def run(group: pa.Table) -> pa.Table:
        kinds = group.column("kind").to_pylist()
        (q_ids, queries), (c_ids, table) = (
            (ids.as_py(), _matrix(columns, len(ids)))
            for ids, columns in ((group.column(c)[kinds.index(kind)] for c in ("ids", "columns")) for kind in (1, 0))
        )
        # an id that is null comes after all others
        order = sorted(range(len(c_ids)), key=lambda r: (c_ids[r] is None, c_ids[r] or 0))
        ids = [c_ids[r] for r in order]
        owner = np.cumsum([0] + [a != b for a, b in zip(ids, ids[1:])])
        numbers = dict(zip(ids, owner.tolist()))
        largest = max(abs(int(t.min(initial=0))) + abs(int(t.max(initial=0))) for t in (queries, table))
        exact = np.float64 if len(table) * largest * largest < 1 << 53 else np.int64  # sums of products fit
        table, queries = table[:, order].astype(exact), queries.astype(exact)
        squares = table.astype(np.float64) ** 2
        out: tuple[list, list, list] = ([], [], [])
        for n, query_id in enumerate(q_ids):
            places, scores = best_rows(queries[:, n], numbers.get(query_id, -1), table, squares, owner, k)
            for column, values in zip(out, ([query_id] * len(places), [ids[p] for p in places], scores.tolist())):
                column += values
        hand_back()
        return pa.table([pa.array(c, pa.int64()) for c in out], ["query_id", "vec_id", "score"])

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = TOP,
    candidates: int = CANDIDATES,
    queries: int = QUERIES,
) -> DataFrame:
    """The k rows with the largest integer inner product with each query row, exactly.

    Returns query_id, rank (from 1), vec_id and score. Components count as floor(1024 x). Queries are the
    rows where `is_query` holds and the id is not null; candidates are all rows but those with the query's
    own id. Of equal scores the smaller id comes first, null last. An id is listed once: where rows repeat
    an id, as candidates or as queries, their largest score counts, and rows without an id are one such.

    Vectors that are null, or hold null, non-finite or components of 32768 and more (whose scores
    64 bits cannot hold), take no part. Vectors meet those with as many dimensions as they have; those
    without any score 0. An empty table gives an empty result, and other columns are not read.

    Blocks of queries meet blocks of candidates, so a task holds one of each, whatever the number of
    rows; a candidate is sent once per block of queries, and at most k rows per query leave a block.
    """
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("vector"), is_query.alias("asks"))
    asking = rows.where("asks and id is not null").select("id", "vector").distinct()
    asking = written(asking, "search-queries")
    asking = asking.coalesce(max(1, -(-asking.count() // queries)))
    packed = [
        frame.mapInArrow(_packed(size), _BLOCK).withColumn("kind", F.lit(kind))
        for frame, size, kind in ((rows.select("id", "vector"), candidates, 0), (asking, queries, 1))
    ]
    blocks = written(packed[0].unionByName(packed[1]).withColumn("number", F.monotonically_increasing_id()), "search-blocks")
    # every block of queries with every block of candidates: names only, and in parts
    held = blocks.where("kind = 0").select("dims", F.col("number").alias("held"), F.pmod("number", F.lit(PARTS)).alias("part"))
    asked = blocks.where("kind = 1").select("dims", F.col("number").alias("asked"), F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    pairs = held.join(asked, ["dims", "part"]).select(F.struct("held", "asked").alias("pair"), F.explode(F.array("held", "asked")).alias("number"))
    met = pairs.join(blocks, "number").select("pair", "kind", "ids", "columns")
    found = met.groupBy("pair").applyInArrow(_searched(k), _FOUND)
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    return once.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_rows(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, F.col("vec_id") % EVERY == 0)


ORACLE = f"""
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from whole q join whole c on q.vec_id % {EVERY} = 0 and c.vec_id is distinct from q.vec_id)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= {TOP}
"""
