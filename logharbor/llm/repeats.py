"""Repeated passages: every byte that a string of a given length covers which also starts elsewhere.

Texts are cut into segments at minimizers, so that equal strings of that length lie at the same place of
segments with the same anchor. Equal segments are settled by counting. Different segments of one anchor
are compared in suffix order, by their longest previous and next factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logharbor.llm.common import by_batch, runs, text_slices, whole_groups, whole_text, written
from logharbor.llm.lines import row_key
from logharbor.llm.shingles import mixed, powers, text_bytes
from logharbor.llm.suffixes import factors

#: Length of a string that counts as repeated.
LENGTH = 400
#: Bytes of an anchor.
ANCHOR = 32
#: Different segments of one anchor that one task compares; a larger group is split.
GROUP = 1000
#: Window starts of a part when a group is split for the first, second and third time.
WIDTHS = (64, 8, 1)
#: Low bits of a packed minimum that hold its place; any Arrow batch has fewer bytes.
PLACE = np.uint64(31)

_VALUE = np.random.default_rng(17).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_MARK = "struct<anchor: bigint, segment: bigint, lo: int, hi: int, n: int>"


def window_hashes(body: np.ndarray, length: int, base: int) -> np.ndarray:
    """A polynomial hash of the `length` bytes from each position that has as many."""
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(_VALUE[body] * powers(base, len(body)), out=sums[1:])
    return mixed((sums[length:] - sums[:-length]) * powers(pow(base, -1, 1 << 64), max(len(body) - length + 1, 0)))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row, by the prefix and suffix minima of blocks."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def segments(body: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of window starts with one anchor: text, anchor hash and place, first and last start (in all bytes).

    The anchor of a window is the leftmost of its ANCHOR-byte strings with the least hash. It depends on
    the window's bytes only, so equal windows have equal anchors at equal distances.
    """
    count = np.maximum(np.diff(starts) - length + 1, 0)
    if not count.any():
        return (np.zeros(0, np.int64),) * 5
    hashes = window_hashes(body, ANCHOR, _BASE)
    packed = (hashes >> PLACE << PLACE) | np.arange(len(hashes), dtype=np.uint64)
    least = sliding_minimum(packed, length - ANCHOR + 1)
    text = np.repeat(np.arange(len(count)), count)
    window = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - starts[:-1], count)
    anchor = (least[window] & ((np.uint64(1) << PLACE) - np.uint64(1))).astype(np.int64)
    begin = runs(anchor * len(count) + text)
    first = begin[:-1]
    return text[first], hashes[anchor[first]].view(np.int64), anchor[first], window[first], window[begin[1:] - 1]


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of a set of half-open spans; spans that touch are one run."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    begin = np.concatenate([[0], np.flatnonzero(spans[1:, 0] > reach[:-1]) + 1])
    return np.stack([spans[begin, 0], reach[np.concatenate([begin[1:] - 1, [len(spans) - 1]])]], 1)


def _mark(keep_first: bool, length: int):
    def work(batch: pa.RecordBatch) -> pa.Table:
        tables = []
        for part in text_slices(batch, "content"):
            body, starts = text_bytes(part.column("content"))
            text, anchor, _, lo, hi = segments(body, starts, length)
            view = memoryview(body) if len(body) else memoryview(b"")
            digest = np.fromiter((xxhash.xxh3_64_intdigest(view[a : b + length]) for a, b in zip(lo, hi)), np.uint64, len(lo))
            digest = digest.view(np.int64)
            # equal segments of one text are settled here: one mark with their number stays
            order = np.lexsort((lo, digest, anchor, text))
            text, anchor, digest, lo, hi = (x[order] for x in (text, anchor, digest, lo, hi))
            fresh = np.ones(len(text), bool)
            fresh[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1])
            at = np.flatnonzero(fresh)
            number = np.diff(np.concatenate([at, [len(text)]]))
            again = np.repeat(number > 1, number) & (~fresh if keep_first else True)
            local = np.stack([lo[again] - starts[text[again]], hi[again] + length - starts[text[again]]], 1).astype(np.int32)
            where = np.searchsorted(text[again], np.arange(len(part) + 1))
            spans = [merged(local[i:j]) for i, j in zip(where, where[1:])]
            marks = pa.StructArray.from_arrays(
                [
                    pa.array(anchor[at]),
                    pa.array(digest[at]),
                    pa.array((lo - starts[text])[at].astype(np.int32)),
                    pa.array((hi - starts[text])[at].astype(np.int32)),
                    pa.array(number.astype(np.int32)),
                ],
                ["anchor", "segment", "lo", "hi", "n"],
            )
            offsets = pa.array(np.searchsorted(text[at], np.arange(len(part) + 1)).astype(np.int32))
            out = {"id": part.column("id"), "key": part.column("key"), "marks": pa.ListArray.from_arrays(offsets, marks)}
            tables.append(pa.table(out | {"spans": span_lists(spans)}))
        return pa.concat_tables(tables)

    return work


def span_lists(spans: list[np.ndarray]) -> pa.ListArray:
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in spans])]).astype(np.int32))
    flat = np.concatenate([np.zeros((0, 2), np.int32), *spans]).astype(np.int32)
    lo, hi = (pa.array(np.ascontiguousarray(flat[:, k])) for k in (0, 1))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([lo, hi], ["lo", "hi"]))


def _cut(length: int):
    """The segments that are asked for, with their bytes."""

    def work(batch: pa.RecordBatch) -> pa.Table | None:
        texts, out = batch.column("content").to_pylist(), []
        for row, wanted in enumerate(batch.column("wanted").to_pylist()):
            data = texts[row].encode()
            out += [(row, w["anchor"], w["lo"], w["hi"], w["n"], w["crowded"], data[w["lo"] : w["hi"] + length]) for w in wanted]
        row, anchor, lo, hi, n, crowded, data = zip(*out)
        rows = pa.array(row)
        return pa.table(
            {
                "id": batch.column("id").take(rows),
                "key": batch.column("key").take(rows),
                "anchor": pa.array(anchor, pa.int64()),
                "lo": pa.array(lo, pa.int32()),
                "hi": pa.array(hi, pa.int32()),
                "n": pa.array(n, pa.int64()),
                "crowded": pa.array(crowded, pa.bool_()),
                "data": pa.array(data, pa.binary()),
            }
        )

    return work


def _factored(keep_first: bool, length: int):
    """Spans of the windows that start elsewhere too, among the segments of each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "anchor"):
            body, starts = text_bytes(table.column("data").combine_chunks())
            count = np.diff(starts) - length + 1
            owner = np.repeat(np.arange(len(count)), count)
            window = np.arange(count.sum()) + np.repeat(starts[:-1] - np.concatenate([[0], np.cumsum(count)])[:-1], count)
            earlier, later = factors(body, window, length, length)
            repeated = (earlier if keep_first else np.maximum(earlier, later)) >= length
            if not keep_first:  # a segment that occurs more often has been settled by its number
                repeated &= (table.column("n").to_numpy() == 1)[owner]
            owner, window = owner[repeated], window[repeated]
            if not len(owner):
                continue
            begin = runs(window - np.arange(len(window)) + owner * 2 * len(body))
            owner, lo = owner[begin[:-1]], (window - starts[owner])[begin[:-1]]
            lo = lo + table.column("lo").to_numpy()[owner]
            hi = lo + np.diff(begin) - 1 + length
            key = table.column("key").combine_chunks().take(pa.array(owner))
            yield pa.record_batch({"key": key, "lo": pa.array(lo.astype(np.int32)), "hi": pa.array(hi.astype(np.int32))})

    return run


def _split(width: int, length: int):
    """Parts of segments whose windows begin at most `width` places apart, counted from the anchor.

    All windows of such a part hold the bytes from its last start to `length` after its first one. So equal
    windows are in parts with equal such cores, and the core is the new anchor.
    """

    def work(batch: pa.RecordBatch) -> pa.Table:
        body, starts = text_bytes(batch.column("data"))
        view = memoryview(body)
        row, _, anchor, lo, hi = segments(body, starts, length)
        out = {c: [] for c in ("row", "anchor", "segment", "lo", "hi", "data")}
        for k, place, first, last in zip(row.tolist(), anchor.tolist(), lo.tolist(), hi.tolist()):
            shift = batch.column("lo")[k].as_py() - int(starts[k])
            while first <= last:
                part = (place - first) // width
                end = min(last, place - part * width)
                core = view[place - part * width : place - (part + 1) * width + 1 + length]
                data = view[first : end + length]
                values = (k, xxhash.xxh3_64_intdigest(core, part), xxhash.xxh3_64_intdigest(data), first + shift, end + shift, bytes(data))
                for c, value in zip(out, values):
                    out[c].append(value)
                first = end + 1
        rows = pa.array(out.pop("row"), pa.int64())
        kept = {c: batch.column(c).take(rows) for c in ("id", "key", "n")}
        hashes = {c: pa.array(np.array(out[c], np.uint64).view(np.int64)) for c in ("anchor", "segment")}
        return pa.table(kept | hashes | {"lo": pa.array(out["lo"], pa.int32()), "hi": pa.array(out["hi"], pa.int32()), "data": pa.array(out["data"], pa.binary())})

    return work


def _settled(pieces: DataFrame, first: bool, length: int, group: int) -> Iterator[DataFrame]:
    """Spans of repeated windows among pieces of the same anchor; crowded groups are split by their cores."""
    for width in [w for w in WIDTHS if w == 1 or w <= length - ANCHOR]:
        calm = pieces.where("not crowded").repartition("anchor").sortWithinPartitions("anchor", "id", "lo", "key")
        yield calm.mapInArrow(_factored(first, length), "key binary, lo int, hi int")
        crowded = pieces.where("crowded")
        if crowded.isEmpty():
            return
        parts = crowded.mapInArrow(
            by_batch(_split(width, length)), "id long, key binary, n long, anchor long, segment long, lo int, hi int, data binary"
        )
        kinds = parts.groupBy("anchor", "segment").agg(F.sum("n").alias("n"), F.min(F.struct("id", "lo", "key")).alias("place"))
        parts = written(parts.drop("n").join(kinds, ["anchor", "segment"]), "repeats")
        leads = F.struct("key", "lo").eqNullSafe(F.struct("place.key", "place.lo"))
        again = parts.where((F.col("n") > 1) & ~leads) if first else parts.where("n > 1")
        yield again.select("key", "lo", (F.col("hi") + length).alias("hi"))
        kept = parts.where(leads)
        crowd = kept.groupBy("anchor").agg((F.count(F.lit(1)) > group).alias("crowded"))
        pieces = written(kept.join(crowd, "anchor"), "repeats")


def _removed(batch: pa.RecordBatch) -> pa.Table:
    """Maximal runs of the spans of each text, and the bytes outside them."""
    lists, kept, sizes = [], [], []
    for text, spans in zip(batch.column("content").to_pylist(), batch.column("spans").to_pylist()):
        data = text.encode()
        found = merged(np.array([(s["lo"], s["hi"]) for s in spans or []], np.int64).reshape(-1, 2))
        edges = [0, *found.ravel().tolist(), len(data)]
        kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
        lists.append(found)
        sizes.append(len(data))
    out = {"id": batch.column("id"), "n_bytes": pa.array(sizes, pa.int64()), "spans": span_lists(lists)}
    return pa.table(out | {"kept": pa.array(kept, pa.binary())})


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, keep: str = "none", group: int = GROUP
) -> DataFrame:
    """`id, n_bytes, spans, kept`: for every row the maximal runs of repeated bytes and what remains, as UTF-8 bytes.

    A byte is repeated if a string of `length` bytes covers it that also starts anywhere else, in the
    same text or another; matches do not cross texts and may overlap. With keep="first" the earliest
    occurrence, by id (null first) and position, stays. Null text counts as empty; texts shorter than
    `length` have no spans. Rows that repeat id and text are occurrences of their own with keep="none";
    with keep="first" they share the first place. An empty table gives an empty result; other columns are
    not read.

    Per anchor only one copy of each different segment is compared, so copies of any number do not meet
    in one task. An anchor with more than `group` different segments is split: into parts of 64, then 8,
    then single window starts, whose common bytes are the new anchor, until no group is crowded.
    """
    first = keep == "first"
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), whole_text(text_col).alias("content"))
    rows = rows.select("id", "content", row_key(F.col("id"), F.col("content")).alias("key"))
    signed = rows.mapInArrow(
        by_batch(_mark(first, length)),
        f"id long, key binary, marks array<{_MARK}>, spans array<struct<lo: int, hi: int>>",
    )
    signed = written(signed.where("size(marks) > 0"), "repeats")
    marks = signed.select("id", "key", F.expr("inline(marks)"))
    anchors = marks.groupBy("anchor").agg(F.sum("n").alias("all"), F.min("segment").alias("s"), F.max("segment").alias("t"))
    anchors = anchors.where("all > 1").select("anchor", F.expr("s <> t").alias("mixed"))
    shared = written(marks.join(anchors, "anchor"), "repeats")

    place = F.min(F.struct("id", "lo", "key", "hi")).alias("place")
    kinds = (shared if first else shared.where("mixed")).groupBy("anchor", "segment", "mixed")
    kinds = written(kinds.agg(F.sum("n").alias("n"), place), "repeats")
    whole = shared.join(kinds.where("n > 1").drop("n", "mixed"), ["anchor", "segment"])
    if first:
        whole = whole.where(~F.struct("key", "lo").eqNullSafe(F.struct("place.key", "place.lo")))
    whole = whole.select("key", "lo", (F.col("hi") + length).alias("hi"))
    if not first:
        plain = shared.where("not mixed").select("key", "lo", (F.col("hi") + length).alias("hi"))
        whole = whole.unionByName(plain)

    crowd = kinds.where("mixed").groupBy("anchor").agg((F.count(F.lit(1)) > group).alias("crowded"))
    wanted = kinds.where("mixed").join(crowd, "anchor").select(
        "place.key", F.struct("anchor", "place.lo", "place.hi", "n", "crowded").alias("mark")
    )
    wanted = wanted.groupBy("key").agg(F.collect_list("mark").alias("wanted"))
    pieces = rows.join(wanted, "key").select("id", "content", "key", "wanted")
    pieces = pieces.mapInArrow(
        by_batch(_cut(length)), "id long, key binary, anchor long, lo int, hi int, n long, crowded boolean, data binary"
    )
    # rows that repeat id and text are one place; with keep="none" they have been settled by their number
    pieces = pieces.dropDuplicates(["anchor", "key", "lo"])
    settled = _settled(written(pieces, "repeats"), first, length, group)

    local = signed.select("key", F.expr("inline(spans)"))
    spans = reduce(DataFrame.unionByName, settled, whole.unionByName(local))
    # rows that repeat id and text bring the same spans: a set is bounded by one text
    spans = spans.groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    out = rows.join(spans, "key", "left").select("id", "content", "spans")
    return out.mapInArrow(by_batch(_removed), "id long, n_bytes long, spans array<struct<lo: int, hi: int>>, kept binary")


def digest_rows(docs: DataFrame) -> DataFrame:
    return repeated_passages(docs).select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


ORACLE = f"""
with t as (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
w as (select doc_id, p, md5(substr(h, 2 * p + 1, {2 * LENGTH})) as k from t, unnest(range(0, n - {LENGTH - 1})) as u(p)),
again as (select doc_id, p from w where k in (select k from w group by k having count(*) > 1)),
cut as (select *, coalesce(p - lag(p) over (partition by doc_id order by p) > {LENGTH}, true)::int as opens from again),
runs as (select doc_id, min(p) as lo, max(p) + {LENGTH} as hi
  from (select *, sum(opens) over (partition by doc_id order by p) as run from cut) group by doc_id, run),
edges as (select doc_id, lo, hi from runs union all select doc_id, n, n from t),
rest as (select doc_id, lo, hi, coalesce(lag(hi) over (partition by doc_id order by lo, hi), 0) as begin from edges),
kept as (
  select doc_id, count(*) - 1 as n_spans, cast(sum(hi - lo) as bigint) as n_removed,
         string_agg(substr(h, 2 * begin + 1, 2 * (lo - begin)), '' order by begin, lo) as rest
  from rest join t using (doc_id) group by doc_id)
select doc_id, n as n_bytes, n_removed, n_spans, sha256(unhex(coalesce(rest, ''))) as kept_sha256 from t join kept using (doc_id)
"""
