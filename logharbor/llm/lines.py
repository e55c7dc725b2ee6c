"""Near-equal lines by a segment-partition edit join.

A line is cut into EDITS + 1 segments. If another line is within EDITS edits, at least one segment of
the shorter one occurs in the longer one, close to its own place. So segments are indexed by length of
line, number and content; a line probes the index with its substrings at the places that are possible
for each length. Pairs that meet are verified by a banded bit-parallel edit distance.

Lines of one template share a segment and little else says that they are near. The lines of such a crowded
key are cut a second time, at places that share out what varies between them, and meet only if they also
agree in one of these segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logharbor.llm.common import by_batch, by_shuffle, read_table, runs, session, text_slices, whole_groups, whole_text, written
from logharbor.llm.shingles import mixed, powers, text_bytes

#: Edits (insert, delete or replace a UTF-8 byte) up to which two lines count as one.
EDITS = 2
#: Bytes of the shortest line that is judged, without white space at its ends.
LEAST_BYTES = 20
#: Rows of either side that one task compares for one index key.
BLOCK = 1000
#: Index entries of a key from which its lines are cut a second time, and lines that show what varies.
CROWD, SHOWN = 100, 64
#: Classes of bytes whose counts bound the distance from below.
CLASSES = 16

_VALUE = np.random.default_rng(41).integers(1, 1 << 63, 256, dtype=np.uint64)
_CLASS = (np.random.default_rng(43).permutation(256) % CLASSES).astype(np.int64)
_BASE = 0x9E3779B97F4A7C15
_WHITE = b" \t\n\r\x0b\x0c"
_SOLID = np.ones(256, bool)
_SOLID[list(_WHITE)] = False


def edit_distance(a: bytes, b: bytes, most: int) -> int:
    """The edit distance if it is at most `most`, else `most` + 1.

    Only the diagonals that matter are kept: the vertical differences of a band of 2 * most + 1 rows are
    two bit strings, which move down one row with each column.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return most + 1
    first = 0
    while first < len(b) and a[first] == b[first]:
        first += 1
    end = 0
    while end < len(b) - first and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[first : len(a) - end], b[first : len(b) - end]
    if not b:
        return len(a)
    places: dict[int, int] = {}
    for row, byte in enumerate(a):
        places[byte] = places.get(byte, 0) | (1 << row)
    width = 2 * most + 1
    every = (1 << width) - 1
    plus, minus = every ^ ((1 << most) - 1), 0
    distance = min(most, len(a))  # of the lowest row of the band, later of the last row
    for column, byte in enumerate(b, 1):
        top = column - most - 1  # the row, from zero, that bit 0 stands for
        at = places.get(byte, 0)
        equal = (at >> top if top >= 0 else at << -top) & every
        diagonal = ((((equal & plus) + plus) ^ plus) | equal | minus) & every
        up = (minus | ~(diagonal | plus)) & every
        down = diagonal & plus
        last = len(a) - 1 - top  # the bit of the last row, once it is in the band
        if last >= width - 1:
            distance += not diagonal >> (width - 1) & 1
        else:
            distance += (up >> last & 1) - (down >> last & 1)
        if distance > most + min(len(b) - column, len(b) - len(a) + most):  # it falls by one a step along the last row at best
            return most + 1
        shifted = diagonal >> 1
        plus, minus = (down | ~(shifted | up)) & every, shifted & up
    return min(distance, most + 1)


def cut_lines(body: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, number, begin and end of every judged line; white space at its ends is left out."""
    solid = np.flatnonzero(_SOLID[body])
    breaks = np.flatnonzero(body == 10)
    begin = np.sort(np.concatenate([starts[:-1], breaks + 1]), kind="stable")
    text = np.searchsorted(starts, begin, side="right") - 1
    # an empty text shares its start with the next one; a line end at the end of a text opens a last line
    inside = begin < starts[np.minimum(text + 1, len(starts) - 1)]
    begin, text = begin[inside], text[inside]
    end = np.append(breaks, len(body))[np.searchsorted(breaks, begin)]
    end = np.minimum(end, starts[text + 1])
    number = np.searchsorted(breaks, begin) - np.searchsorted(breaks, starts[text])
    first, last = np.searchsorted(solid, begin), np.searchsorted(solid, end)
    some = last > first
    lo, hi = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    lo[some], hi[some] = solid[first[some]], solid[last[some] - 1] + 1
    judged = hi - lo >= LEAST_BYTES
    return text[judged], number[judged], lo[judged], hi[judged]


def segment(length: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and size of one of the EDITS + 1 segments of a line; later segments are one byte longer at most."""
    parts = EDITS + 1
    small, longer = length // parts, length % parts
    short = parts - longer
    begin = number * small + np.maximum(number - short, 0)
    return begin, small + (number >= short)


def line_keys(body: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Line, key and whether it is an entry of the index, for every substring that a line is found by.

    Of a line that is d bytes longer, segment i (from zero) may have moved by up to i places, and by up to
    EDITS - i counted from the end; only substrings that satisfy both are probed.
    """
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(_VALUE[body] * powers(_BASE, len(body)), out=sums[1:])
    back = powers(pow(_BASE, -1, 1 << 64), len(body) + 1)
    for longer in range(EDITS + 1):
        length = hi - lo - longer
        for number in range(EDITS + 1):
            begin, size = segment(length, number)
            for shift in range(max(-number, longer - EDITS + number), min(number, longer + EDITS - number) + 1):
                at = begin + shift
                line = np.flatnonzero((at >= 0) & (at + size <= hi - lo) & (length >= LEAST_BYTES))
                first = (lo + at)[line]
                content = (sums[first + size[line]] - sums[first]) * back[first]
                tag = length[line].astype(np.uint64) * np.uint64(EDITS + 1) + np.uint64(number)
                yield line, mixed(content ^ mixed(tag)).view(np.int64), longer == shift == 0


def _digests(body: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[bytes]:
    view = memoryview(body) if len(body) else memoryview(b"")
    return [xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(lo, hi)]


def _node(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.int64)[::2]


def _occurrences(batch: pa.RecordBatch) -> pa.Table:
    tables = []
    for part in text_slices(batch, "content"):
        body, starts = text_bytes(part.column("content"))
        text, number, lo, hi = cut_lines(body, starts)
        rows, digests = pa.array(text), _digests(body, lo, hi)
        columns = {"digest": pa.array(digests, pa.binary()), "node": pa.array(_node(digests)), "id": part.column("id").take(rows)}
        tables.append(pa.table(columns | {"n": pa.array(number.astype(np.int32)), "key": part.column("key").take(rows)}))
    return pa.concat_tables(tables)


def _keys(index_only: bool):
    """Key, line, and whether the line is an index entry under that key, without repeats."""

    def work(batch: pa.RecordBatch) -> pa.Table:
        tables = []
        for part in text_slices(batch, "content"):
            body, starts = text_bytes(part.column("content"))
            _, _, lo, hi = cut_lines(body, starts)
            node = _node(_digests(body, lo, hi))
            found = [(key, node[line], np.full(len(line), entry)) for line, key, entry in line_keys(body, lo, hi) if entry or not index_only]
            key, line, entry = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((~entry, line, key))  # an entry comes before a probe with the same key
            key, line, entry = key[order], line[order], entry[order]
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1])
            tables.append(pa.table({"key": key[fresh], "node": line[fresh], "entry": pa.array(entry[fresh])}))
        return pa.concat_tables(tables)

    return work


def _cut(batch: pa.RecordBatch) -> pa.Table:
    """The lines that are asked for, with their text, length and counts of byte classes (16 bytes)."""
    node, line, counts = [], [], []
    for text, wanted in zip(batch.column("content").to_pylist(), batch.column("wanted").to_pylist()):
        lines = text.encode().split(b"\n")
        for w in wanted:
            data = lines[w["n"]].strip(_WHITE)
            node.append(w["node"])
            line.append(data)
            kinds = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=CLASSES)
            counts.append(kinds.astype(np.uint8).tobytes())
    out = {"node": pa.array(node, pa.int64()), "line": pa.array(line, pa.binary())}
    return pa.table(out | {"size": pa.array([len(x) for x in line], pa.int32()), "counts": pa.array(counts, pa.binary())})


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a block whose lengths and counts of byte classes allow EDITS edits."""
    for table in whole_groups(batches, "part"):
        part, node, size, entry = (table.column(c).to_numpy() for c in ("part", "node", "size", "entry"))
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8).reshape(-1, CLASSES).astype(np.int16)
        found = [np.zeros((0, 2), np.int64)]
        edges = runs(part)
        for begin, end in zip(edges, edges[1:]):
            fixed = begin + np.flatnonzero(entry[begin:end])
            for x in begin + np.flatnonzero(~entry[begin:end]):
                # counts are modulo 256: the shorter way round is a lower bound of the difference
                apart = np.abs(counts[fixed] - counts[x])
                near = np.minimum(apart, 256 - apart).sum(1) <= 2 * EDITS
                other = node[fixed[near & (np.abs(size[fixed] - size[x]) <= EDITS) & (node[fixed] != node[x])]]
                mine = np.full(len(other), node[x])
                found.append(np.stack([np.minimum(mine, other), np.maximum(mine, other)], 1))
        pairs = np.unique(np.concatenate(found), axis=0)
        yield pa.record_batch({"a": pairs[:, 0].copy(), "b": pairs[:, 1].copy()})


def _verify(batch: pa.RecordBatch) -> pa.Table:
    sides = (batch.column(c).to_pylist() for c in ("line_a", "line_b"))
    kept = pa.array([edit_distance(x, y, EDITS) <= EDITS for x, y in zip(*sides)], pa.bool_())
    return pa.table({"a": batch.column("a"), "b": batch.column("b")}).filter(kept)


def varying_cuts(lines: list[bytes]) -> tuple[int, int]:
    """Where lines of one length are cut so that each of the three segments has about as much that varies."""
    table = np.frombuffer(b"".join(lines), np.uint8).reshape(len(lines), -1)
    kinds = np.array([len(np.unique(column)) for column in table.T])
    length, weight = len(kinds), np.cumsum(np.log(kinds) + 1e-9)
    first, second = (int(np.searchsorted(weight, weight[-1] * share / (EDITS + 1))) + 1 for share in (1, 2))
    first = min(max(first, 1), length - 2)
    return first, min(max(second, first + 1), length - 1)


def _cuts(batch: pa.RecordBatch) -> pa.Table:
    found = [varying_cuts(lines) for lines in batch.column("shown").to_pylist()]
    first, second = (pa.array(x, pa.int32()) for x in zip(*found))
    return pa.table({"key": batch.column("key"), "first": first, "second": second})


def second_keys(line: bytes, entry: bool, longer: int, cuts: tuple[int, int], key: int) -> dict[int, bool]:
    """The keys of a line among those of its first key, and whether it is an entry there.

    The line is `longer` bytes longer than the entries, which are cut at `cuts`. Any cut into EDITS + 1
    segments will do: the substrings that are probed are those of `line_keys`.
    """
    places = (0, *cuts, len(line) - longer)
    found: dict[int, bool] = {}
    for number in range(EDITS + 1):
        begin, size = places[number], places[number + 1] - places[number]
        for shift in range(max(-number, longer - EDITS + number), min(number, longer + EDITS - number) + 1):
            at = begin + shift
            if at >= 0 and at + size <= len(line):
                code = xxhash.xxh3_64_intdigest(line[at : at + size], (key * (EDITS + 1) + number) % (1 << 64))
                code -= (code >> 63) << 64
                found[code] = found.get(code, False) or (entry and shift == 0)
    return found


def _second_keys(batch: pa.RecordBatch) -> pa.Table:
    keys, nodes, entries = [], [], []
    columns = (batch.column(c).to_pylist() for c in ("key", "node", "entry", "line", "length", "first", "second"))
    for key, node, entry, line, length, first, second in zip(*columns):
        if first is None:
            first, second = length // 3, 2 * length // 3
        found = second_keys(line, entry, len(line) - length, (first, second), key)
        keys += found
        nodes += [node] * len(found)
        entries += found.values()
    return pa.table({"key": pa.array(keys, pa.int64()), "node": pa.array(nodes, pa.int64()), "entry": pa.array(entries, pa.bool_())})


def _refined(crowd: DataFrame, lines: DataFrame) -> DataFrame:
    """Crowded keys and their lines once more, by segments that share out what varies.

    Entries of a key have one length. A bounded number of them, chosen by a hash, decides where they are
    cut, which is a matter of speed alone.
    """
    rows = by_shuffle(crowd, lines.select("node", "line", "size"), "node")
    counts = rows.where("entry").groupBy("key").agg(F.count(F.lit(1)).alias("entries"), F.max("size").alias("length"))
    rows = rows.join(counts, "key")
    some = F.pmod(F.xxhash64("node", F.lit(5)), F.ceil(F.col("entries") / SHOWN)) == 0
    shown = rows.where(F.col("entry") & some).groupBy("key").agg(F.collect_list("line").alias("shown"))
    cuts = shown.mapInArrow(by_batch(_cuts), "key long, first int, second int")
    placed = rows.join(cuts, "key", "left").select("key", "node", "entry", "line", "length", "first", "second")
    return placed.mapInArrow(by_batch(_second_keys), "key long, node long, entry boolean")


def _candidates(hits: DataFrame, lines: DataFrame) -> DataFrame:
    """Pairs of lines that meet at a key: one index entry directly, several in blocks of BLOCK x BLOCK rows.

    Keys with CROWD entries or more are replaced by those of a second cut first.
    """
    single = hits.where("lo = hi").select(F.least("node", "lo").alias("a"), F.greatest("node", "lo").alias("b"))
    crowd = hits.where("lo < hi").select("key", "node", "entry")
    large = written(crowd.groupBy("key").agg(F.count_if("entry").alias("entries")).where(F.col("entries") >= CROWD).select("key"), "lines")
    refined = _refined(crowd.join(large, "key", "left_semi"), lines)
    crowd = written(crowd.join(large, "key", "left_anti").unionByName(refined), "lines")
    counts = crowd.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if("entry").alias("entries"))
    counts = counts.select("key", *[F.ceil(F.col(c) / BLOCK).cast("int").alias(c) for c in ("n", "entries")])
    crowd = by_shuffle(crowd, counts.where("entries > 0"), "key")
    spread = F.xxhash64("node", F.lit(3))
    probe = crowd.select("key", "node", F.lit(False).alias("entry"), F.pmod(spread, "n").alias("j"), F.explode(F.expr("sequence(0L, entries - 1L)")).alias("i"))
    fixed = crowd.where("entry").select("key", "node", "entry", F.explode(F.expr("sequence(0L, n - 1L)")).alias("j"), F.pmod(spread, "entries").alias("i"))
    blocks = probe.unionByName(fixed).select("node", "entry", F.xxhash64("key", "i", "j").alias("part"))
    blocks = blocks.join(lines.select("node", "size", "counts"), "node")
    met = blocks.repartition("part").sortWithinPartitions("part").mapInArrow(_meet, "a long, b long")
    return single.unionByName(met).distinct()


def row_key(number: Column, text: Column) -> Column:
    """Names a row by its id and text; rows that agree in both are one document."""
    return F.unhex(F.md5(F.concat(F.coalesce(number.cast("string"), F.lit("-")), F.lit(":"), text)))


def _rebuilt(batch: pa.RecordBatch) -> pa.Table:
    out = {c: [] for c in ("n_lines", "n_dropped", "n_links", "first_ids", "text")}
    for text, marks in zip(batch.column("content").to_pylist(), batch.column("marks").to_pylist()):
        lines = text.split("\n")
        marks = {m["n"]: m for m in marks or []}
        gone = {n: m["first_id"] for n, m in marks.items() if m["dropped"]}
        out["n_lines"].append(len(lines))
        out["n_dropped"].append(len(gone))
        out["n_links"].append(sum(m["links"] for m in marks.values()))
        out["first_ids"].append(sorted({i for i in gone.values() if i is not None}))
        out["text"].append("\n".join(x for n, x in enumerate(lines) if n not in gone))
    longs = {c: pa.array(out[c], pa.int64()) for c in ("n_lines", "n_dropped", "n_links")}
    lists = {"first_ids": pa.array(out["first_ids"], pa.list_(pa.int64())), "text": pa.array(out["text"], pa.string())}
    return pa.table({"key": batch.column("key"), "id": batch.column("id")} | longs | lists)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`key, id, n_lines, n_dropped, n_links, first_ids, text`: every row without the lines that came before.

    A line is dropped if an equal line, or one within EDITS byte edits of it, occurs earlier in order of
    (id, line number); null ids come first. White space at its ends is not compared, and lines of less
    than LEAST_BYTES bytes are left alone. `n_links` counts, for the row's judged lines, the different
    lines within EDITS edits; `first_ids` are the ids of the rows that hold the earliest of the lines that
    dropped ones repeat. Null and empty texts have one empty line. Rows that repeat id and text are one
    document: what one keeps, all keep. `key` names id and text. An empty table gives an empty result;
    other columns are not read.

    Equal lines are reduced to one before they are joined. The lines of a key with many entries are cut a
    second time and meet only if they agree there too; those that still share a key are compared in blocks,
    from which only pairs leave whose byte counts allow so few edits.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), whole_text(text_col).alias("content"))
    rows = rows.select("id", "content", row_key(F.col("id"), F.col("content")).alias("key"))
    lines = written(rows.mapInArrow(by_batch(_occurrences), "digest binary, node long, id long, n int, key binary"), "lines")
    place = F.struct("id", "n", "key")
    kinds = lines.groupBy("digest", "node").agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("copies"))
    kinds = written(kinds, "lines")

    kind = "key long, node long, entry boolean"
    entries = rows.mapInArrow(by_batch(_keys(True)), kind)
    index = entries.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
    probes = rows.mapInArrow(by_batch(_keys(False)), kind)
    hits = written(by_shuffle(probes, index, "key").where("lo <> node or hi <> node").distinct(), "lines")

    nodes = hits.select("node").unionByName(hits.where("lo = hi").select(F.col("lo").alias("node"))).distinct()
    wanted = kinds.join(nodes, "node").groupBy("place.key").agg(F.collect_list(F.struct("node", "place.n")).alias("wanted"))
    texts = rows.join(wanted, "key").select("content", "wanted")
    texts = texts.mapInArrow(by_batch(_cut), "node long, line binary, size int, counts binary")
    texts = written(texts.dropDuplicates(["node", "line"]), "lines")

    pairs = _candidates(hits, texts)
    for side in "ab":
        pairs = pairs.join(texts.select(F.col("node").alias(side), F.col("line").alias(f"line_{side}")), side)
    links = written(pairs.select("a", "b", "line_a", "line_b").mapInArrow(by_batch(_verify), "a long, b long"), "lines")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = by_shuffle(both, kinds.select(F.col("node").alias("b"), F.col("place").alias("other")), "b")
    near = near.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("links"), F.min("other").alias("other"))
    marks = kinds.join(near, "node", "left").where("copies > 1 or links > 0").select(
        "digest", "links", F.least("place", F.coalesce("other", "place")).alias("first")
    )
    found = by_shuffle(lines, marks, "digest").select(
        "key",
        F.struct(
            "n",
            F.coalesce("links", F.lit(0)).alias("links"),
            (~place.eqNullSafe(F.col("first"))).alias("dropped"),
            F.col("first.id").alias("first_id"),
        ).alias("mark"),
    )
    # rows that repeat id and text bring the same marks: a set is bounded by the lines of one text
    found = found.groupBy("key").agg(F.collect_set("mark").alias("marks"))
    joined = rows.join(found, "key", "left").select("key", "id", "content", "marks")
    columns = "key binary, id long, n_lines long, n_dropped long, n_links long, first_ids array<long>, text string"
    return joined.mapInArrow(by_batch(_rebuilt), columns)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(read_table(session(spark), sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", "n_links", "first_ids", F.sha2("text", 256).alias("text_sha256")
    )
