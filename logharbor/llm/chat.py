"""Chat transcripts: roles of lines by a hidden Markov model, and canonical turns.

A state is a role together with whether a line begins a turn or continues one. A line shows a speaker
marker or none, whether a blank line comes before it, its length and whether it asks. The best path is
found by Viterbi over blocks of lines: a block is a matrix of best scores from each state before it to
each state at its end, so a long transcript is worked on by many tasks. Blocks are cut by the position
of lines in their transcript, so none has more than its number of lines, whatever the turn numbers; the
matrices are combined in a tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logharbor.llm.common import read_table, runs, session, whole_groups, whole_text, written
from logharbor.llm.folds import held_out

ROLES = ("system", "user", "assistant")
#: Speaker names by role, as they stand at the head of a line.
SPEAKERS = {
    "system": "system|instructions?|context",
    "user": "user|human|customer|question|q|prompter|me",
    "assistant": "assistant|ai|bot|model|answer|a|agent",
}
#: Begin of a turn of each role, then continuation of each.
STATES = tuple((role, begins) for begins in (True, False) for role in ROLES)
N = len(STATES)
#: Lines of one block, and so the most turns that it can hold.
BLOCK_TURNS = 1000
#: Neighbouring blocks of a transcript that are combined to one piece at a time.
FAN = 1024
#: Line lengths are told apart at these numbers of characters.
LENGTHS = (0, 20, 80, 240)
#: Log probabilities are whole numbers of this part, so that sums are exact in any order.
UNIT = 10_000
#: What counting starts from, so that nothing is impossible.
PSEUDO = 0.5
IMPOSSIBLE = -(1 << 50)


def marker_pattern(role: str) -> str:
    return rf"(?i)^\s*(?:#+\s*|\*\*|<\|?|\[)?(?:{SPEAKERS[role]})(?:\|?>|\]|\*\*)?\s*:\s*|^\s*<\|?(?:{SPEAKERS[role]})\|?>\s*"


def with_signs(lines: DataFrame) -> DataFrame:
    """Lines (column `line`, column `blank` from the table) with what the model sees of each, and the length of the marker."""
    marker = F.lit(0)
    for k, role in enumerate(ROLES, 1):
        marker = F.when(F.col("line").rlike(marker_pattern(role)), F.lit(k)).otherwise(marker)
    bare = F.col("line")
    for k, role in enumerate(ROLES, 1):
        bare = F.when(F.col("marker") == k, F.regexp_replace("line", marker_pattern(role), "")).otherwise(bare)
    length = sum((F.char_length("line") > edge).cast("int") for edge in LENGTHS)
    asks = F.trim("line").endswith("?")
    sign = ((F.col("marker") * 2 + F.col("blank").cast("int")) * (len(LENGTHS) + 1) + length) * 2 + asks.cast("int")
    head = F.char_length("line") - F.char_length(bare)
    return lines.withColumn("marker", marker).withColumns({"head": head, "sign": sign.cast("int")})


SIGNS = (len(ROLES) + 1) * 2 * (len(LENGTHS) + 1) * 2


class Model:
    """Scores as whole numbers: of a line's state after the one before it (the last row: of the first line), and of its sign."""

    def __init__(self, first: np.ndarray, step: np.ndarray, seen: np.ndarray):
        def logs(counts: np.ndarray) -> np.ndarray:
            return np.rint(UNIT * np.log((counts + PSEUDO) / (counts + PSEUDO).sum(-1, keepdims=True))).astype(np.int64)

        self.step, self.seen = np.concatenate([logs(step), logs(first)[None]]), logs(seen)
        for k, (role, begins) in enumerate(STATES):
            if not begins:  # a turn is continued in its own role only, and nothing is before the first line
                self.step[N, k] = IMPOSSIBLE
                for j, (before, _) in enumerate(STATES):
                    if before != role:
                        self.step[j, k] = IMPOSSIBLE

    def paths(self, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """From each state before some lines (the last: none) to each state of the last line: the best score and
        the line where its open turn began (-1: before); and for each later line the state before it.

        Of equal scores the first state wins.
        """
        best = self.step + self.seen[:, signs[0]]
        begun = np.where(OPENS, 0, -1) * np.ones((N + 1, 1), np.int64)
        back = np.zeros((len(signs), N + 1, N), np.int8)
        for k, sign in enumerate(signs[1:], 1):
            reach = best[:, :, None] + self.step[None, :N]
            back[k] = came = reach.argmax(1)
            best = np.maximum(np.take_along_axis(reach, came[:, None], 1)[:, 0], IMPOSSIBLE) + self.seen[:, sign]
            begun = np.where(OPENS, k, np.take_along_axis(begun, came, 1))
        return best, begun, back


OPENS = np.array([begins for _, begins in STATES])


def train(lines: DataFrame) -> Model:
    """Counts over all lines with a role outside the held-out fold.

    The counts have as many rows as there are combinations of signs and states, whatever the input.
    Without such lines every possible path is equally likely.
    """
    known = lines.where(~held_out("conv") & F.col("role").isin(*ROLES))
    first, step, seen = np.zeros(N), np.zeros((N, N)), np.zeros((N, SIGNS))
    state = {key: k for k, key in enumerate(STATES)}
    for role, begins, sign, n in known.groupBy("role", (F.col("line_no") == 0).alias("begins"), "sign").count().collect():
        seen[state[role, begins], sign] += n
    turns = known.groupBy("conv", "turn", "role").agg(F.count(F.lit(1)).alias("n"))
    for role, more, n, inner in turns.groupBy("role", (F.col("n") > 1).alias("more")).agg(F.count(F.lit(1)), F.sum("n")).collect():
        if more:
            step[state[role, True], state[role, False]] += n
            step[state[role, False], state[role, False]] += inner - 2 * n
    turns = turns.groupBy("conv", "turn").agg(F.min(F.struct("role", "n")).alias("one"))
    after = turns.select("conv", (F.col("turn") - 1).alias("turn"), F.col("one.role").alias("next"))
    pairs = turns.join(after, ["conv", "turn"]).groupBy("one.role", (F.col("one.n") == 1).alias("single"), "next").count()
    for role, single, following, n in pairs.collect():
        step[state[role, single], state[following, True]] += n
    for role, n in turns.where("turn = 0").groupBy("one.role").count().collect():
        first[state[role, True]] += n
    return Model(first, step, seen)


def _blocks(shipped):
    """Per block the scores and open turns of its paths, by state before it and state at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "block"):
            sign, turn, line = (table.column(c).to_numpy() for c in ("sign", "turn", "line_no"))
            edges, out = _edges(table), []
            for begin, end in zip(edges, edges[1:]):
                best, begun, _ = shipped.value.paths(sign[begin:end])
                at = begin + np.maximum(begun, 0)
                out.append([x.ravel().tolist() for x in (best, begun, turn[at], line[at])])
            heads = pa.array(edges[:-1])
            kept = {c: table.column(c).combine_chunks().take(heads) for c in ("block", "conv", "nth")}
            columns = (pa.array(x, pa.list_(pa.int64())) for x in zip(*out))
            yield pa.RecordBatch.from_pydict(kept | dict(zip(("scores", "begun", "turns", "lines"), columns)))

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order with the lines before them in their transcript, within the partition."""
    last, total = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes, names = batch.column("size").to_numpy(), batch.column("name").to_pylist()
        sums = np.cumsum(sizes) - sizes
        codes = batch.column("name").dictionary_encode().indices.to_numpy()
        edges = runs(codes)
        begins = np.repeat(sums[edges[:-1]], np.diff(edges))
        begin = sums - begins
        if names[0] == last:
            begin[: edges[1]] += total
        last, total = names[-1], int(begin[-1] + sizes[-1])
        columns = {c: batch.column(c) for c in ("conv", "turn", "role", "tie", "part", "size")}
        yield pa.RecordBatch.from_pydict(columns | {"begin": pa.array(begin, pa.int64())})


def positions(lines: DataFrame) -> DataFrame:
    """For each row (conv, turn, role, tie) of the transcripts the lines before it in its transcript, `begin`.

    Rows are dealt out in order, so a transcript of any length, also one with a single turn number, is
    counted by many tasks; the sums of a transcript's parts are at most as many as there are tasks.
    """
    name = F.coalesce(F.col("conv").cast("string"), F.lit("-"))
    rows = lines.where("line_no = 0").select("conv", "turn", "role", "tie", F.col("of").cast("long").alias("size"), name.alias("name"))
    order = ["conv", "turn", "role", "tie"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    kind = "conv long, turn long, role string, tie string, part int, size long, begin long"
    counted = written(dealt.mapInArrow(_counted, kind), "chat")
    sums = counted.groupBy("conv", "part").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(F.col("conv").alias("c"), F.col("part").alias("p"), F.coalesce(before, F.lit(0)).alias("earlier"))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
    return counted.join(sums, same).select(*order, (F.col("begin") + F.col("earlier")).alias("begin"))


def _edges(table: pa.Table) -> np.ndarray:
    return runs(table.column("block").combine_chunks().dictionary_encode().indices.to_numpy())


def _followed(table: pa.Table) -> Iterator[tuple]:
    """For each group of neighbouring pieces: where it stands in the table, and its paths from every state before it.

    `totals` has the best score of each (state before, state at the end); `came`, piece by piece, the state
    before the piece on that path; `opened` the turn and line where the path's open turn began, -1 if before.
    """
    edges = runs(table.column("group").combine_chunks().dictionary_encode().indices.to_numpy())
    size = (-1, N + 1, N)
    scores, begun, turns, lines = (np.array(table.column(c).to_pylist(), np.int64).reshape(size) for c in ("scores", "begun", "turns", "lines"))
    for begin, end in zip(edges, edges[1:]):
        totals, came = scores[begin], []
        opened = np.stack([begun[begin], turns[begin], lines[begin]])
        for k in range(begin + 1, end):
            reach = totals[:, :, None] + scores[k][None, :N]
            before = reach.argmax(1)
            came.append(before)
            totals = np.maximum(np.take_along_axis(reach, before[:, None], 1)[:, 0], IMPOSSIBLE)
            earlier = np.stack([np.take_along_axis(o, before, 1) for o in opened])
            here = np.stack([x[k][before, np.arange(N)] for x in (begun, turns, lines)])
            opened = np.where(here[0] >= 0, here, earlier)
        yield begin, end, totals, came, opened, (begun, turns, lines)


def _product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring pieces of a transcript as one piece."""
    for table in whole_groups(batches, "group"):
        heads, out = [], []
        for begin, _, totals, _, opened, _ in _followed(table):
            heads.append(begin)
            out.append([x.ravel().tolist() for x in (totals, *opened)])
        kept = {c: table.column(c).combine_chunks().take(pa.array(heads)) for c in ("name", "up")}
        columns = [pa.array(x, pa.list_(pa.int64())) for x in zip(*out)]
        yield pa.RecordBatch.from_arrays([*kept.values(), *columns], ["name", "nth", "scores", "begun", "turns", "lines"])


def _handed_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state before and at the end of each piece, and its open turn, from those of the group of pieces."""
    for table in whole_groups(batches, "group"):
        given = {c: table.column(c).to_pylist() for c in ("enters", "leaves", "open_turn", "open_line")}
        out = {c: [] for c in given}
        for begin, end, _, came, _, (begun, turns, lines) in _followed(table):
            first = given["enters"][begin]
            leaves = [given["leaves"][begin]]
            for before in came[::-1]:
                leaves.append(int(before[first, leaves[-1]]))
            enters, opened = first, (given["open_turn"][begin], given["open_line"][begin])
            for k, leave in zip(range(begin, end), leaves[::-1]):
                for c, value in zip(out, (enters, leave, *opened)):
                    out[c].append(value)
                if begun[k][enters, leave] >= 0:
                    opened = (int(turns[k][enters, leave]), int(lines[k][enters, leave]))
                enters = leave
        kept = [table.column(c).combine_chunks() for c in ("name", "nth")]
        yield pa.RecordBatch.from_arrays([*kept, *(pa.array(x, pa.int64()) for x in out.values())], ["name", "nth", *out])


def _top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole transcripts: nothing before them, and the state at the end with the best score."""
    for batch in batches:
        scores = np.array(batch.column("scores").to_pylist(), np.int64).reshape(-1, N + 1, N)
        n, none = len(scores), pa.nulls(len(scores), pa.int64())
        columns = [batch.column("name"), batch.column("nth"), pa.array(np.full(n, N)), pa.array(scores[:, N].argmax(1)), none, none]
        yield pa.RecordBatch.from_arrays(columns, ["name", "nth", "enters", "leaves", "open_turn", "open_line"])


def chained(blocks: DataFrame) -> DataFrame:
    """`name, nth, enters, leaves, open_turn, open_line` of each block on the best path of its transcript.

    Products of max-plus matrices are associative: FAN neighbouring pieces of a transcript are combined to
    one piece, level by level, until each transcript is one. Its state at the end is then handed down the
    same levels. A task holds FAN pieces of a transcript at a time, however long it is.
    """
    lists = ", ".join(f"{c} array<bigint>" for c in ("scores", "begun", "turns", "lines"))
    states = "name string, nth long, enters long, leaves long, open_turn long, open_line long"

    def grouped(pieces: DataFrame) -> DataFrame:
        pieces = pieces.withColumn("up", F.floor(F.col("nth") / FAN))
        return pieces.withColumn("group", F.concat_ws(":", "name", F.col("up").cast("string")))

    def sorted_by_group(pieces: DataFrame) -> DataFrame:
        return pieces.repartition("group").sortWithinPartitions("group", "nth")

    levels = [written(blocks, "chat")]
    while (levels[-1].agg(F.max("nth")).first()[0] or 0) > 0:
        combined = sorted_by_group(grouped(levels[-1])).mapInArrow(_product, f"name string, nth long, {lists}")
        levels.append(written(combined, "chat"))
    found = levels[-1].mapInArrow(_top, states)
    for level in levels[-2::-1]:
        above = written(found, "chat").withColumnsRenamed({"name": "of", "nth": "at"})
        pieces = grouped(level)
        below = pieces.join(above, (F.col("name") == F.col("of")) & (F.col("up") == F.col("at"))).drop("of", "at")
        found = sorted_by_group(below).mapInArrow(_handed_down, states)
    return found


def _read_off(shipped):
    """The turns of each block on its best path; a turn that began in an earlier block keeps its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "block"):
            sign = table.column("sign").to_numpy()
            rows = {c: table.column(c).to_pylist() for c in ("conv", "turn", "line_no", "role", "line", "marker", "head", "empties", "enters", "leaves", "open_turn", "open_line")}
            edges, out = _edges(table), []
            for begin, end in zip(edges, edges[1:]):
                enters, state = rows["enters"][begin], rows["leaves"][begin]
                back = shipped.value.paths(sign[begin:end])[2][:, enters]
                states = [state]
                for came in back[:0:-1]:
                    states.append(state := int(came[state]))
                states = states[::-1]
                cuts = [k for k, s in enumerate(states) if k == 0 or OPENS[s]] + [end - begin]
                for a, b in zip(cuts, cuts[1:]):
                    role, opens, here = *STATES[states[a]], range(begin + a, begin + b)
                    place = (rows["turn"][begin + a], rows["line_no"][begin + a]) if opens else (rows["open_turn"][begin], rows["open_line"][begin])
                    shown = [rows["line"][k] + "\n" * rows["empties"][k] for k in here]
                    if opens and rows["marker"][here[0]] == ROLES.index(role) + 1:
                        shown[0] = shown[0][rows["head"][here[0]] :]
                    apart = [rows["line_no"][k] == 0 and rows["turn"][k] > 0 and (k > here[0] or not opens) for k in here]
                    text = "\n".join("\n" * a + x for a, x in zip(apart, shown))
                    right = sum(rows["role"][k] == role for k in here)
                    out.append((rows["conv"][begin], *place, rows["turn"][here[0]], rows["line_no"][here[0]], opens, role, len(here), right, text))
            yield pa.RecordBatch.from_pylist([dict(zip(TURN.names, row)) for row in out], TURN)

    return run


TURN = pa.schema(
    [("conv", pa.int64()), *[(c, pa.int64()) for c in ("start_turn", "start_line", "turn", "line_no")], ("opens", pa.bool_())]
    + [("role", pa.string()), ("n_lines", pa.int64()), ("n_right", pa.int64()), ("text", pa.string())]
)
_TURN = "conv long, start_turn long, start_line long, turn long, line_no long, opens boolean, role string, n_lines long, n_right long, text string"


def recover_turns(lines: DataFrame, model: Model) -> DataFrame:
    """Turns of each transcript by the best path: where a turn starts, its role, and its text without its marker.

    `lines` comes from `with_signs` of `transcript_lines`; role is that of the source and may be null. Only a line that opens a turn loses its marker, and only one that names the turn's
    role; all else of the text stays, empty lines too. A turn that crosses a block is given in pieces with the same start; the first one opens it.
    `n_right` counts the lines whose role in the source is the recovered one. A transcript without lines
    has no turns. Rows of one turn number, or without one, may be any number: blocks count lines.
    """
    shipped = lines.sparkSession.sparkContext.broadcast(model)  # a few KB
    keys = ["conv", "turn", "role", "tie"]
    begins = positions(lines).withColumnsRenamed({c: f"of_{c}" for c in keys})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in keys])
    nth = F.floor((F.col("begin") + F.col("k")) / BLOCK_TURNS)
    name = F.coalesce(F.col("conv").cast("string"), F.lit("-"))
    lines = lines.join(begins, same).withColumn("nth", nth)
    lines = lines.withColumn("block", F.concat_ws(":", name, F.col("nth").cast("string")))
    order = ["block", "turn", "role", "tie", "line_no"]
    ordered = lines.repartition("block").sortWithinPartitions(*order)
    lists = ", ".join(f"{c} array<bigint>" for c in ("scores", "begun", "turns", "lines"))
    blocks = ordered.select("block", "conv", "nth", "turn", "line_no", "sign").mapInArrow(
        _blocks(shipped), f"block string, conv long, nth long, {lists}"
    )
    states = chained(blocks.select(name.alias("name"), "nth", "scores", "begun", "turns", "lines"))
    states = states.withColumn("block", F.concat_ws(":", "name", F.col("nth").cast("string"))).drop("name", "nth")
    placed = lines.join(written(states, "chat"), "block").repartition("block").sortWithinPartitions(*order)
    columns = ("block", "conv", "turn", "line_no", "role", "line", "marker", "head", "empties", "sign", "enters", "leaves", "open_turn", "open_line")
    return placed.select(*columns).mapInArrow(_read_off(shipped), _TURN)


def rendered(turns: DataFrame) -> DataFrame:
    """Turns with their canonical form: a role tag on its own line where the turn opens, then the text."""
    head = F.when(F.col("opens"), F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"))).otherwise(F.lit(""))
    return turns.withColumn("rendered", F.concat(head, "text", F.lit("\n")))


def transcript_lines(conversations: DataFrame) -> DataFrame:
    """The lines of each conversation as one transcript, with the role of the source for training and checking.

    Rows that repeat all of conversation, turn, role and text are one row; rows that share a turn number
    are ordered by role and a digest of their text. A null conversation id is one transcript, a
    null turn comes first, a null text is empty. A turn begins with a speaker marker in one of four
    styles, or, for a quarter of the turns, with none; turns are set apart by blank lines. An empty line
    is not a line of its own, unless it is the first of its row: `empties` counts those after a line.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv"), F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
        F.col("role").cast("string").alias("role"), whole_text("text").alias("text"),
    ).distinct()
    speaker = F.initcap("role")
    styles = [F.concat(speaker, F.lit(": ")), F.concat(F.lit("### "), speaker, F.lit(": ")), F.concat(F.lit("<|"), "role", F.lit("|> ")), F.concat(F.lit("**"), speaker, F.lit("**: "))]
    style = F.element_at(F.array(*styles), (F.pmod(F.xxhash64("conv"), F.lit(4)) + 1).cast("int"))
    plain = F.col("role").isNull() | (F.pmod(F.xxhash64("conv", "turn"), F.lit(4)) == 0)
    text = F.concat(F.when(plain, F.lit("")).otherwise(style), "text")
    split = rows.select("conv", "turn", "role", F.md5("text").alias("tie"), F.split(text, "\n").alias("all"))
    full = F.expr("filter(sequence(0, size(all) - 1), i -> i = 0 or all[i] <> '')")
    held = "line_no, all[line_no] as line, coalesce(get(full, k + 1), size(all)) - line_no - 1 as empties, line_no > 0 and get(all, line_no - 1) = '' as parted, k, size(full) as of"
    lines = split.withColumn("full", full).selectExpr(
        "conv", "turn", "role", "tie", f"inline(transform(full, (line_no, k) -> struct({held})))"
    )
    before = F.when(F.col("line_no") > 0, F.col("parted")).otherwise(F.col("turn") > 0)
    return lines.withColumn("blank", before).drop("parted")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = with_signs(transcript_lines(read_table(session(spark), sf_dir, "conversations")))
    turns = rendered(recover_turns(lines, train(lines)))
    return turns.select(
        F.col("conv").alias("conv_id"), "start_turn", "start_line", "turn", "line_no", "opens", "role", "n_lines", "n_right",
        F.sha2("rendered", 256).alias("rendered_sha256"),
    )
