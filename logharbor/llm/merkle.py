"""Merkle manifest of a table: a digest per row, a tree per group, one root over all groups, and proofs.

The leaves of a group are cut into aligned blocks of `block` leaves, and a task hashes the subtree of a
block. Above the blocks, a butterfly exchange takes the place of passes up and down: in round r the blocks
of `fanout` neighbouring subtrees that stand at the same place within their subtree swap the roots of
these, and each of them hashes the common parent for itself. So every block follows the roots on its own
path and collects the siblings for its proofs on the way, and none is sent down again. The last subtree of
a group may have fewer blocks than the others; its blocks then stand in for the places that it lacks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logharbor.functions.blocks import running_number
from logharbor.llm.common import by_batch, hand_back, written

#: Nodes that are hashed to one parent.
FANOUT = 2
#: Leaves that one task hashes at a time; a power of the fanout.
BLOCK = 1024
#: Rounds of the exchange after which the state is written.
ROUNDS_KEPT = 8
#: What names a document's fields in a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: One leaf in so many is tampered with by the query.
TAMPERED = 7

_STEP = "struct<before:array<string>,after:array<string>>"
_PROOF = pa.list_(pa.struct([("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))]))


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """The digest of a row: each field as its number of UTF-8 bytes, a colon and itself, `-` where it is null."""
    texts = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def subtree(leaves: list[str], fanout: int, height: int | None) -> list[list[str]]:
    """The levels of a tree from its leaves up: `height` levels above them, or as many as leave one node."""
    levels = [leaves]
    while len(levels) - 1 < height if height is not None else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(below[k : k + fanout]) for k in range(0, len(below), fanout)])
    return levels


def steps_of(levels: list[list[str]], place: int, fanout: int) -> list[tuple[list[str], list[str]]]:
    """The other nodes of a leaf's run on each level below the top, those before and those after it."""
    steps = []
    for nodes in levels[:-1]:
        begin = place - place % fanout
        steps.append((nodes[begin:place], nodes[place + 1 : begin + fanout]))
        place //= fanout
    return steps


def fold(leaf: str, steps: list[tuple[list[str], list[str]]]) -> str:
    """The root that a leaf and the siblings on its path lead to."""
    for before, after in steps:
        leaf = digest([*before, leaf, *after])
    return leaf


def exchange(state: DataFrame, fanout: int, last: int) -> DataFrame:
    """The root of each tree at every one of its blocks, and the steps that lead there.

    `state` has tree, block (0, 1, ...), root and steps. `last` is the largest block of any tree, which
    decides how many rounds there are. Each round is one shuffle in which at most `fanout` rows meet.
    """
    state, width, rounds = state.withColumn("size", F.lit(1).cast("long")), 1, 0
    while width <= last:
        number = F.col("block")
        inside, digit = F.pmod(number, F.lit(width)), F.pmod(F.floor(number / width), F.lit(fanout))
        # a subtree that lacks blocks gives the places after it the root by turns
        places = F.when(
            (F.col("size") < width) & (digit > 0), F.sequence(inside, F.lit(width - 1).cast("long"), F.col("size"))
        ).otherwise(F.array(inside))
        sent = state.select("*", digit.alias("digit"), F.posexplode(places).alias("copy", "place"))
        member = F.struct(
            "digit", "root", "size", (F.col("copy") == 0).alias("own"), "block", F.when(F.col("copy") == 0, F.col("steps")).alias("steps")
        )
        group = F.floor(F.col("block") / (width * fanout)).alias("group")
        met = sent.groupBy("tree", group, "place").agg(
            F.array_sort(F.collect_list(member), lambda a, b: (a["digit"] - b["digit"]).cast("int")).alias("members")
        )
        # the one subtree of a tree is its root; any other run without siblings is hashed alone
        single = (F.col("group") == 0) & (F.size("members") == 1)
        parent = F.when(single, F.col("members")[0]["root"]).otherwise(
            F.sha2(F.array_join(F.transform("members", lambda m: m["root"]), ""), 256)
        )
        size = F.aggregate("members", F.lit(0).cast("long"), lambda total, m: total + m["size"])
        met = met.select("tree", "members", single.alias("single"), parent.alias("root"), size.alias("size"))
        met = met.select("*", F.explode(F.filter("members", lambda m: m["own"])).alias("me"))

        def roots(side: Callable[[Column], Column]) -> Column:
            return F.transform(F.filter("members", side), lambda m: m["root"])

        step = F.struct(
            roots(lambda m: m["digit"] < F.col("me.digit")).alias("before"),
            roots(lambda m: m["digit"] > F.col("me.digit")).alias("after"),
        )
        steps = F.when(F.col("single"), F.col("me.steps")).otherwise(F.concat("me.steps", F.array(step)))
        state = met.select("tree", F.col("me.block").alias("block"), "root", steps.alias("steps"), "size")
        width, rounds = width * fanout, rounds + 1
        if rounds % ROUNDS_KEPT == 0:
            state = written(state, "merkle-rounds")
    return state.drop("size")


def _block_roots(fanout: int, height: int) -> Callable:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        roots = []
        for block, leaves in zip(batch.column("block").to_pylist(), batch.column("leaves")):
            leaves = leaves.values.field("leaf").to_pylist()
            roots.append(subtree(leaves, fanout, height if block else None)[-1][0])
        return pa.record_batch({"tree": batch.column("tree"), "block": batch.column("block"), "root": pa.array(roots, pa.string())})

    return by_batch(work)


def _proved(fanout: int, height: int, proofs: bool) -> Callable:
    """Rows of a block with their proofs, folded: below the block's root from its leaves, above it as exchanged."""

    def plain(steps: list[dict]) -> list[tuple[list[str], list[str]]]:
        return [(s["before"], s["after"]) for s in steps]

    def rows_of(block: int, leaves: pa.StructArray, above: list[dict], subroot: str, root: str) -> pa.RecordBatch:
        digests, claims = leaves.field("leaf").to_pylist(), leaves.field("claimed").to_pylist()
        levels, above = subtree(digests, fanout, height if block else None), plain(above)
        beyond = "".join(x for before, after in above for x in before + after)
        proof, folded, kept = [], [], []
        for place, (leaf, claim) in enumerate(zip(digests, claims)):
            steps = steps_of(levels, place, fanout)
            proof.append(digest([x for before, after in steps for x in before + after] + [beyond]))
            folded.append(fold(claim or leaf, steps + above))
            if proofs:
                kept.append([{"before": b, "after": a} for b, a in steps + above])
        columns = [digests, [subroot] * len(digests), [root] * len(digests), proof, folded]
        arrays = [leaves.field("id"), *(pa.array(c, pa.string()) for c in columns)]
        names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"]
        if proofs:
            arrays, names = [*arrays, pa.array(kept, _PROOF)], [*names, "proof"]
        return pa.record_batch(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upper = (batch.column(c).to_pylist() for c in ("above", "subroot", "root"))
            for block, leaves, *rest in zip(batch.column("block").to_pylist(), batch.column("leaves"), *upper):
                yield rows_of(block, leaves.values, *rest)
            hand_back()

    return run


def merkle_manifest(
    rows: DataFrame,
    id_col: str,
    group_col: str,
    leaf: Column,
    claimed: Column | None = None,
    fanout: int = FANOUT,
    block: int = BLOCK,
    proofs: bool = False,
) -> DataFrame:
    """Every row with its leaf digest, the root of its group, the root of all, and what its proof folds to.

    Returns id, leaf, subroot, root, proof_sha256 (digest of the siblings from the leaf up, left to right),
    folded_root and verified (folded_root equals root); `proofs` adds the proof itself, the siblings before
    and after on each level. `leaf` is the digest of a row in hex, and `claimed` the one that is checked
    where it is not null, for instance that of a row as someone else holds it.

    Leaves of a group stand in the order of id, nulls first, equal ids in the order of their digests, so
    the result does not depend on how rows are dealt out. Groups stand in the order of the bytes of their
    name, null first. Rows repeated in all fields are leaves of their own with equal digests. An empty
    table gives an empty result. Only id, group and what the leaf reads is looked at, and texts are hashed
    in one narrow pass, never shuffled. A group of any size is cut into blocks; `block` is a power of `fanout`.
    """
    height, reach = 0, 1
    while reach < block:
        height, reach = height + 1, reach * fanout
    if reach != block or fanout < 2:
        raise ValueError("block must be a power of fanout, and fanout at least 2")
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit(""))
    nothing = F.lit(None).cast("string")
    leaves = rows.select(
        tree.alias("tree"), F.col(f"`{id_col}`").alias("id"), leaf.alias("leaf"), (nothing if claimed is None else claimed).alias("claimed")
    )
    leaves = written(leaves.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    placed = running_number(leaves, ["tree"], ["id", "leaf", "row"], "nth", least=4 * block)
    cell = F.struct("nth", "id", "leaf", "claimed")
    at = F.floor((F.col("nth") - 1) / block).alias("block")
    blocks = written(placed.groupBy("tree", at).agg(F.array_sort(F.collect_list(cell)).alias("leaves")), "merkle-blocks")

    no_steps = F.array().cast(f"array<{_STEP}>").alias("steps")
    roots = blocks.mapInArrow(_block_roots(fanout, height), "tree string, block long, root string")
    last = blocks.agg(F.max("block")).first()[0] or 0
    state = written(exchange(roots.select("*", no_steps), fanout, last), "merkle-trees")

    groups = running_number(state.where("block = 0").select("tree", "root"), [], ["tree"], "nth")
    groups = written(groups.withColumn("block", F.col("nth") - 1), "merkle-groups")
    top = groups.select(F.lit("").alias("tree"), "block", "root", no_steps)
    top = exchange(top, fanout, groups.agg(F.max("block")).first()[0] or 0)
    top = top.withColumnsRenamed({"root": "top", "steps": "last"}).drop("tree")
    upper = groups.select("tree", "block", F.col("root").alias("subroot")).join(top, "block").drop("block")

    above = state.join(upper, "tree").select("tree", "block", F.concat("steps", "last").alias("above"), "subroot", F.col("top").alias("root"))
    kind = f"id {leaves.schema['id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    found = blocks.join(above, ["tree", "block"]).mapInArrow(_proved(fanout, height, proofs), kind + (f", proof array<{_STEP}>" if proofs else ""))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_rows(docs: DataFrame) -> DataFrame:
    """The manifest of documents, in which rows with every seventh crc32 of an id claim one character more."""
    fields = [F.col(c) for c in FIELDS]
    changed = [F.col("n_chars").cast("long") + 1 if c == "n_chars" else F.col(c) for c in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    found = merkle_manifest(docs, "doc_id", "lang", leaf_digest(fields), F.when(hit, leaf_digest(changed)))
    return found.withColumnRenamed("id", "doc_id")


def _field_sql(name: str) -> str:
    value = f"cast({name} as varchar)"
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


_LEAF_SQL = " || ".join(_field_sql(c) for c in FIELDS)
_FORGED_SQL = " || ".join(_field_sql("(n_chars + 1)" if c == "n_chars" else c) for c in FIELDS)
ORACLE = f"""
with recursive table_of as (
  select i as x, (select list_reduce([i::ubigint, 0, 0, 0, 0, 0, 0, 0, 0],
      lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384::ubigint) else c // 2 end)) as v from range(256) t(i)),
crc_table as (select list(v order by x) as crcs from table_of),
rows_of as (
  select doc_id, lang, sha256({_LEAF_SQL}) as leaf, sha256({_FORGED_SQL}) as forged,
    xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(cast(doc_id as varchar), ''), lambda s: ascii(s)::ubigint)),
      lambda c, b: xor(c // 256, crcs[xor(c % 256, b)::bigint + 1])), 4294967295::ubigint) % {TAMPERED} = 0 as hit,
    row_number() over (partition by lang order by doc_id nulls first, sha256({_LEAF_SQL})) - 1 as place
  from documents, crc_table),
trees as (
  select lang, 0 as level, list(leaf order by place) as nodes from rows_of group by lang
  union all
  select lang, level + 1, list_transform(range(0, len(nodes), {FANOUT}), lambda i: sha256(array_to_string(nodes[i + 1:i + {FANOUT}], '')))
  from trees where len(nodes) > 1),
subroots as (
  select lang, nodes[1] as subroot, level as height, row_number() over (order by lang nulls first) - 1 as turn
  from trees where len(nodes) = 1),
tops as (
  select 0 as level, list(subroot order by turn) as nodes from subroots
  union all
  select level + 1, list_transform(range(0, len(nodes), {FANOUT}), lambda i: sha256(array_to_string(nodes[i + 1:i + {FANOUT}], '')))
  from tops where len(nodes) > 1),
steps as (
  select r.lang, r.place, t.level, r.place // (1 << t.level) % 2 = 0 as first,
    case when first then coalesce(t.nodes[r.place // (1 << t.level) + 2], '') else t.nodes[r.place // (1 << t.level)] end as other
  from rows_of r join trees t on r.lang is not distinct from t.lang where len(t.nodes) > 1
  union all
  select r.lang, r.place, s.height + t.level, s.turn // (1 << t.level) % 2 = 0 as first,
    case when first then coalesce(t.nodes[s.turn // (1 << t.level) + 2], '') else t.nodes[s.turn // (1 << t.level)] end
  from rows_of r join subroots s on r.lang is not distinct from s.lang, tops t where len(t.nodes) > 1),
paths as (select lang, place, list(other order by level) as others, list(first order by level) as firsts from steps group by lang, place),
folds as (
  select r.lang, r.place, 0 as level, case when hit and forged is not null then forged else leaf end as h,
    coalesce(others, []) as others, coalesce(firsts, []) as firsts
  from rows_of r left join paths p on r.lang is not distinct from p.lang and r.place = p.place
  union all
  select lang, place, level + 1, sha256(case when firsts[level + 1] then h || others[level + 1] else others[level + 1] || h end), others, firsts
  from folds where level < len(others))
select r.doc_id, r.leaf, s.subroot, t.nodes[1] as root, sha256(array_to_string(f.others, '')) as proof_sha256,
  f.h as folded_root, f.h = t.nodes[1] as verified
from folds f join rows_of r on r.lang is not distinct from f.lang and r.place = f.place
  join subroots s on r.lang is not distinct from s.lang join tops t on len(t.nodes) = 1
where f.level = len(f.others)
"""
