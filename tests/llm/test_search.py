"""Ranked search, Merkle manifest and top-k search against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from logharbor.llm import lexical, merkle, nearest
from logharbor.session import SLICE_ROWS_KEY

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def clashing(df, names):
    return df.withColumns({c: F.lit(1) for c in names.split() if c not in df.columns})


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def ranks(docs, items, k):
    """Per item: (rank, doc_id, score), null ids after all others."""
    bags = [(i, Counter(terms_of(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    total, words = len(bags), sum(n for _, _, n in bags)
    having = Counter(t for _, b, _ in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) for t, df in having.items()}
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, bag, n in bags:
            m = 25 + 75 * n * total // words
            score = sum(weight[t] * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in terms_of(text) if t in bag)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("index_terms", "stages", "k"), [(1 << 19, 4, 10), (0, 3, 2)])
def test_ranked_search(llm, index_terms, stages, k):
    draw = random.Random(3)
    words = "the The of. a-b élan ÉLAN x1 漢字 42 and rare1 rare2 rare3 zig_zag  nb".split(" ")

    def text(n):
        return " ".join(draw.choice(words[: draw.choice([4, len(words)])]) for _ in range(draw.randrange(n)))

    docs = [(i, text(30)) for i in range(120)] + [(7, "the rare1"), (7, "the rare1"), (None, "the rare1"), (200, None), (201, ""), (202, "--- !"), (203, "the " * 9000)]
    items = [(i, text(12)) for i in range(140)] + [(1, "rare1 rare1 the"), (1, "rare1 rare1 the"), (1, "of"), (None, "élan"), (150, None), (151, "nowhere"), (152, "?")]
    tables = [clashing(llm.createDataFrame(r, s).repartition(5), "id part term item stage bundle rank score weight deal") for r, s in ((docs, "doc_id long, text string"), (items, "item_id long, text string"))]
    got = lexical.ranked(*tables, k=k, stages=stages, index_terms=index_terms).collect()
    assert sorted((tuple(r) for r in got), key=str) == ranks(docs, items, k)
    for empty in ((tables[0].limit(0), tables[1]), (tables[0], tables[1].limit(0))):
        assert lexical.ranked(*empty).count() == 0


def test_terms_are_cut_as_the_pattern_says():
    import pyarrow as pa

    draw = random.Random(5)
    texts = ["".join(draw.choice("aZ09 _-/:@[`{\x7f\x00é漢\n") for _ in range(draw.randrange(40))) for _ in range(300)] + [None, ""]
    hashes, starts = lexical.term_hashes(pa.array(texts))
    names = {}
    for n, text in enumerate(texts):
        part = hashes[starts[n] : starts[n + 1]].tolist()
        assert len(part) == len(terms_of(text))
        for h, term in zip(part, terms_of(text)):
            assert names.setdefault(term, h) == h
    assert len(set(names.values())) == len(names)


def tree(nodes, fanout):
    """Root, and the siblings of each node from below."""
    steps = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for n, a in enumerate(at):
            b = a - a % fanout
            steps[n].append((nodes[b:a], nodes[a + 1 : b + fanout]))
            at[n] = a // fanout
        nodes = [merkle.digest(nodes[k : k + fanout]) for k in range(0, len(nodes), fanout)]
    return nodes[0], steps


def manifest(rows, fanout):
    def leaf(row):
        parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs, below = [], []
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, steps = tree([leaf(r) for r in groups[g]], fanout)
        subs.append(root)
        below.append(steps)
    root, above = tree(subs, fanout)
    out = []
    for g, sub, steps, rest in zip(order, subs, below, above):
        for row, own in zip(groups[g], steps):
            path = own + rest
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            claimed = leaf((*row[:3], row[3] + 1, row[4]) if hit else row)
            folded = claimed
            for before, after in path:
                folded = merkle.digest([*before, folded, *after])
            proof = merkle.digest([x for before, after in path for x in before + after])
            out.append((row[0], leaf(row), sub, root, proof, folded, folded == root, [(b, a) for b, a in path]))
    return sorted(out, key=str)


@pytest.mark.parametrize(("fanout", "block", "n"), [(2, 1, 37), (3, 3, 140), (2, 1024, 40)])
def test_manifest(llm, fanout, block, n):
    draw = random.Random(n)
    rows = [(i, draw.choice(["web", None]), draw.choice(["en", "en", "en", "é", "", None]), draw.choice([None, 5]), draw.choice(["", None, "naïve", "x" * 9000])) for i in range(n)]
    rows += [(None, "web", "en", 1, "a"), (None, None, None, None, None), (3, "web", "one", 2, "b"), rows[5], rows[5]]
    docs = clashing(llm.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string"), "id tree block nth leaf root row steps size")
    fields = [F.col(c) for c in merkle.FIELDS]
    forged = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in merkle.FIELDS]
    claimed = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.leaf_digest(forged))
    llm.conf.set(SLICE_ROWS_KEY, "9")
    try:
        found = merkle.merkle_manifest(docs.repartition(4), "doc_id", "lang", merkle.leaf_digest(fields), claimed, fanout, block, proofs=True)
        got = [(r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified, [(s.before, s.after) for s in r.proof]) for r in found.collect()]
    finally:
        llm.conf.unset(SLICE_ROWS_KEY)
    want = manifest(rows, fanout)
    assert sorted(got, key=str) == want
    assert not all(w[6] for w in want)
    assert merkle.merkle_manifest(docs.limit(0), "doc_id", "lang", merkle.leaf_digest(fields)).count() == 0


def test_a_block_is_a_power_of_the_fanout(llm):
    docs = llm.createDataFrame([(1, "en")], "doc_id long, lang string")
    with pytest.raises(ValueError, match="power"):
        merkle.merkle_manifest(docs, "doc_id", "lang", F.lit("x"), fanout=2, block=6)


def nearest_rows(rows, k):
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and abs(x) < 2**15 for x in v)]
    out = []
    for query in {i for i, _ in whole if i is not None and i % 5 == 0}:
        best = {}
        for own in (v for i, v in whole if i == query):
            for i, v in whole:
                if i != query and len(v) == len(own):
                    best[i] = max(best.get(i, -(1 << 62)), sum(a * b for a, b in zip(own, v)))
        top = sorted(((-s, i is None, i or 0, i) for i, s in best.items()))[:k]
        out += [(query, r, t[3], -t[0]) for r, t in enumerate(top, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("dims", "candidates", "queries", "large"), [(40, 9, 3, False), (3, 1000, 100, False), (20, 16, 1, True)])
def test_top_k(llm, dims, candidates, queries, large):
    draw = random.Random(dims)
    scale = 30_000 if large else 1

    def vector(n=dims):
        return [scale * draw.choice([draw.uniform(-1, 1), 0.5, 0.0]) for _ in range(n)]

    common = vector()
    rows = [(i, draw.choice([vector(), common])) for i in range(90)]
    rows += [(i, vector(2)) for i in range(100, 112)] + [(120, []), (121, []), (125, None), (130, [None] * dims), (135, [math.nan] * dims), (140, [math.inf] * dims)]
    rows += [(None, common), (None, vector()), (5, common), (5, vector()), (7, vector()), (7, rows[7][1]), (145, [2.0**15] * dims), (0, rows[0][1])]
    table = clashing(llm.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), "id vector asks number kind ids columns pair part rank score")
    found = nearest.top_k(table, F.col("vec_id") % 5 == 0, k=4, candidates=candidates, queries=queries)
    assert sorted((tuple(r) for r in found.collect()), key=str) == nearest_rows(rows, 4)
    assert nearest.top_k(table.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    assert nearest.top_k(table, F.lit(False)).count() == 0
