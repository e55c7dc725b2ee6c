"""Exact, line, passage and near-duplicate dedup against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logharbor.llm import exact_dedup, lines, minhash, repeats
from logharbor.llm.common import written
from logharbor.llm.components import components
from logharbor.llm.suffixes import factors
from tests.llm.conftest import component_ids, near_lines, repeated_bytes

DOCS = "doc_id long, text string"


def clashing(docs):
    """The table with further columns whose names the operators use inside."""
    return docs.withColumns({c: F.lit(1) for c in "id key content digest salt n node kept bucket marks".split()})


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(llm, weak):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (5, "b" * 9000), (None, "c"), (None, "c"), (None, "b" * 9000), (6, "A")]
    digest = (lambda c: F.unhex(F.substring(F.sha2(c, 256), 1, 0))) if weak else exact_dedup.content_digest
    docs = clashing(llm.createDataFrame(rows, DOCS))
    got = sorted(((r.id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs, salts=4, digest=digest).collect()), key=str)
    want = [(1, 2, 3, False), (2, 2, 3, True), (2, 2, 3, True), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 2, True), (6, 6, 1, True)]
    want += [(None, None, 2, True), (None, None, 2, True), (None, 5, 2, False)]
    assert got == sorted(want, key=str)
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_factors_of_all_starts():
    draw = random.Random(1)
    for _ in range(150):
        depth, size = draw.choice([8, 15, 16, 30]), draw.randrange(30, 120)
        body = bytes(draw.randrange(draw.choice([1, 2, 3])) for _ in range(size))
        starts = np.array(sorted(draw.sample(range(size - depth + 1), (size - depth) // 2)), np.int64)
        least = draw.choice([1, 5, depth])
        earlier, later = factors(np.frombuffer(body, np.uint8), starts, depth, least)

        def common(i, j):
            return next((k for k in range(depth) if body[i + k] != body[j + k]), depth)

        for x, i in enumerate(starts):
            for got, others in ((earlier[x], [j for j in starts if j < i]), (later[x], [j for j in starts if j > i])):
                longest = max([common(i, j) for j in others], default=0)
                assert got == (longest if longest >= least else 0)


@pytest.mark.parametrize(("first", "group"), [(False, 1000), (False, 2), (True, 1000), (True, 2)])
def test_repeated_passages(llm, first, group):
    draw = random.Random(4)
    passages = ["".join(draw.choice("ab cd") for _ in range(300)) for _ in range(4)]

    def piece():
        return draw.choice(passages)[draw.randrange(150) :][: draw.randrange(150)] if draw.random() < 0.5 else "".join(draw.choice("abcdé ") for _ in range(draw.randrange(90)))

    rows = [(i, "".join(piece() for _ in range(draw.randrange(6)))) for i in range(50)]
    rows += [(100, None), (101, ""), (102, "a" * 900), (103, "ab" * 300), (104, rows[7][1]), (105, passages[0] * 3), (106, "x" * 100)]
    docs = clashing(llm.createDataFrame(rows, DOCS))
    found = repeats.repeated_passages(docs, length=64, keep="first" if first else "none", group=group)
    got = sorted((r.id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in found.collect())
    assert got == sorted(repeated_bytes(rows, 64, first))
    assert repeats.repeated_passages(docs.limit(0)).count() == 0


def test_repeated_rows_are_places_of_their_own(llm):
    docs = llm.createDataFrame([(1, "x" * 64), (1, "x" * 64), (None, "".join(map(chr, range(33, 103))))], DOCS)
    assert sorted(len(r.kept) for r in repeats.repeated_passages(docs, length=64).collect()) == [0, 0, 70]


def test_edit_distance_within_a_band():
    draw = random.Random(1)
    for _ in range(4000):
        a = bytes(draw.choice(b"abc") for _ in range(draw.randrange(20)))
        b = bytes(draw.choice(b"abc") for _ in range(draw.randrange(20))) if draw.random() < 0.3 else a[draw.randrange(3) : 18] + b"a"
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        for most in range(5):
            assert lines.edit_distance(a, b, most) == min(row[-1], most + 1)


@pytest.mark.parametrize("block", [1000, 3])
def test_near_lines(llm, monkeypatch, block):
    monkeypatch.setattr(lines, "BLOCK", block)
    draw = random.Random(4)
    base = ["".join(draw.choice("abcdefgé ") for _ in range(draw.randrange(15, 60))) for _ in range(25)]

    def edited(text):
        text = list(text)
        for _ in range(draw.randrange(4)):
            at = draw.randrange(len(text))
            text[at : at + draw.randrange(2)] = draw.choice(["a", "é", ""])
        return "".join(text)

    rows = [(i, draw.choice(["\n", "\r\n", " \n\t"]).join(edited(draw.choice(base)) for _ in range(draw.randrange(7)))) for i in range(100)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, base[0] + "\n" + base[1]), (203, "   " + base[2] + "  \n"), (204, "z" * 30000)]
    docs = clashing(llm.createDataFrame(rows, DOCS))
    got = [(r.id, r.n_lines, r.n_dropped, r.n_links, r.first_ids, r.text) for r in lines.line_dedup(docs).collect()]
    want = near_lines(rows, lines.edit_distance, lines.LEAST_BYTES, lines.EDITS)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert lines.line_dedup(docs.limit(0)).count() == 0


def test_keys_of_lines_are_not_broadcast_as_if_each_text_had_one(llm, small_broadcasts):
    draw = random.Random(9)
    texts = ["\n".join(draw.randbytes(15).hex() for _ in range(8)) for _ in range(9000)]
    rows = [*enumerate(texts), *((9000 + i, text.split("\n")[0] + "x") for i, text in enumerate(texts[:40]))]
    docs = written(llm.createDataFrame(rows, DOCS), "test")
    got = {r.id: (r.n_dropped, r.first_ids, r.text) for r in lines.line_dedup(docs).collect()}
    assert got == {i: (1, [i - 9000], "") if i >= 9000 else (0, [], text) for i, text in rows}


def test_repeated_rows_keep_the_same_lines(llm):
    docs = llm.createDataFrame([(1, "a line that is long enough"), (1, "a line that is long enough")], DOCS)
    assert [r.n_dropped for r in lines.line_dedup(docs).collect()] == [0, 0]


def test_marks_of_repeated_rows_are_bounded_by_one_text(llm, monkeypatch):
    rebuilt, text = lines._rebuilt, "\n".join(chr(65 + k) * 30 for k in range(30))

    def bounded(batch):
        assert all(len(marks or []) <= 30 for marks in batch.column("marks").to_pylist())
        return rebuilt(batch)

    monkeypatch.setattr(lines, "_rebuilt", bounded)
    docs = llm.createDataFrame([(None, text)] * 40 + [(3, text)], DOCS).repartition(7)
    got = sorted(((r.id, r.n_lines, r.n_dropped) for r in lines.line_dedup(docs).collect()), key=str)
    assert got == [(3, 30, 30)] + [(None, 30, 0)] * 40


@pytest.mark.parametrize("group", [1000, 2])
def test_spans_and_segments_of_repeated_rows_are_bounded_by_one_text(llm, monkeypatch, group):
    removed, factored = repeats._removed, repeats._factored
    draw = random.Random(6)
    text = "".join(draw.choice("abcdef") for _ in range(1500))
    near = text[:700] + "#" + text[700:]

    def bounded(batch):
        assert all(len(spans or []) <= 200 for spans in batch.column("spans").to_pylist())
        return removed(batch)

    def single(first, length):
        run = factored(first, length)

        def checked(batches):
            for batch in batches:
                places = list(zip(*(batch.column(c).to_pylist() for c in ("anchor", "key", "lo"))))
                assert len(places) == len(set(places))
                yield from run(iter([batch]))

        return checked

    monkeypatch.setattr(repeats, "_removed", bounded)
    monkeypatch.setattr(repeats, "_factored", single)
    rows = [(1, text)] * 40 + [(3, near), (4, "plain")]
    docs = llm.createDataFrame(rows, DOCS).repartition(7)
    found = repeats.repeated_passages(docs, length=64, group=group).collect()
    got = sorted(((r.id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in found), key=str)
    assert got == sorted(repeated_bytes(rows, 64, False), key=str)


def near_copies() -> list[tuple[int, str | None]]:
    draw = random.Random(9)
    words = ["".join(draw.choice("abcdef") for _ in range(5)) for _ in range(400)]
    rows: list[tuple[int, str | None]] = []
    for size in (8, 30, 90):
        base = [draw.choice(words) for _ in range(size)]
        for _ in range(45):
            copy = list(base)
            for _ in range(draw.randrange(max(2, size // 16))):
                copy[draw.randrange(size)] = draw.choice(words)
            rows.append((len(rows), draw.choice(["\n", " ", "\t "]).join(copy).swapcase()))
    return [*rows, (900, None), (901, ""), (902, " \t\n"), (903, "one two"), (904, "One  two"), (905, "two one"), (906, "w " * 30000), (907, rows[3][1])]


def test_near_duplicates(llm, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rows = near_copies()
    docs = clashing(llm.createDataFrame(rows, DOCS))
    got = {r.id: (r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: (c, c == i) for i, c in component_ids(rows).items()}
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_without_ids(llm):
    text = "one two three four five six seven"
    docs = llm.createDataFrame([(None, text), (4, text), (4, text), (None, "other words"), (None, None)], DOCS)
    got = sorted(((r.id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, 4, False), (4, 4, True), (4, 4, True), (None, None, True), (None, None, True)], key=str)


def test_bands_are_not_broadcast_as_if_each_list_were_one_row(llm, small_broadcasts):
    draw = random.Random(8)
    words = [f"w{k}" for k in range(5000)]
    rows = [(i, " ".join(draw.choices(words, k=20))) for i in range(9000)]
    rows += [(i + 9000, f"{text} more") for i, text in rows[:40]]
    docs = written(llm.createDataFrame(rows, DOCS), "test")
    got = {r.id: r.component_id for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: i % 9000 for i, _ in rows}


def test_one_text_stands_for_a_class(llm, monkeypatch):
    kept, tables = minhash.written, []
    monkeypatch.setattr(minhash, "written", lambda df, purpose: tables.append(kept(df, purpose)) or tables[-1])
    draw = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    base = [draw.choice(words) for _ in range(60)]
    other = [*base[:30], "changed", *base[31:]]
    rows = [(None, " ".join(base))] * 30 + [(None, " ".join(other))] * 30 + [(None, f"odd {k} " + " ".join(base[: k + 5])) for k in range(9)]
    rows += [(1, " ".join(base).upper())] * 20 + [(1, " ".join(draw.choice(words) for _ in range(60))), (2, " ".join(other))]
    found = minhash.near_duplicates(llm.createDataFrame(rows, DOCS).repartition(5)).collect()
    want = component_ids([(0, rows[0][1]), (1, rows[30][1])])
    assert want == {0: 0, 1: 0}
    assert sorted(r.component_id or 0 for r in found if r.n_shingles == 56)[-1] == 1
    assert all(r.component_id == 1 for r in found if r.n_shingles == 56)
    texts = next(t for t in tables if t.columns == ["node", "text"])
    assert texts.count() == texts.select("node").distinct().count() >= 2


def test_components_of_paths_stars_and_loops(llm):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(201, 200), (200, 201), (7, 7)]
    got = {(r.node, r.component) for r in components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(k, 0) for k in range(41)} | {(k, 100) for k in range(100, 140)} | {(200, 200), (201, 200)}
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


def test_lines_within_the_distance_share_a_second_key_whatever_the_cuts():
    draw = random.Random(11)
    for _ in range(3000):
        one = bytes(draw.choice(b"ab0") for _ in range(draw.randrange(20, 40)))
        two = bytearray(one)
        for _ in range(draw.randrange(3)):
            at, kind = draw.randrange(len(two)), draw.randrange(3)
            two[at : at + (kind > 0)] = b"" if kind == 1 else bytes([draw.choice(b"ab01")])
        short, long = sorted((one, bytes(two)), key=len)
        first = draw.randrange(1, len(short) - 1)
        cuts, key = (first, draw.randrange(first + 1, len(short))), draw.randrange(-(1 << 63), 1 << 63)
        entries = {k for k, entry in lines.second_keys(short, True, 0, cuts, key).items() if entry}
        assert len(entries) == 3 and entries & set(lines.second_keys(long, False, len(long) - len(short), cuts, key))
        assert entries & set(lines.second_keys(long, True, 0, cuts, key)) or len(short) < len(long)


@pytest.mark.parametrize("crowd", [3, 10**6])
def test_lines_of_one_template(llm, monkeypatch, crowd):
    """Lines that differ in a number only, some of them near, others equal, longer and shorter ones."""
    monkeypatch.setattr(lines, "CROWD", crowd)
    monkeypatch.setattr(lines, "SHOWN", 4)
    draw = random.Random(12)

    def line():
        number = "".join(draw.choice("0123456789") for _ in range(draw.choice([5, 6, 7])))
        return f"Record number {number} of the {draw.choice(['yearly', 'yearly', 'monthly'])} report"

    rows = [(i, "\n".join(line() for _ in range(12))) for i in range(30)]
    rows += [(100 + i, rows[i][1].replace("Record", "Records").replace("4", "5", 1)) for i in range(5)]
    found = lines.line_dedup(llm.createDataFrame(rows, DOCS).repartition(4)).collect()
    got = sorted((r.id, r.n_lines, r.n_dropped, r.n_links, r.first_ids, r.text) for r in found)
    want = near_lines(rows, lines.edit_distance, lines.LEAST_BYTES, lines.EDITS)
    assert got == sorted(want) and sum(w[3] for w in want) > 100


def test_cuts_share_out_what_varies():
    template = [f"Record number {n:09d} of the yearly report".encode() for n in range(0, 10**9, 9_999_991)]
    first, second = lines.varying_cuts(template)
    assert 14 < first < second < 23
    assert lines.varying_cuts([b"x" * 20] * 5) in [(k, m) for k in range(1, 19) for m in range(k + 1, 20)]


@pytest.mark.parametrize("crowd", [3, 10**6])
def test_pages_of_one_template(llm, monkeypatch, crowd):
    """Rows that share most of their shingles and are no links, with some near copies among them."""
    monkeypatch.setattr(minhash, "CROWD", crowd)
    draw = random.Random(13)
    frame = [f"t{k}" for k in range(150)]
    rows = []
    for i in range(90):
        own = [f"w{draw.randrange(10**6)}" for _ in range(70)]
        rows.append((i, " ".join(frame[:75] + own + frame[75:])))
        if i % 9 == 0:
            rows.append((1000 + i, " ".join(frame[:75] + own[:-4] + ["other"] + frame[75:])))
        if i % 30 == 0:
            rows += [(2000 + i + k, " ".join(frame[:75] + own + [f"end{k}"] + frame[75:])) for k in range(6)]
    found = minhash.near_duplicates(llm.createDataFrame(rows, DOCS).repartition(3)).collect()
    assert {r.id: r.component_id for r in found} == component_ids(rows)
    assert 1 < max(Counter(r.component_id for r in found).values()) < 20
