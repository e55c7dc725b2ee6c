"""Plain-Python statements of what the operators return."""

from __future__ import annotations

import pytest

from logharbor.llm.common import session


@pytest.fixture
def llm(spark):
    return session(spark)


@pytest.fixture
def small_broadcasts(llm):
    """A table that takes more than 20 MB when it is broadcast ends the query; by binary keys a few rows take 16 MB."""
    llm.conf.set("spark.sql.maxBroadcastTableSize", "20m")
    yield
    llm.conf.unset("spark.sql.maxBroadcastTableSize")


def shingles(text: str | None) -> set:
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def component_ids(rows: list[tuple[int, str | None]]) -> dict[int, int]:
    """Smallest id reachable by links, from all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for k, i in enumerate(ids):
        for j in ids[:k]:
            common = len(sets[i] & sets[j])
            if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in sets}


def near_lines(rows: list[tuple[int | None, str | None]], distance, least: int, most: int) -> list[tuple]:
    """Per row: id, lines, dropped lines, links, ids of first lines, remaining text."""
    white = " \t\n\r\x0b\x0c"
    order = lambda i: -1 if i is None else i
    first: dict[bytes, tuple] = {}
    for i, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            if len(data := line.strip(white).encode()) >= least:
                first[data] = min(first.get(data, (order(i), n)), (order(i), n))
    best, links = dict(first), dict.fromkeys(first, 0)
    for a in first:
        for b in first:
            if a != b and abs(len(a) - len(b)) <= most and distance(a, b, most) <= most:
                links[a] += 1
                best[a] = min(best[a], first[b])
    out = []
    for i, text in rows:
        lines, kept, ids, linked = (text or "").split("\n"), [], set(), 0
        for n, line in enumerate(lines):
            data = line.strip(white).encode()
            linked += links.get(data, 0)
            if data in best and best[data] != (order(i), n):
                ids.add(best[data][0])
            else:
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), linked, sorted(ids - {-1}), "\n".join(kept)))
    return out


def repeated_bytes(rows: list[tuple], length: int, keep_first: bool) -> list[tuple]:
    """Per row: id, bytes, removed runs, remaining bytes."""
    seen: dict[bytes, list] = {}
    data = [(text or "").encode() for _, text in rows]
    for r, body in enumerate(data):
        for p in range(len(body) - length + 1):
            seen.setdefault(body[p : p + length], []).append((rows[r][0], p, r))
    gone = [bytearray(len(body)) for body in data]
    for places in seen.values():
        if len(places) > 1:
            for _, p, r in sorted(places)[1 if keep_first else 0 :]:
                gone[r][p : p + length] = b"\1" * length
    out = []
    for (i, _), body, flags in zip(rows, data, gone):
        runs = sum(1 for k, f in enumerate(flags) if f and not (k and flags[k - 1]))
        out.append((i, len(body), runs, bytes(b for b, f in zip(body, flags) if not f)))
    return out
