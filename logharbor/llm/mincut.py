"""Exact minimum cuts of small labelling graphs."""

from __future__ import annotations

from collections import deque

Edge = tuple[int, int, int]


def label(scores: list[int], edges: list[Edge]) -> list[bool]:
    """Labels of least total cost: a node costs its score if it goes against its sign, an edge its weight if its ends differ.

    This is a minimum cut: the score is the capacity to the terminal of its sign, the weight that between
    two nodes. A node whose score is at least the weight of its undecided edges takes its own side in
    some minimum cut, so it is decided at once and its edges become part of its neighbours' scores. What
    remains is cut by maximum flow. Of equal cuts the one with the most true labels is returned for a
    graph without decided nodes; a score of zero with no edges is false.
    """
    near: list[list[tuple[int, int]]] = [[] for _ in scores]
    for a, b, weight in edges:
        if a != b and weight > 0:
            near[a].append((b, weight))
            near[b].append((a, weight))
    score, loose = list(scores), [sum(w for _, w in links) for links in near]
    decided: list[bool | None] = [None] * len(scores)
    queue = deque(range(len(scores)))
    while queue:
        node = queue.popleft()
        if decided[node] is None and abs(score[node]) >= loose[node]:
            decided[node] = score[node] > 0
            for other, weight in near[node]:
                if decided[other] is None:
                    score[other] += weight if decided[node] else -weight
                    loose[other] -= weight
                    queue.append(other)
    rest = [k for k, side in enumerate(decided) if side is None]
    if rest:
        for node, side in zip(rest, _flow(rest, score, near)):
            decided[node] = side
    return [bool(side) for side in decided]


def _flow(nodes: list[int], score: list[int], near: list[list[tuple[int, int]]]) -> list[bool]:
    """Maximum flow by shortest augmenting levels (Dinic); true for the nodes that cannot reach the sink."""
    at = {node: k for k, node in enumerate(nodes)}
    source, sink = len(nodes), len(nodes) + 1
    head: list[list[int]] = [[] for _ in range(len(nodes) + 2)]
    to: list[int] = []
    room: list[int] = []

    def link(a: int, b: int, forth: int, back: int) -> None:
        head[a].append(len(to))
        head[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((forth, back))

    for node in nodes:
        k = at[node]
        if score[node] > 0:
            link(source, k, score[node], 0)
        elif score[node] < 0:
            link(k, sink, -score[node], 0)
        for other, weight in near[node]:
            if other in at and node < other:
                link(k, at[other], weight, weight)
    while True:
        level = {source: 0}
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in head[a]:
                if room[e] and to[e] not in level:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if sink not in level:
            break
        turn = [0] * len(head)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                full = next(k for k, e in enumerate(path) if not room[e])
                a = to[path[full] ^ 1]
                del path[full:]
                continue
            while turn[a] < len(head[a]):
                e = head[a][turn[a]]
                if room[e] and level.get(to[e]) == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(head[a]):
                path.append(e)
                a = to[e]
            elif path:
                a = to[path.pop() ^ 1]
                turn[a] += 1
            else:
                break
    reaches = {sink}
    queue = deque([sink])
    while queue:
        b = queue.popleft()
        for e in head[b]:
            if room[e ^ 1] and to[e] not in reaches:
                reaches.add(to[e])
                queue.append(to[e])
    return [k not in reaches for k in range(len(nodes))]
