"""Suffix order and longest-previous-factor arrays of byte strings, up to a given depth, in numpy."""

from __future__ import annotations

import numpy as np


def _ranked(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    fresh = np.zeros(len(keys), np.uint64)
    fresh[1:] = keys[order[1:]] != keys[order[:-1]]
    out = np.empty(len(keys), np.uint64)
    out[order] = np.cumsum(fresh)
    return out


def prefix_ranks(data: np.ndarray, depth: int) -> dict[int, np.ndarray]:
    """By length 8, 24, 72 .. up to `depth`: the rank of the substring of that length at each position.

    A rank of three times the length (twice, for data over 2 MB) comes from the ranks of its parts. Past
    the end a substring continues with zero bytes, so only substrings inside the data may be compared.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    first = np.zeros(n, np.uint64)
    for k in range(8):
        first = (first << np.uint64(8)) | padded[k : k + n]
    ranks, length = {8: _ranked(first)}, 8
    parts, bits = (3, 21) if n < (1 << 21) - 1 else (2, 32)
    while length * parts <= depth:
        key = np.zeros(n, np.uint64)
        for k in range(parts):
            key <<= np.uint64(bits)
            key[: max(n - k * length, 0)] += ranks[length][k * length :] + np.uint64(1)
        ranks[length * parts] = _ranked(key)
        length *= parts
    return ranks


def common_prefix(data: np.ndarray, ranks: dict[int, np.ndarray], a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, at most `depth`, which must lie inside the data."""
    same = np.zeros(len(a), np.int64)
    for length in sorted(ranks, reverse=True):
        while True:
            fits = np.flatnonzero(same + length <= depth)
            equal = fits[ranks[length][a[fits] + same[fits]] == ranks[length][b[fits] + same[fits]]]
            same[equal] += length
            if not len(equal):
                break
    for _ in range(7):
        fits = np.flatnonzero(same < depth)
        equal = fits[data[a[fits] + same[fits]] == data[b[fits] + same[fits]]]
        # a mismatch ends the prefix: the next rounds compare the same unequal bytes again
        same[equal] += 1
    return same


def nearest_smaller(values: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest place to the left with a smaller value (-1: none), and the least of `shared`
    on the way, where shared[i] belongs to the step from i to i - 1.

    All places jump at once: a place whose candidate is too large takes over the candidate's candidate.
    """
    at, least = np.arange(len(values)) - 1, shared.copy()
    jumps = np.arange(len(values))
    while True:
        jumps = jumps[(at[jumps] >= 0) & (values[np.maximum(at[jumps], 0)] > values[jumps])]
        if not len(jumps):
            least[at < 0] = 0
            return at, least
        via = at[jumps]
        least[jumps], at[jumps] = np.minimum(least[jumps], least[via]), at[via]


def factors(data: np.ndarray, starts: np.ndarray, depth: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor of each start, at most `depth`; lengths below `least` are zero.

    The first is the longest prefix of the suffix that also starts at an earlier of the `starts`, the
    second at a later one; both may overlap it. `starts` ascends, and `depth` bytes follow each of them.
    In suffix order the earlier start that shares most is the nearest one to the left or to the right
    with a smaller position; the later one has a larger position.
    """
    found = np.zeros((2, len(starts)), np.int64)
    if not len(starts):
        return found[0], found[1]
    ranks = prefix_ranks(data, depth)
    top = max(ranks)
    # ranks of substrings that cover `depth` bytes together, compared in turn: the suffix order
    covers = [ranks[top][starts + at] for at in sorted({*range(0, depth - top, top), depth - top})]
    order = np.lexsort((starts, *covers[::-1]))
    place = starts[order]
    if least >= depth:
        same = np.logical_and.reduce([c[order[1:]] == c[order[:-1]] for c in covers])
        after = np.where(same, depth, 0)
    else:
        after = common_prefix(data, ranks, place[:-1], place[1:], depth)
    shared = np.zeros(len(place) + 1, np.int64)
    shared[1:-1] = np.where(after >= least, after, 0)
    # starts that share less than `least` with both neighbours share less with all
    kept = np.flatnonzero((shared[1:] > 0) | (shared[:-1] > 0))
    place, order, shared = place[kept], order[kept], shared[:-1][kept]
    mirrored = np.concatenate([shared[1:], [0]])[::-1]
    for k, sign in enumerate((1, -1)):
        left = nearest_smaller(sign * place, shared)[1]
        right = nearest_smaller(sign * place[::-1], mirrored)[1][::-1]
        found[k, order] = np.maximum(left, right)
    return found[0], found[1]
