"""Word shingles as 64-bit hashes, for whole Arrow batches at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words of a shingle.
WORDS = 5

_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_VALUE = _BYTE[_FOLD]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


#: Powers that a worker keeps for each base; longer lists are made anew.
_KEPT = 1 << 22
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    if base not in _POWERS or n > len(_POWERS[base]):
        out = np.full(max(n, min(2 * n, _KEPT)), base, np.uint64)
        out[:1] = 1
        out = np.multiply.accumulate(out)
        if n > _KEPT:
            return out
        _POWERS[base] = out
    return _POWERS[base][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and where each begins (with the end as last element)."""
    data = pc.cast(pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else ""), pa.large_binary())
    starts = np.frombuffer(data.buffers()[1], np.int64, len(data) + 1, data.offset * 8)
    body = np.frombuffer(data.buffers()[2], np.uint8, starts[-1]) if data.buffers()[2] and starts[-1] else np.zeros(0, np.uint8)
    return body[starts[0] :], starts - starts[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, lower-cased in ASCII and cut at ASCII white space; where each text begins."""
    body, starts = text_bytes(texts)
    if not len(body):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    inside = ~_SPACE[body]
    before = np.empty(len(body), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[starts[:-1][starts[:-1] < len(body)]] = False
    first = np.flatnonzero(inside & ~before)
    after = np.zeros(len(body), bool)
    after[:-1] = ~inside[1:]
    after[starts[1:][starts[1:] > 0] - 1] = True
    end = np.flatnonzero(inside & after) + 1
    # the polynomial of a word, from its first byte, as a difference of prefix sums that is shifted back
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(_VALUE[body] * powers(_BASE, len(body)), out=sums[1:])
    hashes = mixed((sums[end] - sums[first]) * powers(_INVERSE, len(body))[first] + (end - first).astype(np.uint64))
    return hashes, np.searchsorted(first, starts)


def shingle_hashes(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word n-grams of all texts in their order, repeats included, and where each text begins.

    A text with fewer words has its whole sequence as its one shingle; a text without words has none.
    """
    hashes, starts = word_hashes(texts)
    counts = np.diff(starts)
    shingles = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(shingles)])
    at = np.arange(offsets[-1]) + np.repeat(starts[:-1] - offsets[:-1], shingles)
    length = np.repeat(np.minimum(counts, words), shingles)
    out = length.astype(np.uint64)
    for k in range(words):
        more = k < length
        step = np.where(more, hashes[np.minimum(at + k, max(len(hashes) - 1, 0))], np.uint64(0)) if len(hashes) else out
        out = mixed(out * np.uint64(_BASE) + step)
    return out, offsets


def shingle_sets(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text in ascending order, and where each text begins."""
    hashes, starts = shingle_hashes(texts, words)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.searchsorted(owner[fresh], np.arange(len(starts)))


def shingle_sql(table: str, key: str) -> str:
    """DuckDB SQL for the distinct five-word shingles of a table's texts."""
    upper, lower = (", ".join(f"chr({c + k})" for c in range(26)) for k in (65, 97))
    folded = f"translate(coalesce(text, ''), concat({upper}), concat({lower}))"
    return f"""
      select distinct {key}, unnest(case when len(w) >= {WORDS}
          then list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))
          when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as shingle
      from (select {key}, regexp_extract_all({folded}, '[^\\x20\\x09-\\x0D]+') as w from {table})"""
