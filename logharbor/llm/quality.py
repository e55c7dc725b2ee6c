"""Quality score: a sparse ensemble of rules over text statistics, evaluated as Spark column expressions.

Boosted trees propose rules: every path from a root is a conjunction of comparisons. A logistic model
with a lasso penalty keeps few of them. The kept rules are compiled into columns over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logharbor.llm.common import arrow_column, read_table, session, whole_text
from logharbor.llm.folds import first_by_hash, held_out, training_labels
from logharbor.llm.shingles import text_bytes, word_hashes

#: Largest number of labelled rows that the rules are fitted on.
TRAINING_ROWS = 20_000
#: Trees, their depth, least rows of a leaf, candidate cuts of a statistic, step of boosting.
TREES, DEPTH, LEAST_ROWS, CUTS, SHRINK = 30, 3, 10, 32, 0.3
#: Lasso penalty and steps of the logistic fit.
LASSO, STEPS = 5e-4, 500
#: Score from which a text is good.
THRESHOLD = 0.3

STATISTICS = (
    "words", "word_bytes", "distinct_words", "repeated_next", "commonest_word", "upper", "digits", "symbols",
    "bars", "marks", "stops", "non_ascii", "lines", "line_bytes", "distinct_lines", "longest_word", "pairs_distinct",
)


def _classes() -> dict[str, np.ndarray]:
    groups = {
        "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "digits": b"0123456789",
        "symbols": b"#$%&*+/<=>@[\\]^_`{}~",
        "bars": b"|",
        "marks": b"!?",
        "stops": b".,;:",
        "non_ascii": bytes(range(128, 256)),
    }
    out = {}
    for name, members in groups.items():
        out[name] = np.zeros(256, np.uint8)
        out[name][list(members)] = 1
    return out


_CLASS = _classes()


def _run_totals(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[starts[1:]] - sums[starts[:-1]]


def _distinct(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of distinct hashes and of the commonest one, per text."""
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((hashes, owner))
    sorted_hashes, sorted_owner = hashes[order], owner[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (sorted_hashes[1:] != sorted_hashes[:-1]) | (sorted_owner[1:] != sorted_owner[:-1])
    first = np.flatnonzero(fresh)
    number = np.bincount(sorted_owner[first], minlength=len(starts) - 1)
    most = np.zeros(len(starts) - 1, np.int64)
    np.maximum.at(most, sorted_owner[first], np.diff(np.append(first, len(order))))
    return number, most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row per text with STATISTICS: counts, and shares between 0 and 1. A text without words has zeros."""
    body, starts = text_bytes(texts)
    size = np.maximum(np.diff(starts), 1)
    hashes, words = word_hashes(texts)
    count = np.diff(words)
    some = np.maximum(count, 1)
    out = {"words": count}
    distinct, most = _distinct(hashes, words)
    out["distinct_words"], out["commonest_word"] = distinct / some, most / some
    inner = np.ones(len(hashes), bool)
    inner[words[:-1][words[:-1] < len(hashes)]] = False
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    out["repeated_next"] = _run_totals(again & inner, words) / some
    pairs = hashes.copy()
    pairs[1:] += hashes[:-1] * np.uint64(0x9E3779B97F4A7C15)
    pair_starts = words - np.concatenate([[0], np.cumsum(count > 0)])
    out["pairs_distinct"] = _distinct(pairs[inner], pair_starts)[0] / np.maximum(count - 1, 1)
    for name, members in _CLASS.items():
        out[name] = _run_totals(members[body], starts) / size
    space = (body == 32) | ((body >= 9) & (body <= 13))
    out["word_bytes"] = _run_totals(~space, starts) / some
    # lengths of words and lines, from where white space and line ends are
    step = np.arange(len(body))
    opened = np.maximum.accumulate(np.where(space, step + 1, 0)) if len(body) else step
    opened = np.maximum(opened, np.repeat(starts[:-1], np.diff(starts)))
    longest = np.zeros(len(size), np.int64)
    np.maximum.at(longest, np.repeat(np.arange(len(size)), np.diff(starts)), np.where(space, 0, step - opened + 1))
    out["longest_word"] = longest
    ends = body == 10
    lines = _run_totals(ends, starts) + 1
    out["lines"], out["line_bytes"] = lines, np.diff(starts) / lines
    sums = np.concatenate([[0], np.cumsum((body.astype(np.uint64) + np.uint64(1)) * _position(step, ends, starts))]).astype(np.uint64)
    edges = np.unique(np.concatenate([starts, np.flatnonzero(ends) + 1]))
    pieces = sums[edges[1:]] - sums[edges[:-1]]
    line_starts = np.searchsorted(edges[:-1], starts) if len(edges) else starts
    kinds, _ = _distinct(pieces, line_starts)
    out["distinct_lines"] = kinds / np.maximum(np.diff(line_starts), 1)
    return np.stack([np.asarray(out[name], np.float64) for name in STATISTICS], 1)


def _position(step: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """An odd number that depends on the place of a byte in its line."""
    begin = np.zeros(len(step), np.int64)
    begin[1:] = np.where(ends[:-1], step[1:], 0)
    begin[starts[:-1][starts[:-1] < len(step)]] = starts[:-1][starts[:-1] < len(step)]
    place = (step - np.maximum.accumulate(begin)).astype(np.uint64) if len(step) else step.astype(np.uint64)
    place = (place + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((place ^ (place >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)) | np.uint64(1)


def with_statistics(docs: DataFrame, text_col: str = "text", out: str = "statistics") -> DataFrame:
    """The table with a struct of the statistics of each whole text; a column named `out` is replaced."""

    def work(texts: pa.Array) -> pa.Array:
        columns = [pa.array(c) for c in np.ascontiguousarray(statistics(texts).T)]
        return pa.StructArray.from_arrays(columns, list(STATISTICS))

    kind = "struct<" + ", ".join(f"{name}: double" for name in STATISTICS) + ">"
    return docs.withColumn(out, arrow_column(work, kind)(whole_text(text_col)))


@dataclass(frozen=True)
class Rule:
    """All of some comparisons: statistic, cut, and whether the value must lie above the cut."""

    terms: tuple[tuple[int, float, bool], ...]
    weight: float = 0.0

    def holds(self, values: np.ndarray) -> np.ndarray:
        return reduce(np.logical_and, [(values[:, k] > cut) == above for k, cut, above in self.terms])

    def column(self, source: str) -> Column:
        parts = [F.col(f"{source}.{STATISTICS[k]}") > cut if above else F.col(f"{source}.{STATISTICS[k]}") <= cut for k, cut, above in self.terms]
        return F.when(reduce(Column.__and__, parts), F.lit(self.weight)).otherwise(F.lit(0.0))


@dataclass(frozen=True)
class RuleModel:
    bias: float
    rules: tuple[Rule, ...]

    def column(self, source: str) -> Column:
        total = reduce(Column.__add__, [r.column(source) for r in self.rules], F.lit(self.bias))
        return 1 / (1 + F.exp(-total))


def _cuts(values: np.ndarray) -> list[np.ndarray]:
    quantiles = np.linspace(0, 1, CUTS + 1)[1:-1]
    return [np.unique(np.quantile(v, quantiles, method="lower")) for v in values.T]


def _grow(codes: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, curve: np.ndarray, rows: np.ndarray, path, rules: set, fitted: np.ndarray) -> None:
    """Split `rows` where the second-order gain is largest; every node below the root is a rule."""
    if path:
        rules.add(path)
    g, h = slope[rows], curve[rows]
    fitted[rows] = g.sum() / (h.sum() + 1)
    if len(path) == DEPTH or len(rows) < 2 * LEAST_ROWS:
        return
    best = (1e-6, None)
    base = g.sum() ** 2 / (h.sum() + 1)
    for k, edges in enumerate(cuts):
        if not len(edges):
            continue
        code = codes[rows, k]
        sums = [np.cumsum(np.bincount(code, w, len(edges) + 1))[:-1] for w in (g, h, np.ones(len(rows)))]
        fits = (sums[2] >= LEAST_ROWS) & (len(rows) - sums[2] >= LEAST_ROWS)
        gain = sums[0] ** 2 / (sums[1] + 1) + (g.sum() - sums[0]) ** 2 / (h.sum() - sums[1] + 1) - base
        gain[~fits] = -1
        at = int(gain.argmax())
        if gain[at] > best[0]:
            best = (gain[at], (k, at))
    if best[1] is None:
        return
    k, at = best[1]
    for above in (False, True):
        part = rows[(codes[rows, k] > at) == above]
        _grow(codes, cuts, slope, curve, part, (*path, (k, float(cuts[k][at]), above)), rules, fitted)


def propose(values: np.ndarray, good: np.ndarray) -> list[Rule]:
    """The distinct paths of gradient-boosted trees on the logistic loss."""
    cuts = _cuts(values)
    codes = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, values.T)], 1)
    z, rules = np.full(len(good), np.log(good.mean() / (1 - good.mean()))), set()
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        fitted = np.zeros(len(good))
        _grow(codes, cuts, good - p, p * (1 - p), np.arange(len(good)), (), rules, fitted)
        z += SHRINK * fitted
    return [Rule(terms) for terms in sorted(rules)]


def fit(values: np.ndarray, good: np.ndarray) -> RuleModel:
    """Lasso logistic weights of the proposed rules, by accelerated proximal gradient steps."""
    rules = propose(values, good)
    x = np.stack([r.holds(values) for r in rules], 1).astype(np.float64) if rules else np.zeros((len(good), 0))
    centre = x.mean(0)
    step = 4 * len(good) / (np.linalg.norm(x - centre, 2) ** 2 + len(good))
    weights = ahead = np.zeros(len(rules))
    bias = ahead_bias = np.log(good.mean() / (1 - good.mean()))
    momentum = 1.0
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-(ahead_bias + (x - centre) @ ahead))) - good
        moved = ahead - step * ((x - centre).T @ error) / len(good)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * LASSO, 0)
        new_bias = ahead_bias - step * error.mean()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / following * (new - weights)
        ahead_bias = new_bias + (momentum - 1) / following * (new_bias - bias)
        weights, bias, momentum = new, new_bias, following
    kept = tuple(Rule(r.terms, float(w)) for r, w in zip(rules, weights) if w)
    return RuleModel(float(bias - centre @ weights), kept)


def train(docs: DataFrame, labels: DataFrame, bound: int = TRAINING_ROWS) -> RuleModel:
    """Fit on at most `bound` labelled rows outside the held-out fold.

    Without labels of both kinds there is nothing to tell apart: every score is then the share of good
    rows, or 0.5 without labels.
    """
    known = training_labels(labels, "quality")
    ids = first_by_hash(known.select("doc_id"), bound).join(known, "doc_id")
    sample = docs.select("doc_id", F.col("text").alias("content")).join(F.broadcast(ids), "doc_id")
    table = with_statistics(sample, "content").select("label", "statistics.*").limit(bound).toArrow()
    good = table.column("label").to_numpy().astype(np.float64)
    if not 0 < good.sum() < len(good):
        return RuleModel(30.0 if len(good) and good.all() else -30.0 if len(good) else 0.0, ())
    return fit(np.stack([table.column(name).to_numpy() for name in STATISTICS], 1), good)


def score(docs: DataFrame, model: RuleModel, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """The table with a score from 0 to 1 in a new column, from the whole text alone; null counts as empty.

    Other columns are passed on; one that is named `out` is replaced. Rows are scored one by one, so
    repeated rows and ties do not matter, and an empty table stays empty.
    """
    held = "__statistics"
    return with_statistics(docs, text_col, held).withColumn(out, model.column(held)).drop(held)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(session(spark), sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text"), model, out="score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
