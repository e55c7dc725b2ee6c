"""Toxicity: a linear model learned from confirmed toxic texts and unlabelled ones.

The risk of calling unlabelled texts clean is corrected for the toxic share among them, and the part
of it that stands for clean texts is kept from going below zero (non-negative PU learning).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logharbor.llm.common import arrow_column, by_batch, hand_back, read_table, runs, session, text_slices, whole_text
from logharbor.llm.folds import first_by_hash, held_out, one_text_per_id, training_labels
from logharbor.llm.shingles import mixed, powers, text_bytes

#: Largest number of confirmed toxic and of unlabelled texts that the model is fitted on.
TOXIC_ROWS, UNLABELLED_ROWS = 2000, 6000
#: Hash buckets of the features, and bytes of the word beginnings that are features besides whole words.
BUCKETS, BEGINNINGS = 1 << 20, (4, 5, 6)
#: Steps, step size, weight penalties; a feature must occur in so many of the texts.
STEPS, RATE, LASSO, RIDGE, LEAST_TEXTS = 300, 0.05, 2e-4, 1e-5, 3
#: Score from which a text is toxic.
THRESHOLD = 0.5

_VALUE = np.random.default_rng(29).integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLD = np.arange(256)
_FOLD[65:91] += 32
_VALUE = _VALUE[_FOLD]
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts, and the text that each belongs to; repeats included.

    A word is a run of letters (all non-ASCII bytes count as letters), lower-cased in ASCII. Its features
    are the word and its beginnings.
    """
    body, starts = text_bytes(texts)
    inside = _LETTER[body]
    before, after = np.zeros(len(body), bool), np.zeros(len(body), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edge = starts[(starts > 0) & (starts < len(body))]
    before[edge], after[edge - 1] = False, False
    first, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(_VALUE[body] * powers(_BASE, len(body)), out=sums[1:])
    back = powers(_INVERSE, len(body))[first]
    owner = np.searchsorted(starts, first, side="right") - 1
    numbers, owners = [mixed((sums[end] - sums[first]) * back)], [owner]
    for k in BEGINNINGS:
        long = end - first > k
        numbers.append(mixed((sums[first[long] + k] - sums[first[long]]) * back[long] + np.uint64(k)))
        owners.append(owner[long])
    return (np.concatenate(numbers) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(owners)


def distinct_features(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text by text and number, only those that are wanted if that is given."""
    number, owner = features(texts)
    if wanted is not None:
        keep = wanted[number]
        number, owner = number[keep], owner[keep]
    both = np.unique(owner * BUCKETS + number)
    return both % BUCKETS, both // BUCKETS


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray

    def logits(self, texts: pa.Array) -> np.ndarray:
        number, owner = distinct_features(texts, self.weights != 0)
        return self.bias + np.bincount(owner, self.weights[number], len(texts))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit(number: np.ndarray, owner: np.ndarray, toxic: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative risk with logistic loss by Adam, with a lasso step after each.

    risk = prior * mean over toxic of loss(z) + max(0, mean over unlabelled of loss(-z) - prior * mean
    over toxic of loss(-z)). Where the second part is negative, the step goes against it instead. Entries
    (`number`, `owner`) come ordered by text.
    """
    n = len(toxic)
    texts_with = np.bincount(number, minlength=BUCKETS)
    active = np.flatnonzero((texts_with >= LEAST_TEXTS) & (texts_with <= 0.5 * n))
    if not len(active):
        return Model(float(np.log(prior / (1 - prior))), np.zeros(BUCKETS, np.float32))
    place = np.full(BUCKETS, -1, np.int32)
    place[active] = np.arange(len(active))
    column, row = place[number], owner.astype(np.int32)
    column, row = column[column >= 0], row[column >= 0]
    # the entries by text for scores, and by feature for the gradient
    by_feature = row[np.argsort(column, kind="stable")]
    feature_starts = np.concatenate([[0], np.cumsum(np.bincount(column, minlength=len(active)))[:-1]])
    text_starts = runs(row)[:-1]
    filled = row[text_starts]
    entries = np.empty(len(column))  # one array for all steps
    del row, number, owner, place
    weights, bias = np.zeros(len(active)), float(np.log(prior / (1 - prior)))
    moment, square = np.zeros(len(active) + 1), np.zeros(len(active) + 1)
    share_p, share_u = prior * toxic / toxic.sum(), ~toxic / (~toxic).sum()
    for step in range(1, STEPS + 1):
        z = np.full(n, bias)
        z[filled] += np.add.reduceat(np.take(weights, column, out=entries, mode="clip"), text_starts)
        p = sigmoid(z)
        clean_loss = np.logaddexp(0, z)
        clean_risk = (share_u - share_p) @ clean_loss
        slope = (share_u - share_p) * p  # of the part that stands for clean texts
        slope = slope - share_p * (1 - p) if clean_risk >= 0 else -slope
        sums = np.add.reduceat(np.take(slope, by_feature, out=entries, mode="clip"), feature_starts)
        gradient = np.append(sums + RIDGE * weights, slope.sum())
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        rate = RATE / (np.sqrt(square / (1 - 0.999**step)) + 1e-6)
        move = rate * moment / (1 - 0.9**step)
        weights, bias = weights - move[:-1], bias - move[-1]
        weights = np.sign(weights) * np.maximum(np.abs(weights) - np.minimum(rate[:-1] * LASSO, 0.05), 0)
    full = np.zeros(BUCKETS, np.float32)
    full[active] = weights
    return Model(float(bias), full)


def _listed(batch: pa.RecordBatch) -> pa.Table:
    tables = []
    for part in text_slices(batch, "content"):
        number, owner = distinct_features(part.column("content"))
        offsets = pa.array(np.searchsorted(owner, np.arange(len(part) + 1)).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(number.astype(np.int32)))
        tables.append(pa.table({"toxic": part.column("toxic"), "features": lists}))
    return pa.concat_tables(tables)


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, unlabelled_rows: int = UNLABELLED_ROWS) -> Model:
    """Fit on at most `toxic_rows` toxic and `unlabelled_rows` unlabelled texts, none of them held out.

    The toxic share is taken from the labelled rows outside the held-out fold, and is taken to be one half
    at most. Features that occur in fewer than LEAST_TEXTS or in more than half of the texts are not used.
    Ids are sampled, each once however often it is repeated, and of rows that share an id the text with the
    least digest stands for all; rows without an id are named by the digest of their text. Without toxic or
    without other texts nothing can be learned: every score is then the share itself (0 without labels).
    """
    known = training_labels(labels, "toxic").cache()
    try:
        marked, total = known.agg(F.sum("label"), F.count(F.lit(1))).first()
        prior = min(max((marked or 0) / max(total, 1), 1e-9), 0.5)
        nothing = Model(float(np.log(prior / (1 - prior))), np.zeros(BUCKETS, np.float32))
        content = whole_text("text")
        name = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.sha2(content, 256)))
        rows = docs.where(~held_out()).select(name.alias("name"), content.alias("content"))
        toxic_ids = first_by_hash(known.where("label = 1").select(F.col("doc_id").cast("long").alias("name")), toxic_rows, "name")
        other_ids = first_by_hash(rows.select("name"), unlabelled_rows, "name")
        ids = toxic_ids.withColumn("toxic", F.lit(True)).unionByName(other_ids.withColumn("toxic", F.lit(False)))
        sample = one_text_per_id(rows, ids, "name", "content").select("toxic", "content")
        table = sample.mapInArrow(by_batch(_listed), "toxic boolean, features array<int>").toArrow()  # as many rows as the two bounds allow
    finally:
        known.unpersist()
    toxic = table.column("toxic").to_numpy().astype(bool)
    if not toxic.any() or toxic.all():
        return nothing
    lists = table.column("features").combine_chunks()
    del table
    owner = np.repeat(np.arange(len(toxic), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    model = fit(lists.flatten().to_numpy(), owner, toxic, prior)
    del lists, owner
    hand_back(at_once=True)  # the driver lives on: what the fit held is not needed again
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "toxicity") -> DataFrame:
    """The table with a score from 0 to 1 in a new column, from the whole text alone; null counts as empty.

    An empty text has the score of a text without any known word. Other columns are passed on; one that is
    named `out` is replaced. Rows are scored one by one, so repeated rows and ties do not matter.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a few MB, whatever the input

    def work(texts: pa.Array) -> pa.Array:
        return pa.array(sigmoid(shipped.value.logits(texts)))

    return docs.withColumn(out, arrow_column(work, "double")(whole_text(text_col)))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(session(spark), sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    scored = score(docs.select("doc_id", "text"), model, out="score")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
