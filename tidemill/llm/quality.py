"""Operator 8: a quality score by logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text is a sequence of tokens: runs of letters, digits and non-ASCII characters, and runs of other visible characters.
Its unigrams and bigrams are hashed to a table (bigrams of one word twice share an entry); a feature's value is its share of the text's n-grams of that length. The
weights are those of per-coordinate FTRL-Proximal (a few passes over the bounded sample, in a fixed order); the score is
the logistic of the sparse dot product.

Defined results: null, empty and blank texts get the score of the intercept alone; without labelled rows of both labels every
score is the labels' mean, or 0.5; repeated rows are scored each; other columns are ignored; an empty table gives no rows.
The whole text is scored, however long."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.labelled import fitted, mean_by_text, scored, sigmoid
from tidemill.llm.tables import read_table
from tidemill.llm.wordhash import blocks, each, joined, word_hashes

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.7
#: The bound of the training sample: at most so many labelled rows of each label.
TRAIN_ROWS_PER_LABEL = 1500
BITS = 18
#: Shares are small numbers; this brings a text's features to a usual size.
SCALE = 30.0

_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = 2
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the tokens, and the number of each text's first one (and the end)."""
    kind = _KIND[raw]
    change = np.ones(len(raw) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    at = np.flatnonzero(change)
    keep = kind[at[:-1]] > 0
    starts = at[:-1][keep]
    return starts, at[1:][keep], np.searchsorted(starts, offsets)


def features(raw: np.ndarray, offsets: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed unigrams and bigrams, and where each text's start (and the end)."""
    starts, ends, firsts = tokens(raw, offsets)
    one = word_hashes(raw, starts, ends)
    two, lengths = joined(one, 2), np.diff(firsts)
    two[one[:-1] == one[1:]] = 1  # a word said twice is one feature, whatever the word
    inside = np.ones(len(one), bool)
    inside[firsts[1:][lengths > 0] - 1] = False
    shift = np.uint64(64 - bits)
    return [((one >> shift).astype(np.int32), firsts), ((two[inside[: len(two)]] >> shift).astype(np.int32), np.r_[0, np.cumsum(np.maximum(0, lengths - 1))])]


@dataclass(frozen=True)
class Model:
    bits: int
    weights: np.ndarray  # two rows
    intercept: float

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.full(len(offsets) - 1, self.intercept)
        if len(raw):
            for w, (h, firsts) in zip(self.weights, features(raw, offsets, self.bits), strict=True):
                total += SCALE * mean_by_text(w[h], firsts)
        return sigmoid(total)


def fit(texts: pa.Array, labels: np.ndarray, bits: int = BITS, passes: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.002, l2: float = 0.02) -> Model:
    if not len(labels) or labels.min() == labels.max():
        mean = min(max(labels.mean(), 0.01), 0.99) if len(labels) else 0.5
        return Model(bits, np.zeros((2, 1 << bits), np.float32), float(np.log(mean / (1 - mean))))
    rows = []
    for raw in each(texts):
        columns, values = [np.array([2 << bits])], [np.ones(1)]  # the intercept is the last feature
        for k, (h, _) in enumerate(features(raw, np.array([0, len(raw)]), bits) if len(raw) else ()):
            found, counts = np.unique(h, return_counts=True)
            columns.append(found + (k << bits))
            values.append(SCALE * counts / max(1, len(h)))
        rows.append((np.concatenate(columns), np.concatenate(values)))
    z, n = np.zeros((2 << bits) + 1), np.zeros((2 << bits) + 1)

    def weights(at):
        zs = z[at]
        return np.where(np.abs(zs) <= l1, 0.0, (np.sign(zs) * l1 - zs) / ((beta + np.sqrt(n[at])) / alpha + l2))

    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    for k in range(passes):
        for i in np.random.default_rng(k).permutation(len(rows)):
            at, x = rows[i]
            w = weights(at)
            g = (sigmoid(w @ x) - labels[i]) * balance[i] * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(slice(None))
    return Model(bits, w[:-1].reshape(2, -1).astype(np.float32), float(w[-1]))


def quality(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_ROWS_PER_LABEL) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``. The model is a table of bounded size, broadcast to the tasks."""
    model = fitted(docs, labels, "quality", FOLDS, HELD_OUT, per_label, fit)
    return scored(docs, model, FOLDS, HELD_OUT, THRESHOLD)


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns. One pass: texts are scored where they lie. Without
    labelled rows of both labels there is no classifier, and all rows stay."""
    model = fitted(docs, labels, "quality", FOLDS, HELD_OUT, TRAIN_ROWS_PER_LABEL, fit)
    if not model.weights.any():
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        parts = [shared.value(raw, offsets) for _, raw, offsets in blocks(column)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return docs.where(score("text") >= THRESHOLD)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
