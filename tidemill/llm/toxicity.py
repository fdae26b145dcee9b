"""Operator 5: a toxicity score by a character n-gram linear classifier with naive Bayes scaled features.

Each text is lower-cased (A-Z) and seen as its overlapping n-grams of code points, hashed to a table. A feature's value is
its share of the text's n-grams times its naive Bayes log-count ratio; a logistic regression on these values, trained on
labelled rows outside the held-out fold, gives the score. Character n-grams catch the inner parts of unseen words.

Defined results: null and empty texts get the score of the intercept alone, as do texts shorter than the shortest n-gram;
without labelled rows of both labels every score is the labels' mean, or 0.5; the threshold follows
the share of the labels among all labelled documents; repeated rows are scored each; other columns
are ignored; an empty table gives no rows. The whole text is scored, however long."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.labelled import fitted, mean_by_text, scored, share_of, sigmoid
from tidemill.llm.tables import read_table
from tidemill.llm.wordhash import LOWER, each, mix

FOLDS, HELD_OUT = 5, 0
#: The bound of the training sample: at most so many labelled rows of each label.
TRAIN_ROWS_PER_LABEL = 1000
ORDERS = (3, 4, 5, 6)
BITS = 18
#: A longer text goes in pieces of so many bytes; features are kept in parts of about so many. Neither changes a result.
PIECE_BYTES, PART_FEATURES = 1 << 20, 1 << 20


def ngrams(raw: np.ndarray, offsets: np.ndarray, orders: tuple[int, ...], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, the hashed n-grams of all texts and where each text's start (and the end)."""
    points = np.frombuffer(LOWER[raw].tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)][offsets]  # in code points
    values = mix(points.astype(np.uint64) + np.uint64(1))
    rolled, out = values, []
    lengths = np.diff(first)
    for n in range(2, max(orders) + 1):
        rolled = rolled[:-1] * np.uint64(0x9E3779B97F4A7C15) + values[n - 1 :]
        if n in orders:
            inside = np.ones(len(rolled) + n - 1, bool)
            for k in range(1, n):  # those that start in the last n-1 places of a text reach into the next one
                inside[np.maximum(first[1:] - k, first[:-1])[lengths > 0]] = False
            h = (rolled ^ (rolled >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - bits)
            out.append((h[inside[: len(rolled)]].astype(np.int32), np.r_[0, np.cumsum(np.maximum(0, lengths - n + 1))]))
    return out


def pieces(raw: np.ndarray, most: int, reach: int) -> Iterator[tuple[np.ndarray, int]]:
    """One text's bytes in pieces of about ``most``, cut between code points: each with the ``reach`` code points after it, and how many
    code points are its own. The n-grams that start at these, of all pieces, are those of the text."""
    at = 0
    while at < len(raw):
        end = min(len(raw), at + most)
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end += 1
        after = raw[end : end + 4 * (reach + 1)]
        starts = np.flatnonzero((after & 0xC0) != 0x80)
        yield raw[at : end + (int(starts[reach]) if len(starts) > reach else len(after))], int(((raw[at:end] & 0xC0) != 0x80).sum())
        at = end


def of_one_text(raw: np.ndarray, orders: tuple[int, ...], bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """The hashed n-grams of one text, piece by piece, and the place of their order among ``orders``."""
    for piece, own in pieces(raw, PIECE_BYTES, max(orders) - 1):
        for k, (h, _) in enumerate(ngrams(piece, np.array([0, len(piece)]), orders, bits)):
            yield k, h[:own]


def counted(raw: np.ndarray, orders: tuple[int, ...], bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, the different hashed n-grams of one text and how often each is there."""
    if 0 < len(raw) <= PIECE_BYTES:
        return [np.unique(h, return_counts=True) for k, h in of_one_text(raw, orders, bits)]
    tables = np.zeros((len(orders), 1 << bits), np.int64)
    for k, h in of_one_text(raw, orders, bits):
        tables[k] += np.bincount(h, minlength=1 << bits)
    return [(keys := np.flatnonzero(t), t[keys]) for t in tables]


@dataclass(frozen=True)
class Model:
    orders: tuple[int, ...]
    bits: int
    weights: np.ndarray  # a row for each order
    intercept: float

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.full(len(offsets) - 1, self.intercept)
        if len(raw) > PIECE_BYTES and len(total) == 1:
            sums, counts = np.zeros(len(self.orders)), np.zeros(len(self.orders))
            for k, h in of_one_text(raw, self.orders, self.bits):
                sums[k] += self.weights[k][h].sum(dtype=np.float64)
                counts[k] += len(h)
            total += (sums / np.maximum(1, counts)).sum()
        elif len(raw):
            for w, (h, firsts) in zip(self.weights, ngrams(raw, offsets, self.orders, self.bits), strict=True):
                total += mean_by_text(w[h], firsts)
        return sigmoid(total)


@dataclass(frozen=True)
class Part:
    """The features of some texts of a sample, from number ``first`` on: their n-grams (``column``), shares and numbers of them."""

    first: int
    column: np.ndarray
    share: np.ndarray
    sizes: np.ndarray

    @property
    def rows(self) -> slice:
        return slice(self.first, self.first + len(self.sizes))

    def by_text(self, values: np.ndarray) -> np.ndarray:
        total, some = np.zeros(len(self.sizes)), self.sizes > 0
        if some.any():
            total[some] = np.add.reduceat(values, (np.cumsum(self.sizes) - self.sizes)[some])
        return total

    def spread(self, of_text: np.ndarray) -> np.ndarray:
        return np.repeat(of_text, self.sizes)


@dataclass(frozen=True)
class Sample:
    """The features of a training sample: eight bytes each, in parts, so that a pass over them needs little besides."""

    parts: list[Part]
    labels: np.ndarray
    size: int

    def logits(self, weights: np.ndarray, intercept: float) -> np.ndarray:
        return np.concatenate([p.by_text(p.share * weights[p.column]) for p in self.parts]) + intercept


def features(texts: pa.Array, labels: np.ndarray, orders: tuple[int, ...], bits: int) -> Sample:
    made, columns, shares, sizes = [], [], [], []

    def close() -> None:
        if sizes:
            first = made[-1].rows.stop if made else 0
            made.append(Part(first, np.concatenate([np.zeros(0, np.int32), *columns]), np.concatenate([np.zeros(0, np.float32), *shares]), np.array(sizes)))
            for held in (columns, shares, sizes):
                held.clear()

    for raw in each(texts):
        size = 0
        for k, (keys, counts) in enumerate(counted(raw, orders, bits)):
            columns.append((keys + (k << bits)).astype(np.int32))
            shares.append((counts / max(1, counts.sum())).astype(np.float32))
            size += len(keys)
        sizes.append(size)
        if sum(sizes) > PART_FEATURES:
            close()
    close()
    return Sample(made, labels, len(orders) << bits)


def trained(x: Sample, used: np.ndarray, rounds: int, penalty: float) -> tuple[np.ndarray, float]:
    """Weights of the shares and the intercept: log-count ratios of the texts that are used, then logistic regression on the scaled shares by
    accelerated gradient steps, both labels weighing the same. The others weigh nothing."""
    ratio = np.zeros(x.size)
    for label, sign in ((1, 1), (0, -1)):
        held, chosen = np.ones(x.size), (x.labels == label) & used
        for p in x.parts:
            held += np.bincount(p.column[p.spread(chosen[p.rows])], minlength=x.size)
        ratio += sign * np.log(held / held.sum())
    squares = np.concatenate([p.by_text((p.share * ratio[p.column]) ** 2) for p in x.parts])
    ratio /= np.sqrt(squares[used].mean()) or 1.0
    ones = x.labels[used].mean()
    weight_of = np.where(used, np.where(x.labels == 1, 0.5 / ones, 0.5 / (1 - ones)), 0.0) / used.sum()
    w = last = np.zeros(x.size)
    b = last_b = 0.0
    step = 4.0
    for k in range(rounds):
        ahead = k / (k + 3)
        at, at_b = w + ahead * (w - last), b + ahead * (b - last_b)
        scaled, slope, error_sum = ratio * at, np.zeros(x.size), 0.0
        for p in x.parts:
            column = p.column.astype(np.int64)  # what numpy looks up fastest
            error = (sigmoid(p.by_text(p.share * scaled.take(column)) + at_b) - x.labels[p.rows]) * weight_of[p.rows]
            slope += np.bincount(column, p.share * p.spread(error), minlength=x.size)
            error_sum += error.sum()
        last, last_b = w, b
        w = at - step * (ratio * slope + penalty * at)
        b = at_b - step * error_sum
    return w * ratio, b


def fit(texts: pa.Array, labels: np.ndarray, share: float | None = None, orders: tuple[int, ...] = ORDERS, bits: int = BITS, rounds: int = 24, penalty: float = 1e-4, parts: int = 3) -> Model:
    """The model of the whole sample, its logits put through a curve that is fitted to what models of the other parts say of each part. ``share``:
    how many of all labelled texts have label 1 (default: as in the sample), so that 0.5 is where that label becomes likelier."""
    share = float(labels.mean()) if share is None and len(labels) else share
    if not len(labels) or labels.min() == labels.max():
        mean = min(max(share, 0.01), 0.99) if len(labels) else 0.5
        return Model(orders, bits, np.zeros((len(orders), 1 << bits), np.float32), float(np.log(mean / (1 - mean))))
    x = features(texts, labels, orders, bits)
    part = np.zeros(len(labels), np.int64)
    for label in (0, 1):
        part[labels == label] = np.arange((labels == label).sum()) % parts
    w, b = trained(x, np.ones(len(labels), bool), rounds, penalty)
    said = x.logits(w, b)
    if min((labels == 0).sum(), (labels == 1).sum()) >= parts:
        for k in range(parts):
            own = part == k
            said[own] = x.logits(*trained(x, ~own, rounds, penalty))[own]
    slope, shift = calibrated(said, labels, np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean())) / len(labels))
    return Model(orders, bits, (w * slope).reshape(len(orders), -1).astype(np.float32), float(b * slope + shift))


def calibrated(logits: np.ndarray, labels: np.ndarray, weight_of: np.ndarray, rounds: int = 40) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the logits; the small penalty bounds the slope when they part the labels."""
    scale = max(1e-9, float(logits.std()))
    x = np.stack([logits / scale, np.ones_like(logits)])
    theta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = sigmoid(theta @ x)
        curve = (x * (weight_of * p * (1 - p))) @ x.T + np.diag([1e-4, 1e-6])
        step = np.linalg.solve(curve, x @ (weight_of * (p - labels)) + np.array([1e-4, 1e-6]) * theta)
        theta -= step / max(1.0, float(np.abs(step).max()))
    return max(0.01, float(theta[0])) / scale, float(theta[1])


def toxicity(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_ROWS_PER_LABEL) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``. The model is a table of bounded size, broadcast to the tasks."""
    share = share_of(docs, labels, "toxic", FOLDS, HELD_OUT)
    model = fitted(docs, labels, "toxic", FOLDS, HELD_OUT, per_label, lambda texts, known: fit(texts, known, share))
    return scored(docs, model, FOLDS, HELD_OUT, 0.5)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
