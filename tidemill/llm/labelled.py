"""What the two trained classifiers share: folds by checksum, the bounded training sample, scoring by batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.tables import texts
from tidemill.llm.wordhash import blocks


def fold(doc_id: str, folds: int) -> F.Column:
    """The fold of a row: the CRC-32 of its id as text, modulo the number of folds. A null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(0))


def known_labels(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """``doc_id`` and ``label`` (0 or 1) outside the held-out fold, of documents that are there. Ids alone are read of the documents."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold("doc_id", folds) != held_out)).select("doc_id", F.col(label).cast("int").alias("label"))
    return usable.join(docs.select("doc_id"), "doc_id", "left_semi")


def share_of(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int) -> float | None:
    """The share of label 1 among all rows that may be learnt from; none without any."""
    return known_labels(docs, labels, label, folds, held_out).agg(F.avg("label")).first()[0]


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_label: int) -> DataFrame:
    """``text`` and ``label`` (0 or 1) of labelled rows outside the held-out fold, at most ``per_label`` rows of each label.

    The rows are those of the smallest hash of the id, whatever the partitioning, among labels that have a document. They are chosen
    by ids alone, so that only they are looked for in the texts; their number is bounded and so is the broadcast. Of several
    documents of one id that with the smallest hash of its text is taken, before anything is collected. Contradicting labels
    of one id are two rows."""
    usable = known_labels(docs, labels, label, folds, held_out)
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = usable.where("label = 0").orderBy(*order).limit(per_label).unionByName(usable.where("label = 1").orderBy(*order).limit(per_label))
    found = texts(docs).join(F.broadcast(chosen.distinct()), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", "label")


def collected(sample: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """The bounded sample's texts and labels on the driver, in a fixed order."""
    table = sample.toArrow()
    if not table.num_rows:
        return pa.array([], pa.large_string()), np.zeros(0)
    table = table.sort_by([("doc_id", "ascending"), ("label", "ascending"), ("text", "ascending")]).combine_chunks()
    return table.column("text").combine_chunks(), table.column("label").to_numpy().astype(float)


def scored(docs: DataFrame, score: Callable[[np.ndarray, np.ndarray], np.ndarray], folds: int, held_out: int, threshold: float) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every row. ``score`` gets the bytes and offsets of some texts.
    It travels with its model to each task; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(score)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [shared.value(raw, offsets) for _, raw, offsets in blocks(batch.column("text"))]
            values = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(values, pa.float64())], ["doc_id", "held_out", "score"])

    rows = texts(docs).withColumn("held_out", fold("doc_id", folds) == held_out)
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def mean_by_text(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The mean of each text's values (0 where it has none); ``firsts``: where each text's values start, and the end."""
    total = np.r_[0.0, np.cumsum(values, dtype=np.float64)]
    return (total[firsts[1:]] - total[firsts[:-1]]) / np.maximum(1, np.diff(firsts))


def fitted(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_label: int, fit: Callable):
    """``fit(texts, labels)`` of the bounded training sample."""
    return fit(*collected(training_sample(docs, labels, label, folds, held_out, per_label)))
