"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

The classifier is fitted in one executor task on a bounded sample of labelled rows (``MAX_LABELLED``,
chosen by a hash of the doc_id); everything else runs over all rows. Per-coordinate rates come from
FTRL-proximal, and its L1 term leaves few weights above zero, so the model is a short list whose
size is bounded by ``2 ** BITS``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import fold

BITS = 20
MAX_LABELLED = 18_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 4.0, 1.0, 4.0, 0.1
FOLDS = 5
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
#: (words between the two words of a pair, multiplier); the first is the bigram.
_PAIRS = ((0, 0x9E3779B97F4A7C15), (1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9))


def features(text: bytes | None) -> np.ndarray:
    """Distinct hashed indices of the words, bigrams and skip-grams of a whole UTF-8 text."""
    words = (text or b"").lower().translate(None, _PUNCTUATION).split()
    hashes = np.fromiter(map(crc32, words), np.uint64, len(words))
    parts = [hashes * np.uint64(0xD6E8FEB86659FD93)]
    for gap, factor in _PAIRS:
        if len(hashes) > gap + 1:
            parts.append((hashes[: -gap - 1] * np.uint64(factor) + hashes[gap + 1 :]) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(factor))
    return np.concatenate(parts) >> np.uint64(64 - BITS)


def ftrl(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes over (distinct indices, label); the last one is the bias."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    bias = np.array([size - 1])

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        w = -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(zs) <= L1] = 0
        w[-1] = -zs[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA)  # no penalty on the bias
        return w

    for _ in range(epochs):
        for indices, label in rows:
            at = np.append(indices, bias)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            if abs(g) < 1e-3:
                continue
            root = np.sqrt(n[at])
            z[at] += g - (np.sqrt(n[at] + g * g) - root) / ALPHA * w
            n[at] += g * g
    kept = np.append(np.flatnonzero(np.abs(z[:-1]) > L1), bias)
    out = np.zeros(size)
    out[kept] = weights(kept)
    return out


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows.append((np.unique(features(text)).astype(np.int32), label))
    weights = ftrl(rows) if rows else np.zeros((1 << BITS) + 1)
    at = np.flatnonzero(weights)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(weights[at])], ["feature", "weight"])


def fit(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, max_labelled: int = MAX_LABELLED) -> list[tuple[int, float]]:
    """(feature, weight) of the weights that are not zero. Labels are read only where the fold of
    the doc_id is not 0; a doc_id with several labels counts as toxic if one says so. Rows without
    label or text are left out; without labelled rows the list is empty and every score is 0.5."""
    chosen = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(fold("doc_id", folds) != 0)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    )
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).filter("text IS NOT NULL")
    # at most max_labelled rows of two integers are broadcast
    rows = texts.join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc_id", "text").alias("_at"))
    ordered = rows.repartition(1).sortWithinPartitions("_at").select("text", "toxic")
    return [tuple(r) for r in ordered.mapInArrow(_fit, "feature int, weight double").collect()]


def _scorer(docs: DataFrame, labels: DataFrame, folds: int) -> Callable[[pa.Array], np.ndarray]:
    """Fits the classifier; the function scores an array of UTF-8 texts on the executors."""
    dense = np.zeros((1 << BITS) + 1, np.float32)
    for at, weight in fit(docs, labels, folds):
        dense[at] = weight
    model = docs.sparkSession.sparkContext.broadcast(dense)

    def score(texts: pa.Array) -> np.ndarray:
        weights, logits = model.value, np.empty(len(texts))
        for i, text in enumerate(texts.to_pylist()):
            found = features(text)
            logits[i] = weights[np.unique(found[weights[found] != 0])].sum(dtype=np.float64) + weights[-1]
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))

    return score


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Only the text makes the score. Null and empty texts get the score of the bias alone. Repeated
    rows are scored alike; a null doc_id has the fold of an empty text. Other columns are ignored.
    """
    score = _scorer(docs, labels, folds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = score(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    given = docs.select(F.col("doc_id").cast("long"), (fold("doc_id", folds) == 0).alias("held_out"), F.col("text").cast("binary"))
    return given.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns. Each row is judged
    by its own text, whatever its doc_id."""
    score = _scorer(docs, labels, folds)

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(score(texts))

    return docs.filter(scored(F.col("text").cast("binary")) < 0.5)
