"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Presence of a hashed n-gram is a feature, scaled by the log ratio of its share among toxic and among other
texts.  Logistic regression is fitted on the scaled features and its intercept moved to the true share of toxic
labels.  Fitted on at most ``PER_CLASS`` labelled texts of each class, the first by hash of their id, and on the
``FEATURES`` n-grams whose rates differ most surely; both bounds hold at any size of the table.

Null and empty texts hold no n-gram and get the intercept's score.  Rows without a label of 0 or 1 are not
learned from; a document labelled more than once counts with its largest label.  Repeated rows get equal scores.
An empty table gives an empty result; with one class or none every score is that class's share (0.5 without
labels).  Other columns are not read.  Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm import grams
from weirgate.llm import text as tx
from weirgate.llm.sampling import first_per_class
from weirgate.session import work_dir

ORDERS = (3, 4, 5, 6)
PER_CLASS = 4000
FEATURES = 2048
TASKS = 12
SMOOTHING = 1.0
PENALTY = 1e-4
STEPS = 300


class Model(NamedTuple):
    weights: np.ndarray
    intercept: float

    def score(self, texts: pa.Array) -> np.ndarray:
        margin = grams.presence(texts, ORDERS).product(self.weights[:, None])[:, 0] + self.intercept
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def log_count_ratios(counts: np.ndarray) -> np.ndarray:
    """Of features in rows, for texts of class 0 and 1 in columns."""
    smoothed = counts + SMOOTHING
    shares = smoothed / smoothed.sum(axis=0)
    return np.log(shares[:, 1] / shares[:, 0])


def logistic(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept by gradient steps with momentum, at a step below the curvature's bound."""
    middle = features.mean(axis=0)
    centred = (features - middle).astype(np.float32)
    guess = np.ones(centred.shape[1], np.float32)
    for _ in range(20):  # largest curvature by power iteration
        guess = centred.T @ (centred @ guess)
        guess /= max(float(np.linalg.norm(guess)), 1e-12)
    curvature = float(np.linalg.norm(centred @ guess) ** 2) / len(labels) / 4 + PENALTY
    weights = ahead = np.zeros(centred.shape[1] + 1, np.float32)
    for step in range(STEPS):
        error = 1 / (1 + np.exp(-(centred @ ahead[:-1] + ahead[-1]))) - labels
        slope = np.append(centred.T @ error / len(labels) + PENALTY * ahead[:-1], 0).astype(np.float32)
        slope[-1] = error.mean()
        following = ahead - slope / max(curvature, 0.25)
        ahead = following + step / (step + 3) * (following - weights)
        weights = following
    return weights[:-1], float(weights[-1] - middle @ weights[:-1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """``docs`` has doc_id and text, ``labels`` doc_id and toxic."""
    spark = docs.sparkSession
    marked = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    ids, counts = first_per_class(marked, "toxic", "doc_id", PER_CLASS)
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    nothing = Model(np.zeros(grams.BUCKETS, np.float32), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6))))
    if len(counts) < 2:
        return nothing
    path = work_dir(spark, "toxicity-sample")
    wanted = F.broadcast(ids.select("doc_id", "toxic"))  # at most PER_CLASS for each of two classes
    docs.select("doc_id", "text").join(wanted, "doc_id").repartition(TASKS).write.parquet(path)
    sample = spark.read.parquet(path)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, grams.BUCKETS), np.int32)
        for piece in tx.slices(batches, "text", grams.SLICE_BYTES):
            found = grams.presence(piece.column("text"), ORDERS)
            toxic = np.repeat(piece.column("toxic").to_numpy(zero_copy_only=False), found.sizes())
            for label in (0, 1):
                counts[label] += np.bincount(found.buckets[toxic == label], minlength=grams.BUCKETS).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], ["counts"])

    parts = sample.mapInArrow(sums, "counts binary").collect()  # one fixed-size row for each of TASKS files
    counted = np.sum([np.frombuffer(r["counts"], np.int32).reshape(2, -1) for r in parts], axis=0, dtype=np.int64).T
    sampled = {r[0]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sampled) < 2:
        return nothing
    size = np.array([sampled[0], sampled[1]])
    rates = counted / size
    pooled = counted.sum(axis=1) / size.sum()
    surety = np.abs(rates[:, 1] - rates[:, 0]) / np.sqrt(pooled * (1 - pooled) * (1 / size).sum() + 1e-9)
    chosen = np.sort(np.argsort(-surety, kind="stable")[:FEATURES])
    ratios = log_count_ratios(counted)[chosen]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.slices(batches, "text", grams.SLICE_BYTES):
            found = grams.presence(piece.column("text"), ORDERS)
            bits = []
            for first, last in zip(found.starts[:-1], found.starts[1:]):
                present = np.zeros(grams.BUCKETS, bool)
                present[found.buckets[first:last]] = True
                bits.append(np.packbits(present[chosen]).tobytes())
            yield pa.RecordBatch.from_arrays([piece.column("toxic"), pa.array(bits, pa.binary())], ["toxic", "bits"])

    gathered = sample.mapInArrow(rows, "toxic int, bits binary").toArrow()  # at most 2 * PER_CLASS rows of FEATURES bits
    held = np.stack([np.frombuffer(b, np.uint8) for b in gathered.column("bits").to_pylist()])
    features = np.unpackbits(held, axis=1)[:, : len(chosen)] * ratios.astype(np.float32)
    learned, intercept = logistic(features, gathered.column("toxic").to_numpy())
    weights = np.zeros(grams.BUCKETS, np.float32)
    weights[chosen] = learned * ratios
    prior = np.log(share / (1 - share)) - np.log(size[1] / size[0])
    return Model(weights, intercept + float(prior))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: the probability of label 1, and whether it is at least a half."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.slices(batches, "text", grams.SLICE_BYTES):
            score = shared.value.score(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text", "held_out").mapInArrow(
        classify, "doc_id long, held_out boolean, score double, predicted int"
    )
