"""Language by string kernels: blended-spectrum presence kernels, Nyström landmarks, ridge regression.

The kernel of two texts counts the character n-grams (orders ``ORDERS`` together, hashed) that both hold, over
the root of the product of their numbers.  Landmark texts span the feature space; one-versus-rest kernel ridge
regression is solved in it.  A text's decision values are a product of its presence row with the landmark
matrix and the regression's coefficients, taken for a batch of texts at a time.

Fitted on at most ``PER_CLASS`` texts of each language, ``LANDMARKS`` of them landmarks, the first by hash of
their id; whatever the table's size, that is what the driver holds.  Texts that are null or have no letter are
``und`` with score 0 and are never learned from; nor are rows without a language.  Repeated rows get equal
answers.  An empty table gives an empty result; with nothing to learn from every text is ``und``.  Other
columns are not read.  Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.llm import grams
from weirgate.llm import text as tx
from weirgate.llm.sampling import first_per_class
from weirgate.session import work_dir

ORDERS = (2, 3, 4)
PER_CLASS = 400
LANDMARKS = 40
RIDGE = 1e-3
SHARPNESS = 4.0
UNKNOWN = "und"
LETTER = r"\pL"


class Model(NamedTuple):
    """``weights`` has a row per bucket and a column per language: the landmarks times their coefficients."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def decisions(self, texts: pa.Array) -> np.ndarray:
        found = grams.presence(texts, ORDERS)
        scale = np.sqrt(np.maximum(found.sizes(), 1))[:, None]
        return found.product(self.weights) / scale + self.bias


def fit(train: DataFrame) -> Model:
    """``train`` has doc_id, text and lang."""
    spark = train.sparkSession
    known = train.where(F.col("lang").isNotNull() & F.col("text").rlike(LETTER))
    ids, counts = first_per_class(known.select("doc_id", "lang"), "lang", "doc_id", PER_CLASS)
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((grams.BUCKETS, 0), np.float32), np.zeros(0))
    path = work_dir(spark, "language-sample")
    # the chosen ids are at most PER_CLASS for each language
    wanted = F.broadcast(ids.select(F.col("doc_id").alias("chosen"), "rank", F.col("lang").alias("class")))
    same = F.col("doc_id").eqNullSafe(F.col("chosen")) & (F.col("lang") == F.col("class"))
    known.join(wanted, same).select("doc_id", "text", "lang", "rank").dropDuplicates(["lang", "rank"]).write.parquet(path)
    sample = spark.read.parquet(path)

    def bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.slices(batches, "text", grams.SLICE_BYTES):
            found = grams.presence(piece.column("text"), ORDERS)
            bits = []
            for first, last in zip(found.starts[:-1], found.starts[1:]):
                row = np.zeros(grams.BUCKETS, bool)
                row[found.buckets[first:last]] = True
                bits.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(bits, pa.binary())], ["bits"])

    marks = sample.where(F.col("rank") <= LANDMARKS).mapInArrow(bitmaps, "bits binary").collect()
    landmarks = np.stack([np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in marks], axis=1)  # bucket x mark
    sizes = np.sqrt(np.maximum(landmarks.sum(axis=0, dtype=np.int64), 1))
    shared = spark.sparkContext.broadcast(landmarks)

    def kernel_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.slices(batches, "text", grams.SLICE_BYTES):
            found = grams.presence(piece.column("text"), ORDERS)
            rows = found.product(shared.value) / np.sqrt(np.maximum(found.sizes(), 1))[:, None] / sizes
            yield pa.RecordBatch.from_arrays(
                [piece.column("lang"), pa.array(list(rows), pa.list_(pa.float64()))], ["lang", "row"]
            )

    rows = sample.select("text", "lang").mapInArrow(kernel_rows, "lang string, row array<double>").toArrow()
    kernel = np.array(rows.column("row").to_pylist())
    target = np.where(np.array(rows.column("lang").to_pylist())[:, None] == np.array(languages), 1.0, -1.0)
    counted = landmarks.astype(np.float32)
    values, vectors = np.linalg.eigh((counted.T @ counted).astype(np.float64) / np.outer(sizes, sizes))
    kept = values > 1e-8 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])  # Nyström: kernel rows to coordinates
    features = kernel @ root
    middle, mean = features.mean(axis=0), target.mean(axis=0)
    centred = features - middle
    solved = np.linalg.solve(
        centred.T @ centred + RIDGE * len(kernel) * np.eye(centred.shape[1]), centred.T @ (target - mean)
    )
    weights = counted @ ((root @ solved) / sizes[:, None]).astype(np.float32)
    shared.unpersist()
    return Model(languages, weights.astype(np.float32), mean - middle @ solved)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: ``lang_pred`` and ``score``, the share of the chosen language among softened decision values."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for piece in tx.slices(batches, "text", grams.SLICE_BYTES):
            texts = piece.column("text")
            known = pc.fill_null(pc.match_substring_regex(texts, LETTER), False).to_numpy(zero_copy_only=False)
            best, score = np.array([UNKNOWN] * len(texts), dtype=object), np.zeros(len(texts))
            if model.languages and known.any():
                values = SHARPNESS * model.decisions(texts.filter(pa.array(known)))
                shares = np.exp(values - values.max(axis=1, keepdims=True))
                best[known] = np.array(model.languages, dtype=object)[values.argmax(axis=1)]
                score[known] = shares.max(axis=1) / shares.sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), pa.array(best, pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text", "held_out").mapInArrow(
        classify, "doc_id long, held_out boolean, lang_pred string, score double"
    )
