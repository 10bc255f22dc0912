"""Bounded samples for fitting and measuring, the same rows in every run."""

from __future__ import annotations

import math

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SPACE = 1 << 62


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether ``crc32(doc_id as text)`` leaves the remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus == remainder


def _place(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(SPACE - 1))


def first_by_hash(rows: DataFrame, key: str, size: int) -> DataFrame:
    """At most ``size`` rows, the first by hash of their key.

    A cut by hash, set from the number of rows, leaves a few times ``size`` before any row is moved, so what
    is gathered does not grow with the table.
    """
    total = rows.count()
    cut = SPACE if total <= 4 * size else int(SPACE * (4 * size / total))
    return rows.where(_place(F.col(key)) < cut).orderBy(_place(F.col(key)), key).limit(size)


def first_per_class(rows: DataFrame, label: str, key: str, size: int) -> tuple[DataFrame, dict]:
    """At most ``size`` rows of each class by hash of their key, numbered from 1 as ``rank``, and the number
    of rows of each class.  Give it narrow rows: they are shuffled."""
    counts = {r[0]: r["count"] for r in rows.groupBy(label).count().collect()}
    cuts = [F.lit(False)] + [
        (F.col(label) == F.lit(value)) & (_place(F.col(key)) < math.ceil(SPACE * min(1.0, 4 * size / n)))
        for value, n in counts.items()
    ]
    near = rows.where(_any(cuts))
    order = Window.partitionBy(label).orderBy(_place(F.col(key)), key)
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size), counts


def _any(conditions: list[Column]) -> Column:
    """Their disjunction as a balanced tree, so that many classes do not nest deeply."""
    while len(conditions) > 1:
        conditions = [
            conditions[i] | conditions[i + 1] if i + 1 < len(conditions) else conditions[i]
            for i in range(0, len(conditions), 2)
        ]
    return conditions[0]


_WORDS = 1 << 17


def sieve(ids: DataFrame, column: str) -> Broadcast:
    """A bit array of fixed size (1 MB) that lets all of the ids through, and with them others of equal low bits.

    With it a scan leaves most rows that no later join wants before they are moved.  When there are more ids
    than bits it lets more through; the join decides in any case.
    """
    word = F.shiftright(F.col(column), 6).bitwiseAND(F.lit(_WORDS - 1).cast("long")).alias("word")
    bit = F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit")
    set_bits = ids.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    mesh = np.zeros(_WORDS, np.uint64)
    mesh[set_bits.column("word").to_numpy()] = set_bits.column("bits").to_numpy().view(np.uint64)
    return ids.sparkSession.sparkContext.broadcast(mesh)


def passing(mesh: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids the sieve lets through."""
    values = ids.astype(np.int64)
    return (mesh[(values >> 6) & (_WORDS - 1)] >> (values & 63).astype(np.uint64)) & np.uint64(1) > 0
