"""Checks and enrichment along documented references."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1 / 200


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Referenced keys that have no parent, with the number of child rows.

    Both sides are reduced to one row per key before they meet, so hot keys do not matter.
    A null reference points nowhere and is no orphan.
    """
    used = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("child_rows"))
    known = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return used.join(known, child_key, "left_anti")


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``share`` of all keyed rows; there are fewer than ``1 / share``.

    The total comes from the counts per key, so the input is read once for both.
    """
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = per_key.agg(F.sum("_n")).scalar()
    return per_key.where(F.col("_n") > total * F.lit(share)).select(key)


def enrich(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, fan_out: int = 64
) -> DataFrame:
    """Every child row with its parent's columns, null where there is none.

    ``parent`` holds each key once (see ``latest_record``).  Rows of hot keys, and rows
    without a key, are spread over ``fan_out`` partitions by the task that read them; the
    few hot parents are repeated to match.  The spread depends on the input split and not on
    row contents, so identical copies are spread as well and a re-run task repeats itself.
    """
    hot = F.broadcast(hot_keys(child, child_key).withColumn("_hot", F.lit(True)))
    lane = F.pmod(F.spark_partition_id(), F.lit(fan_out))
    spread = F.col("_hot").isNotNull() | F.col(child_key).isNull()
    left = child.join(hot, child_key, "left").withColumn(
        "_lane", F.when(spread, lane).otherwise(F.lit(0))
    ).drop("_hot")
    lanes = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(fan_out - 1))).otherwise(F.array(F.lit(0)))
    named = parent.withColumnRenamed(parent_key, child_key)
    right = named.join(hot, child_key, "left").withColumn("_lane", F.explode(lanes)).drop("_hot")
    return left.join(right, [child_key, "_lane"], "left").drop("_lane")
