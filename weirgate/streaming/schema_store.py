"""The schema of a streamed dataset, kept between micro-batches and between processes.

Each change is a version in a folder of its own, so the newest version is the schema and older ones tell its history.
A batch is repeated only when it was the last, and folding the same batch again adds nothing: replays need no marks.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.rescue import inferred, with_added
from weirgate.session import folder_names, read_table, small_frame

_DDL = "version int, schema string, load_id string"
RESCUE, ADD = "rescue", "add"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name.removeprefix("v")) for name in folder_names(spark, path) if name[1:].isdigit())


def history(spark: SparkSession, path: str) -> DataFrame:
    """All versions: number, schema in JSON notation, the load that brought it."""
    return read_table(spark, path, _DDL, recursiveFileLookup="true")


def newest(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema in force.  A version that was not written whole has no row, and the one before it holds."""
    for number in reversed(_numbers(spark, path)):
        row = read_table(spark, f"{path}/v{number:06d}", _DDL).first()
        if row is not None:
            return T.StructType.fromJson(json.loads(row["schema"]))
    return None


def evolve(batch: DataFrame, path: str, load_id: str, mode: str = RESCUE, body: str = "value") -> T.StructType | None:
    """The schema that a batch loads under.

    The first batch with an object sets it.  Later, ``rescue`` keeps it as it is, without a pass over the batch;
    ``add`` takes up new fields first.  Types that are known never change: what differs is rescued.
    """
    if mode not in (RESCUE, ADD):
        raise ValueError(f"schema mode must be {RESCUE} or {ADD}")
    spark = batch.sparkSession
    stored = newest(spark, path)
    if stored is not None and mode == RESCUE:
        return stored
    seen = inferred(batch, body)
    if seen is None:
        return stored
    wanted = seen if stored is None else with_added(stored, seen)
    if wanted != stored:
        number = max(_numbers(spark, path), default=0) + 1
        row = small_frame(spark, [(number, wanted.json(), load_id)], _DDL)
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/v{number:06d}")
    return wanted


def rescued_counts(bronze: DataFrame) -> DataFrame:
    """Rows with rescued fields for each load, and how often each field was rescued."""
    fields = F.json_object_keys(F.col("_rescued_data"))
    named = bronze.where(F.col("_rescued_data").isNotNull()).select("_ingestion_id", F.explode(fields).alias("field"))
    return named.groupBy("_ingestion_id", "field").agg(F.count(F.lit(1)).alias("rows"))
