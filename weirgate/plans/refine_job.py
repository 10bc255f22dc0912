"""Silver tables: flat current records and child tables, written as snapshots."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.operators.quality import duplicate_keys
from weirgate.operators.refine import FieldPath, explode_field, flatten
from weirgate.session import remove, replace_folder
from weirgate.spec import Layout

LINEAGE = ("_source_id", "_ingestion_id", "_ingestion_timestamp")


def build_silver(
    current: DataFrame, layout: Layout, table: str, fields: Sequence[FieldPath], arrays: Sequence[str] = ()
) -> list[str]:
    """Write ``table`` and one child table per array field from the current documents.

    The current documents cost a shuffle of the whole dataset, so with child tables they are
    kept on executor disks for the duration instead of being worked out once per table.
    Each table is written beside the one it replaces.  The main table must have each key once: with a repeated key
    nothing is replaced.
    """
    spark, staged = current.sparkSession, []

    def write(df: DataFrame, name: str) -> None:
        path = f"{layout.silver(name)}.{uuid.uuid4().hex}"
        staged.append((path, name))
        df.write.parquet(path)

    if arrays:
        current = current.persist(StorageLevel.DISK_ONLY)
    try:
        write(flatten(current, fields, keep=LINEAGE), table)
        assert_unique(spark.read.parquet(staged[0][0]))
        for path in arrays:
            write(explode_field(current, path), f"{table}_{path.replace('.', '_')}")
        for path, name in staged:
            replace_folder(spark, path, layout.silver(name))
    finally:
        for path, _ in staged:
            remove(spark, path)
        if arrays:
            current.unpersist()
    return [name for _, name in staged]


def assert_unique(df: DataFrame, key: str = "_source_id") -> None:
    n = duplicate_keys(df, [key]).agg(F.count(F.lit(1))).first()[0]
    if n:
        raise AssertionError(f"{n} keys occur more than once")
