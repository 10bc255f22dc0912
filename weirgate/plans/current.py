"""The current record per key of an appended dataset, kept up load by load.

The history stays as it is.  Beside it lies a keyed table into which each load's newest row per key is folded, so a
read costs the current records, not the history.  The table knows the loads it holds; loads that came since are read
from their own folders and put over it, and only keys that they have are compared.  Folding a load twice changes
nothing, so a crash between the fold and its note costs a repetition.  Loads may be folded in any order: the time of
ingestion decides between records, not the order of folding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.operators.latest import latest_bronze
from weirgate.operators.upsert import publish, read_keyed, stage_upsert
from weirgate.plans import bronze
from weirgate.schemas import BRONZE_DDL
from weirgate.session import path_exists, read_table, remove, small_frame
from weirgate.spec import DatasetSpec, Layout

KEY = "_source_id"


def newest_first() -> list[Column]:
    return [F.col(c).desc() for c in ("_ingestion_timestamp", "_source_hash", "_source_file")]


def folded_loads(spark: SparkSession, layout: Layout, dataset: str) -> DataFrame:
    return read_table(spark, f"{layout.current(dataset)}/folded", "_load string")


def pending_loads(spark: SparkSession, layout: Layout, dataset: str, run_log: DataFrame) -> list[str]:
    """Published loads that the table does not hold yet: their names, which prune the history's folders."""
    known = {r["_load"] for r in folded_loads(spark, layout, dataset).collect()}
    return [load for load in bronze.published_loads(run_log, dataset) if load not in known]


def fold_current(spark: SparkSession, layout: Layout, spec: DatasetSpec, run_log: DataFrame) -> int:
    """Fold all pending loads; returns how many there were.  One writer per dataset."""
    path = layout.current(spec.name)
    loads = pending_loads(spark, layout, spec.name, run_log)
    if not loads:
        return 0
    rows = bronze.read_published(spark, layout.bronze(spec.name), loads)
    publish(stage_upsert(rows, path, KEY, newest_first(), spec.rows_per_bucket, newest_first()), path)
    small_frame(spark, [(load,) for load in loads], "_load string").coalesce(1).write.mode("append").parquet(f"{path}/folded")
    return len(loads)


def read_current(spark: SparkSession, layout: Layout, spec: DatasetSpec, run_log: DataFrame) -> DataFrame:
    """Current record per key: the folded table, under the records of loads that are not folded yet."""
    folded = read_keyed(spark, layout.current(spec.name), BRONZE_DDL, newest_first())
    pending = pending_loads(spark, layout, spec.name, run_log)
    if not pending:
        return folded
    fresh = latest_bronze(bronze.read_published(spark, layout.bronze(spec.name), pending))
    keys = fresh.select(KEY)
    touched = latest_bronze(folded.join(keys, KEY, "left_semi").unionByName(fresh))
    return folded.join(keys, KEY, "left_anti").unionByName(touched)


def kept(spark: SparkSession, layout: Layout, dataset: str) -> bool:
    return path_exists(spark, f"{layout.current(dataset)}/folded")


def forget(spark: SparkSession, layout: Layout, dataset: str) -> None:
    """Drop the table, to be folded anew: its loads have been written again."""
    remove(spark, layout.current(dataset))
