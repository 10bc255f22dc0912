"""Table snapshots by day, their manifest, and consolidation into deduplicated tables.

Fixed values: a table is reported as OK, SKIP or ERRO.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weirgate.functions.columns import sanitize_columns
from weirgate.functions.json_values import document
from weirgate.operators.latest import deduplicate
from weirgate.schemas import CONSOLIDATION_DDL, MANIFEST_DDL
from weirgate.session import folder_names, folder_size, move, remove, small_frame
from weirgate.sources.files import BY_DAY, day_folders, read_day_folders


DOCUMENTS_MAX = 10_000


def with_audit(df: DataFrame, run_id: str, source_table: str, at: dt.datetime) -> DataFrame:
    return df.withColumns({
        "_run_id": F.lit(run_id),
        "_source_table": F.lit(source_table),
        "_ingested_at": F.lit(at.isoformat()),
    })


def export_by_day(df: DataFrame, path: str, day: Column, single_file_rows: int = 0) -> None:
    """Parquet by day.

    Rows are gathered per day, and a day too large for one file is split by Spark at run
    time.  A table of at most ``single_file_rows`` rows becomes one file.
    """
    dated = df.withColumn("dt", day)
    small = single_file_rows > 0 and df.limit(single_file_rows + 1).count() <= single_file_rows
    shaped = dated.coalesce(1) if small else dated.hint("rebalance", "dt")
    shaped.write.mode("overwrite").partitionBy("dt").parquet(path)


def snapshot_tables(
    spark: SparkSession, tables: dict[str, DataFrame], root: str, run_id: str, at: dt.datetime,
    source: tuple[str, str, str] = ("", "", ""),
) -> DataFrame:
    """Export whole tables under the day of the run and return the manifest of the batch.

    Row counts are taken while writing.  A table that raises becomes an error row.
    """
    catalog, schema, database = source
    rows = []
    for name, df in sorted(tables.items()):
        begun = time.monotonic()
        path = f"{root}/{name}/dt={at.date().isoformat()}"
        count, size, problem = None, None, ""
        try:
            seen = Observation(name)
            audited = with_audit(df, run_id, ".".join(p for p in (catalog, schema, name) if p), at)
            audited.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
            count, size = seen.get["rows"], folder_size(spark, path)
        except Exception as error:
            problem = str(error)[:500]
        rows.append((
            run_id, at.isoformat(), catalog, schema, database, name, "ERRO" if problem else "OK", count,
            name, path, size, round(time.monotonic() - begun, 2), problem,
        ))
    return small_frame(spark, rows, MANIFEST_DDL)


def append_manifest(manifest: DataFrame, path: str) -> None:
    manifest.coalesce(1).write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All batches; columns that came later are null in earlier ones."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_named_file(df: DataFrame, path: str, file_format: str = "parquet", **options: str) -> None:
    """All rows as the one file ``path``, for tables small enough for one task.

    Spark writes and commits into a folder beside it; then the file gets its name by a rename, so the name stands for
    a whole file or for none, whatever happens to the task.
    """
    spark, folder = df.sparkSession, f"{path}.{uuid.uuid4().hex}"
    try:
        df.coalesce(1).write.format(file_format).options(**options).save(folder)
        (part,) = [name for name in folder_names(spark, folder) if name.startswith("part-")]
        move(spark, f"{folder}/{part}", path)
    finally:
        remove(spark, folder)


def export_named_documents(df: DataFrame, folder: str, key: str, most: int) -> list[str]:
    """The first ``most`` documents by key, each as the file ``<key>.json``; returns the files' names.

    One task writes each document into a folder of its name; after the commit the files are moved, so a failed job
    leaves none.  ``most`` bounds the renames.
    """
    if not 0 < most <= DOCUMENTS_MAX:
        raise ValueError(f"between 1 and {DOCUMENTS_MAX} documents")
    spark, staged = df.sparkSession, f"{folder}/_staged-{uuid.uuid4().hex}"
    first = df.where(F.col(key).isNotNull()).orderBy(key).limit(most)
    named = first.select(F.col(key).cast("string").alias("_name"), document(df).alias("value"))
    try:
        named.repartition(min(most, 32), "_name").write.partitionBy("_name").text(staged)
        names = []
        for name in folder_names(spark, staged):
            if name.startswith("_name="):
                parts = [p for p in folder_names(spark, f"{staged}/{name}") if p.startswith("part-")]
                target = f"{name.removeprefix('_name=')}.json"
                move(spark, f"{staged}/{name}/{parts[0]}", f"{folder}/{target}")
                names.append(target)
        return sorted(names)
    finally:
        remove(spark, staged)


def export_documents(df: DataFrame, path: str, most: int, per_file: int = 1) -> None:
    """The first ``most`` documents as JSON files of ``per_file`` documents each."""
    df.limit(most).write.mode("overwrite").option("maxRecordsPerFile", per_file).json(path)


def consolidate(
    spark: SparkSession, tables: dict[str, str], first: dt.date, last: dt.date, target_root: str,
    keys: dict[str, Sequence[str]] | None = None, layout: str = BY_DAY,
) -> DataFrame:
    """Day ranges of exported tables into deduplicated tables; one result row per table.

    A table without files in the range is skipped, one that raises does not stop the others.
    Both row counts come from file footers.
    """
    rows = []
    for name, path in sorted(tables.items()):
        target = f"{target_root}/{name}"
        try:
            folders = day_folders(spark, path, first, last, layout)
            if not folders:
                rows.append((name, "SKIP", 0, 0, 0, target, ""))
                continue
            raw = sanitize_columns(read_day_folders(spark, path, folders)).drop("dt")
            deduplicate(raw, (keys or {}).get(name)).write.mode("overwrite").parquet(target)
            kept = spark.read.parquet(target).count()
            rows.append((name, "OK", len(raw.inputFiles()), raw.count(), kept, target, ""))
        except Exception as problem:
            rows.append((name, "ERRO", 0, 0, 0, target, str(problem)[:500]))
    return small_frame(spark, rows, CONSOLIDATION_DDL)
