"""Line files, CSV and day-partitioned Parquet."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weirgate.session import path_exists

# Day partitions as Spark writes them, and nested by year and month.
BY_DAY = "dt=%Y-%m-%d"
BY_YEAR_MONTH_DAY = "%Y/%Y-%m/%Y-%m-%d"

# What a CSV read assumes unless told otherwise.
CSV_DEFAULTS = {"header": True, "inferSchema": True, "sep": ",", "encoding": "UTF-8"}


def read_lines(spark: SparkSession, *paths: str, pattern: str | None = None) -> DataFrame:
    """Landing lines kept verbatim, with their file; blank lines are no documents.

    Every file is read that Spark does not hide, whatever its ending; ``pattern`` narrows them by name.
    Reading text rather than JSON means no inference pass and no rewriting: one document
    never depends on its neighbours.
    """
    options = {"recursiveFileLookup": "true"} | ({"pathGlobFilter": pattern} if pattern else {})
    return with_source(spark.read.options(**options).text(list(paths)))


def with_source(lines: DataFrame) -> DataFrame:
    kept = lines.select("value", F.col("_metadata.file_path").alias("_source_file"))
    return kept.where(F.trim(F.col("value")) != "")


def read_run_lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines of all runs that were landed below ``root``, with their file and ``run_id``; other folders stay out."""
    reader = spark.read.schema("value string, run_id string").option("basePath", root)
    lines = reader.text(f"{root}/run_id=*").withColumn("_source_file", F.col("_metadata.file_path"))
    return lines.where(F.trim(F.col("value")) != "")


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, **options: Any) -> DataFrame:
    """CSV with defaults and per-call overrides; a given schema switches inference off."""
    merged = {**CSV_DEFAULTS, **options}
    if schema is not None:
        merged.pop("inferSchema")
    reader = spark.read.options(**merged)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_days(spark: SparkSession, path: str, first: str, last: str, day: str = "dt") -> DataFrame:
    """Day partitions from ``first`` to ``last`` inclusive; absent days are simply absent.

    The range prunes partitions before any file is opened.  Schemas of different days merge.
    """
    table = spark.read.option("mergeSchema", "true").parquet(path)
    return table.where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def day_folders(spark: SparkSession, root: str, first: dt.date, last: dt.date, layout: str = BY_DAY) -> list[str]:
    """Folders of the days from ``first`` to ``last`` that exist; only these get listed."""
    days = (first + dt.timedelta(days=n) for n in range((last - first).days + 1))
    folders = [f"{root}/{day.strftime(layout)}" for day in days]
    return [folder for folder in folders if path_exists(spark, folder)]


def read_day_folders(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """Parquet of the given day folders below ``root``, schemas merged."""
    return spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*folders)
