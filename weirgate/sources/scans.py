"""Table scans with a mark, an exclusion list and counts."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.functions.json_values import document
from weirgate.functions.marks import newer_than
from weirgate.spec import DatasetSpec

SAMPLE_MAX = 500


def exclude(df: DataFrame, fields: Sequence[str], key: str = "_id") -> DataFrame:
    """Drop wide or sensitive columns before anything reads them; the key stays."""
    return df.drop(*[name for name in fields if name != key])


def scan_incremental(df: DataFrame, spec: DatasetSpec, mark: Any = None, force_full: bool = False) -> DataFrame:
    """Rows past the mark without the excluded columns.

    Filter and column list both reach the source.  A lost task re-reads its own split, so a
    scan needs no resume point.
    """
    if spec.load_type == "incremental" and not force_full:
        df = df.where(
            newer_than(df, spec.mark_field, mark, spec.inclusive_mark, spec.include_null_mark)
        )
    return exclude(df, spec.exclude, spec.key)


def source_count(df: DataFrame, mark_field: str | None = None, mark: Any = None) -> DataFrame:
    return df.where(newer_than(df, mark_field, mark)).agg(F.count(F.lit(1)).alias("n_rows"))


def mark_max(df: DataFrame, mark_field: str, alias: str = "mark_max") -> DataFrame:
    return df.where(F.col(mark_field).isNotNull()).agg(F.max(mark_field).alias(alias))


def mark_range(df: DataFrame, mark_field: str) -> DataFrame:
    """Least and greatest mark, and how many rows carry none."""
    mark = F.col(mark_field)
    return df.agg(
        F.min(mark).alias("mark_min"), F.max(mark).alias("mark_max"), F.count_if(mark.isNull()).alias("without_mark")
    )


def bounded_sample(df: DataFrame, size: int, key: str, excluded: Sequence[str] = ()) -> DataFrame:
    """The first rows by key, between 1 and 500 of them."""
    return exclude(df, excluded, key).orderBy(key).limit(min(max(size, 1), SAMPLE_MAX))


def document_frame(df: DataFrame, key: str) -> DataFrame:
    """Rows as documents: the key as text and the whole row as JSON."""
    return df.select(F.col(key).cast("string").alias("_id"), document(df).alias("body"))


def read_external(
    spark: SparkSession, source_format: str, options: dict[str, Any], key_range: tuple[str, int, int, int] | None = None
) -> DataFrame:
    """A table of any installed connector (JDBC, a document store, ...).

    ``key_range`` is (column, lower, upper, partitions) and splits a JDBC scan by key; the
    bounds only place the splits, rows outside them are still read.
    """
    settings = dict(options)
    if key_range:
        column, lower, upper, parts = key_range
        settings.update(partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=parts)
    return spark.read.format(source_format).options(**settings).load()
