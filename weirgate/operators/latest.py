"""Current record per key, and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_record(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``newest_first``.

    The ``= 1`` filter lets Spark drop all but one row per key in each map task before the
    shuffle, so a key that holds a third of the table costs one row per task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def total_order(df: DataFrame, keys: Sequence[str], first: Sequence[str]) -> list[Column]:
    """Descending order by ``first`` and then by every other column, so ties are settled."""
    rest = [c for c in df.columns if c not in keys and c not in first]
    return [F.col(c).desc() for c in [*first, *rest]]


def latest_bronze(bronze: DataFrame) -> DataFrame:
    """Current document per key: newest ingestion, then highest hash, then last file."""
    newest = [F.col(c).desc() for c in ("_ingestion_timestamp", "_source_hash", "_source_file")]
    return latest_record(bronze, ["_source_id"], newest)


def deduplicate(
    df: DataFrame, keys: Sequence[str] | None = None, audit_order: str = "_ingested_at"
) -> DataFrame:
    """One row per primary key, or per distinct business row when there is no key.

    Columns that begin with ``_`` are audit columns.  The newest by ``audit_order`` wins;
    remaining ties are settled by the other columns.
    """
    business = [c for c in df.columns if not c.startswith("_")]
    audit = [c for c in df.columns if c.startswith("_")]
    if not keys and not audit:
        return df.dropDuplicates()
    chosen = list(keys) if keys else business
    first = [audit_order] if audit_order in df.columns else []
    order = total_order(df, chosen, first)
    return latest_record(df, chosen, order) if order else df.dropDuplicates(chosen)


def dedup_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows read, kept and removed, by way of one pre-aggregated pass."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_read"), F.count(F.lit(1)).alias("rows_kept")
    )
    return totals.withColumn("rows_removed", F.col("rows_read") - F.col("rows_kept"))
