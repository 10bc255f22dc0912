"""Batch metrics, reconciliation and accumulated checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions.verdict import judge
from weirgate.spec import FAILED, Limits


def _any_null(keys: Sequence[str]) -> Column:
    absent = F.lit(False)
    for key in keys:
        absent = absent | F.col(key).isNull()
    return absent


def batch_metrics(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``rows, null_keys, null_key_pct, duplicate_keys`` per group in one pass.

    Counts per key come first, so that a hot key or a mass of null keys is already one row
    per map task when it is shuffled.  Must run before bad rows are taken out.
    """
    per_key = df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("_n"))
    absent = _any_null(keys)
    grouped = per_key.groupBy(*by) if by else per_key.groupBy()
    counts = grouped.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(absent, F.col("_n"))), F.lit(0)).alias("null_keys"),
        F.count_if(~absent & (F.col("_n") > 1)).alias("duplicate_keys"),
    )
    pct = F.when(F.col("rows") > 0, F.col("null_keys") / F.col("rows") * 100.0).otherwise(F.lit(0.0))
    return counts.withColumn("null_key_pct", pct)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys seen more than once, with their counts; null keys are not duplicates."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.where((F.col("copies") > 1) & ~_any_null(keys))


def reconcile(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    by: Sequence[str] = (),
    contracts: DataFrame | None = None,
    thresholds: DataFrame | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """Judge what arrived in ``target`` against ``source``, one row per group of ``by``.

    ``contracts`` (by, contract_ok) and ``thresholds`` (by, threshold_pct) are optional.
    Only rows already aggregated to one per group are joined.  A null is a group like others.
    """
    expected = source.groupBy(*by).agg(F.count(F.lit(1)).alias("source_count"))
    arrived = batch_metrics(target, keys, by).withColumnRenamed("rows", "written_count")
    if by:
        joined = _same_group(expected, arrived, by, "full")
    else:
        joined = arrived.withColumn("source_count", expected.scalar())
    joined = joined.na.fill(0, ["source_count", "written_count", "null_keys", "duplicate_keys"])
    joined = joined.na.fill(0.0, ["null_key_pct"])
    for extra in (contracts, thresholds):
        if extra is not None:
            joined = _same_group(joined, extra, by, "left")
    if contracts is None:
        joined = joined.withColumn("contract_ok", F.lit(True))
    return judge(joined, limits)


def _same_group(left: DataFrame, right: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    """A join on groups in which null meets null."""
    if not by:
        return left.join(right, how=how)
    other = {name: f"_right_{name}" for name in by}
    right = right.withColumnsRenamed(other)
    joined = left.join(right, [left[name].eqNullSafe(right[to]) for name, to in other.items()], how)
    return joined.withColumns({name: F.coalesce(name, to) for name, to in other.items()}).drop(*other.values())


def run_verdict(judged: DataFrame, run: str, dataset: str) -> DataFrame:
    """Per run: whether all its datasets passed, and which did not."""
    bad = F.col("status") == FAILED
    return judged.groupBy(run).agg(
        F.bool_and(~bad).alias("ok"),
        F.count_if(bad).alias("failed_count"),
        F.array_join(F.array_sort(F.collect_set(F.when(bad, F.col(dataset)))), ",").alias("failed"),
    )


def accumulated_written(run_log: DataFrame) -> DataFrame:
    counted = F.when(F.col("status") != FAILED, F.col("qtd_gravada_destino"))
    return run_log.groupBy("collection").agg(F.coalesce(F.sum(counted), F.lit(0)).alias("soma_control_log"))


def accumulated_check(run_log: DataFrame, tables: DataFrame, key: str) -> DataFrame:
    """Run-log sums against what the tables hold, per dataset.

    ``tables`` has ``collection, upserted`` and the key, one row per stored row.  Appended
    tables must hold exactly what was written, so their keys are not even looked at.
    Upserted tables hold each key once and never more rows than were written.
    """
    looked_at = F.when(F.col("upserted"), F.col(key)).alias("_key")
    per_key = tables.groupBy("collection", "upserted", looked_at).agg(F.count(F.lit(1)).alias("_n"))
    held = per_key.groupBy("collection", "upserted").agg(
        F.sum("_n").alias("linhas_bronze"), F.count(F.lit(1)).alias("distinct_keys")
    )
    joined = accumulated_written(run_log).join(held, "collection", "full").na.fill(
        0, ["soma_control_log", "linhas_bronze", "distinct_keys"]
    )
    exact = F.col("linhas_bronze") == F.col("soma_control_log")
    once = (F.col("distinct_keys") == F.col("linhas_bronze")) & (
        F.col("linhas_bronze") <= F.col("soma_control_log")
    )
    return joined.withColumns({
        "delta": F.col("linhas_bronze") - F.col("soma_control_log"),
        "accumulated_ok": F.when(F.coalesce("upserted", F.lit(False)), once).otherwise(exact),
    })


def volume_check(counts: DataFrame, documented: DataFrame) -> DataFrame:
    """Rows seen against the documented volume and the least acceptable count.

    ``documented`` has ``collection, documented_rows, expected_min``, one row per dataset.
    """
    joined = counts.join(documented, "collection", "left")
    return joined.withColumn(
        "below_minimum", F.col("n_rows") < F.coalesce("expected_min", F.lit(0))
    )
