"""Reconciliation verdicts as column expressions, one judged row per (run, dataset)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.spec import FAILED, PARTIAL, SUCCESS, Limits


def divergence_pct(source: Column, written: Column) -> Column:
    """Absolute difference as a share of the source; with no source, all or nothing."""
    nothing = F.when(written <= 0, F.lit(0.0)).otherwise(F.lit(100.0))
    share = F.abs(source - written) / source.cast("double") * 100.0
    return F.when(source <= 0, nothing).otherwise(share)


def judge(df: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Add ``divergencia_pct, status, may_advance, message``.

    Needs ``source_count, written_count, null_key_pct, duplicate_keys, contract_ok`` and
    takes the dataset's own limit from ``threshold_pct`` where that is not null.

    A run fails on null keys (if those are fatal) or when it lost more than the hard limit.
    Otherwise divergence over the limit, duplicate keys or a broken contract make it
    partial.  The mark may move on unless rows are missing or the run failed.
    """
    raw = divergence_pct(F.col("source_count"), F.col("written_count"))
    own = F.col("threshold_pct") if "threshold_pct" in df.columns else F.lit(None).cast("double")
    df = df.withColumns({"_div": raw, "_limit": F.coalesce(own, F.lit(limits.threshold_pct))})

    short = F.col("written_count") < F.col("source_count")
    null_keys = F.coalesce(F.col("null_key_pct"), F.lit(0.0)) > 0
    lost = short & (F.col("_div") > limits.hard_fail_pct)
    failed = lost | (null_keys if limits.null_key_is_fatal else F.lit(False))
    over = F.col("_div") > F.col("_limit")
    repeated = F.coalesce(F.col("duplicate_keys"), F.lit(0)) > 0
    broken = ~F.coalesce(F.col("contract_ok"), F.lit(True))
    partial = null_keys | over | repeated | broken

    status = F.when(failed, FAILED).when(partial, PARTIAL).otherwise(SUCCESS)
    pct = "%.2f%%"
    reasons = F.concat_ws(
        "; ",
        F.when(null_keys, F.format_string(f"null key in {pct} of the batch", "null_key_pct")),
        F.when(lost, F.format_string(
            f"lost rows: wrote %d of %d (divergence {pct} > hard limit {limits.hard_fail_pct:.2f}%%)",
            F.col("written_count"), F.col("source_count"), F.col("_div"))),
        F.when(~failed & over, F.format_string(f"divergence {pct} > limit {pct}", "_div", "_limit")),
        F.when(~failed & repeated, F.format_string("%d duplicated keys in the batch", "duplicate_keys")),
        F.when(~failed & broken, F.lit("data contract broken")),
    )
    message = F.when(reasons == "", "source and target agree").otherwise(reasons)
    return df.withColumns({
        "divergencia_pct": F.round("_div", 4),
        "status": status,
        "may_advance": (status == SUCCESS) | ((status == PARTIAL) & ~short),
        "message": message,
    }).drop("_div", "_limit")
