"""What the run log says was written in all, against what the table holds, at the end of each run.

Each load leaves its row count and a sketch of its keys, taken while it is written.  Their sum and their union answer
for the whole history without reading it: appended tables must hold what was written, keyed tables about as many rows
as there were different keys.  Only a dataset whose figures disagree is counted again, exactly.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.operators.quality import accumulated_check
from weirgate.plans import control
from weirgate.schemas import ACCUMULATED_DDL, LOAD_KEYS_DDL
from weirgate.session import small_frame
from weirgate.spec import FAILED, Layout

LOAD_KEYS = "load_keys"
CHECKS = "accumulated_check"
LOG_K = 14
# The sketch's relative deviation is about 0.8 / sqrt(2 ** LOG_K), 0.6 %; beyond four of them it disagrees.
TOLERANCE = 4 * 0.8 / 2 ** (LOG_K / 2)


def measures(key: str = "_source_id") -> list[Column]:
    """Measures to take while a load is written: its good rows and the sketch of their keys."""
    good = F.col(key).isNotNull()
    return [F.count_if(good).alias("_good_rows"), F.hll_sketch_agg(F.when(good, F.col(key)), LOG_K).alias("_keys")]


def note_load(spark: SparkSession, layout: Layout, dataset: str, load_id: str, seen: dict) -> None:
    row = (load_id, dataset, seen["_good_rows"], bytes(seen["_keys"]) if seen["_keys"] is not None else None)
    control.append(small_frame(spark, [row], LOAD_KEYS_DDL), layout, LOAD_KEYS, f"{load_id}-{dataset}")


def load_keys(spark: SparkSession, layout: Layout) -> DataFrame:
    return control.read(spark, layout, LOAD_KEYS, LOAD_KEYS_DDL)


def written_in_all(log: DataFrame, sketches: DataFrame) -> DataFrame:
    """Per dataset: rows written by loads that count, and the different keys among them, from counts and sketches."""
    counted = log.where(F.col("status") != FAILED).select("_ingestion_id", "collection", "qtd_gravada_destino")
    joined = counted.join(sketches, ["_ingestion_id", "collection"], "left")
    return joined.groupBy("collection").agg(
        F.coalesce(F.sum("qtd_gravada_destino"), F.lit(0)).alias("soma_control_log"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("keys")), F.lit(0)).alias("estimated_keys"),
        F.count_if((F.col("qtd_gravada_destino") > 0) & F.col("keys").isNull()).alias("without_sketch"),
    )


def check(
    spark: SparkSession, layout: Layout, dataset: str, run_id: str, stored: DataFrame, upserted: bool, at: dt.datetime
) -> dict:
    """Judge one dataset after a run and keep the result.  ``stored`` are its rows; they are only counted, unless the
    figures disagree or loads without a sketch leave a keyed table's keys unknown."""
    log = control.run_log(spark, layout).where(F.col("collection") == dataset)
    row = written_in_all(log, load_keys(spark, layout)).first()
    total, keys = (row["soma_control_log"], row["estimated_keys"]) if row else (0, 0)
    held = stored.count()
    if upserted:
        agree = held <= total and not (row and row["without_sketch"]) and abs(held - keys) <= max(TOLERANCE * keys, 1)
    else:
        agree = held == total
    ok = agree
    if not agree:
        tables = stored.select(F.lit(dataset).alias("collection"), F.lit(upserted).alias("upserted"), "_source_id")
        exact = accumulated_check(log, tables, "_source_id").first()
        ok = bool(exact["accumulated_ok"]) if exact else total == 0
    values = (run_id, dataset, total, held, keys, held - total, not agree, ok, at)
    control.append(small_frame(spark, [values], ACCUMULATED_DDL), layout, CHECKS, f"{run_id}-{dataset}")
    return dict(zip([part.split()[0] for part in ACCUMULATED_DDL.split(", ")], values))


def checks(spark: SparkSession, layout: Layout) -> DataFrame:
    return control.read(spark, layout, CHECKS, ACCUMULATED_DDL)
