"""Landing lines to Bronze rows, and the Bronze and landing tables on disk."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weirgate.functions.columns import content_hash, is_blank_list
from weirgate.functions.json_values import document, unwrap_key
from weirgate.operators import contract as contracts
from weirgate.operators.rescue import rescued
from weirgate.plans.control import not_failed
from weirgate.schemas import BRONZE_COLUMNS, BRONZE_DDL
from weirgate.session import folder_names, read_table, remove
from weirgate.spec import Contract

_STORED_DDL = f"{BRONZE_DDL}, _load string, _quarantined boolean"


def write_landing(df: DataFrame, path: str, *measures: Column, **options: str) -> dict:
    """Rows as JSON lines, one folder per run, with measures taken in the same pass.

    A re-run of the same run replaces its folder.  There is no shuffle, so each measure
    counts every written row exactly once even when tasks are repeated.  ``options`` go to
    the writer (compression, rows per file).
    """
    seen = Observation("landing")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *measures)
    counted.select(document(df).alias("value")).write.mode("overwrite").options(**options).text(path)
    return seen.get


def parse_lines(lines: DataFrame, key: str = "_id", keep: Sequence[str] = ()) -> DataFrame:
    """Key and parse failure of each line, with the columns to keep.

    The body stays the line itself.  ``_rescued_data`` is the line when it is not one JSON
    object and nothing else; such a line has no key.
    """
    parsed = F.from_json(
        F.col("value"), f"struct<`{key}`:string,`_corrupt`:string>", {"columnNameOfCorruptRecord": "_corrupt"}
    )
    documents = F.json_array_length(F.concat(F.lit("["), F.col("value"), F.lit("]")))
    more = (F.trim("value") != "") & (F.coalesce(documents, F.lit(0)) != 1)  # text after the first document
    rescued = F.coalesce(F.col("_parsed._corrupt"), F.when(more, F.col("value")))
    return lines.withColumn("_parsed", parsed).select("*", rescued.alias("_rescued_data")).select(
        "value",
        "_source_file",
        F.when(F.col("_rescued_data").isNull(), unwrap_key(F.col("_parsed")[key])).alias("_source_id"),
        "_rescued_data",
        *keep,
    )


def with_rescued_fields(parsed: DataFrame, schema: StructType) -> DataFrame:
    """Parsed lines with the fields outside of the schema in ``_rescued_data``.

    The body stays the line as it came.  Lines without a key go to quarantine whole, so nothing is rescued from them.
    """
    outside = F.when(F.col("_source_id").isNotNull(), rescued(F.col("value"), schema))
    return parsed.withColumn("_rescued_data", F.coalesce("_rescued_data", outside))


def shape(
    parsed: DataFrame, run_id: str | Column, at: dt.datetime | Column, source_tag: str, load_type: str | Column
) -> DataFrame:
    """The ten Bronze columns: body, hash of the body, and where and when it came in.

    Run, time and load type are the same for all rows, or columns where rows of many runs are shaped at once.
    """
    if isinstance(at, Column):
        stamp, day = at, F.to_date(F.convert_timezone(F.current_timezone(), F.lit("UTC"), at.cast("timestamp_ntz")))
    else:
        stamp = F.lit(at.astimezone(dt.timezone.utc).isoformat()).cast("timestamp")
        day = F.lit(at.astimezone(dt.timezone.utc).date())
    return parsed.select(
        "_source_id",
        F.col("value").alias("body_json"),
        "_rescued_data",
        content_hash(F.col("value")).alias("_source_hash"),
        "_source_file",
        (run_id if isinstance(run_id, Column) else F.lit(run_id)).alias("_ingestion_id"),
        stamp.alias("_ingestion_timestamp"),
        F.lit(source_tag).alias("_source_path"),
        (load_type if isinstance(load_type, Column) else F.lit(load_type)).alias("_load_type"),
        day.alias("_ingestion_date"),
    )


def bad_rows(shaped: DataFrame) -> DataFrame:
    """Rows without a key, with the reason."""
    why = F.when(F.col("_rescued_data").isNotNull(), "not a JSON object").otherwise("no key")
    return shaped.where(F.col("_source_id").isNull()).withColumn("_reason", why)


def append_load(
    shaped: DataFrame, path: str, load_id: str, contract: Contract | None = None, *measures: Column
) -> dict:
    """Write one load, good rows and quarantine together from one pass over the input.

    A load owns its folder and replaces it when it is run again, so a repeated run or
    micro-batch does not double rows.  The counts of the contract and further measures are taken while writing;
    without a shuffle they see every written row exactly once.
    """
    marked = shaped.withColumn("_quarantined", F.col("_source_id").isNull())
    seen = Observation("load")
    if contract is not None:
        counted = contracts.with_parts(marked, contract, "body_json")
        marked = counted.observe(seen, *contracts.measures(contract), *measures).drop(contracts.PARTS, contracts.KINDS)
    elif measures:
        marked = marked.observe(seen, *measures)
    marked.write.mode("overwrite").partitionBy("_quarantined", "_ingestion_date").parquet(f"{path}/_load={load_id}")
    return seen.get if contract is not None or measures else {}


def replace_loads(shaped: DataFrame, path: str, days: dict[str, dt.date]) -> None:
    """Write many loads in one pass, each in place of what it held before.

    Rows are gathered by load before they are written; loads too large for a task are split at run time.  ``days`` has
    the day of each load: what earlier writes left under other days is removed afterwards.
    """
    marked = shaped.withColumns({"_load": F.col("_ingestion_id"), "_quarantined": F.col("_source_id").isNull()})
    writer = marked.hint("rebalance", "_load").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("_load", "_quarantined", "_ingestion_date").parquet(path)
    spark = shaped.sparkSession
    for load_id, day in days.items():
        for part in ("_quarantined=false", "_quarantined=true"):
            for name in folder_names(spark, f"{path}/_load={load_id}/{part}"):
                if name.startswith("_ingestion_date=") and name != f"_ingestion_date={day.isoformat()}":
                    remove(spark, f"{path}/_load={load_id}/{part}/{name}")


def read_loads(spark: SparkSession, path: str, loads: Sequence[str]) -> DataFrame:
    """All rows of the given loads, quarantine included, with ``_load`` and ``_quarantined``.

    The loads are a predicate on the partition column: folders of other loads are not opened.
    """
    return read_table(spark, path, _STORED_DDL).where(F.col("_load").isin(list(loads)))


def published_loads(run_log: DataFrame, dataset: str) -> list[str]:
    """Names of the loads that count: logged, and not as failed.  One short name per run."""
    passed = not_failed(run_log).where(F.col("collection") == dataset).select("_ingestion_id").distinct()
    return sorted(r["_ingestion_id"] for r in passed.collect())


def read_published(spark: SparkSession, path: str, loads: Sequence[str]) -> DataFrame:
    """Good rows of the given loads."""
    return read_loads(spark, path, loads).where(~F.col("_quarantined")).select(*BRONZE_COLUMNS)


def drop_staged(spark: SparkSession, path: str, load_id: str) -> None:
    """Remove the good rows of a load once they live in a keyed table; quarantine stays."""
    remove(spark, f"{path}/_load={load_id}/_quarantined=false")


def read_load(spark: SparkSession, path: str, load_id: str) -> DataFrame:
    """Everything one load wrote, quarantine included, read from its own folder only."""
    stored = read_table(spark, f"{path}/_load={load_id}", f"{BRONZE_DDL}, _quarantined boolean")
    return stored.select(*BRONZE_COLUMNS, "_quarantined")


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, _STORED_DDL).where(~F.col("_quarantined")).select(*BRONZE_COLUMNS)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    stored = read_table(spark, path, _STORED_DDL).where(F.col("_quarantined"))
    return bad_rows(stored.select(*BRONZE_COLUMNS))


def published(bronze: DataFrame, run_log: DataFrame, dataset: str) -> DataFrame:
    """Rows of loads that the run log knows and did not judge as failed.

    The log row is the commit of a load: rows of a crashed or failed load stay invisible.
    The side that is looked up has one short row per run; Spark broadcasts it only while it
    is small.
    """
    passed = not_failed(run_log).where(F.col("collection") == dataset)
    return bronze.join(passed.select("_ingestion_id").distinct(), "_ingestion_id", "left_semi").select(
        *BRONZE_COLUMNS
    )


def mark_blank(df: DataFrame, column: str, at: dt.datetime, reason: str) -> DataFrame:
    """Time and reason of quarantine for rows whose list is null or empty, null for others."""
    blank = is_blank_list(F.col(column))
    stamp = F.lit(at.astimezone(dt.timezone.utc).isoformat()).cast("timestamp")
    return df.withColumns({"quarentena_em": F.when(blank, stamp), "motivo": F.when(blank, F.lit(reason))})
