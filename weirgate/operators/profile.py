"""Counts, drift and column statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("collection"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def schema_drift(df: DataFrame, body: str = "body") -> DataFrame:
    """How many documents carry each top-level key, and their share of all documents."""
    total = df.agg(F.count(F.lit(1))).scalar()
    keys = df.select(F.explode(F.array_distinct(F.json_object_keys(F.col(body)))).alias("field"))
    return keys.groupBy("field").agg(F.count(F.lit(1)).alias("occurrences")).withColumn(
        "pct_docs", F.round(F.col("occurrences") * F.lit(100.0) / total, 1)
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Count, nulls, mean, deviation, least and greatest of each column, in one pass.

    Numeric columns fill the ``*_value`` columns, all others the ``*_text`` columns.
    """
    numeric = {f.name: isinstance(f.dataType, T.NumericType) for f in df.schema}
    measures = [F.count(F.lit(1)).alias("_rows")]
    for name, is_number in numeric.items():
        col = F.col(f"`{name}`")
        measures += [F.count(col).alias(f"n:{name}"), F.min(col).alias(f"min:{name}"), F.max(col).alias(f"max:{name}")]
        if is_number:
            measures += [F.avg(col).alias(f"avg:{name}"), F.stddev(col).alias(f"dev:{name}")]
    row = df.agg(*measures)

    def ref(kind: str, name: str, type_name: str):
        return F.col(f"`{kind}:{name}`").cast(type_name)

    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("_rows").alias("n_rows"),
            (F.col("_rows") - ref("n", name, "bigint")).alias("n_null"),
            (ref("avg", name, "double") if num else no_number).alias("mean_value"),
            (ref("dev", name, "double") if num else no_number).alias("stddev_value"),
            (ref("min", name, "double") if num else no_number).alias("min_value"),
            (ref("max", name, "double") if num else no_number).alias("max_value"),
            (no_text if num else ref("min", name, "string")).alias("min_text"),
            (no_text if num else ref("max", name, "string")).alias("max_text"),
        )
        for name, num in numeric.items()
    ]
    return row.select(F.inline(F.array(*entries)))
