"""Registration of queries and their SQL statements."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

RUN_AT = dt.datetime(2024, 2, 1, 12, 0, 0, tzinfo=dt.timezone.utc)
TAG = "tables/events"
MARK = "2024-01-15T00:00:00"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` computes the same from the same tables."""

    def register(build: Query) -> Query:
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, sf_dir)

        QUERIES[name] = in_utc
        if sql:
            ORACLE[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
