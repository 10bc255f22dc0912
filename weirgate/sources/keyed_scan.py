"""Scans in ranges of the key, which resume where they stopped.

The ranges come from a quantile sketch of the key, so each holds about as many rows however the keys are spread.  Each
range is landed in a folder of its own and then marked; a repeated scan reads only ranges without a mark, with the
ranges planned the first time.  Both ends are predicates in the key's own type, so sources can skip data by them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from os.path import commonprefix
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.functions.marks import mark_literal
from weirgate.session import read_table, small_frame

_PLAN_DDL = "place int, low string, high string, nulls boolean"
_MARK_DDL = "place int, rows bigint, mark string"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_EPOCH = dt.datetime(1970, 1, 1)


class KeyRange(NamedTuple):
    """Keys from ``low`` to below ``high``, either of them open where it is null; or the rows without a key."""

    place: int
    low: str | None
    high: str | None
    nulls: bool = False

    def contains(self, key: str, dtype: T.DataType) -> Column:
        column = F.col(f"`{key}`")
        if self.nulls:
            return column.isNull()
        inside = column.isNotNull()
        if self.low is not None:
            inside = inside & (column >= mark_literal(self.low, dtype))
        return inside if self.high is None else inside & (column < mark_literal(self.high, dtype))


def _quantiles(df: DataFrame, code: Column, kind: str, parts: int) -> list:
    """The inner borders of ``parts`` equal shares, each once.  One pass; sketches of tasks are merged."""
    sketch = getattr(F, f"kll_sketch_agg_{kind}")(code)
    row = df.where(code.isNotNull()).agg(F.count(F.lit(1)).alias("n"), sketch.alias("s"))
    at = getattr(F, f"kll_sketch_get_quantile_{kind}")
    borders = [F.when(F.col("n") > 0, at("s", F.lit(i / parts))).alias(f"q{i}") for i in range(1, parts)]
    found = row.select(*borders).first() if borders else ()
    return sorted({q for q in found if q is not None})


def _text_borders(df: DataFrame, key: str, parts: int) -> list[str]:
    """Borders of text keys: a sketch of the seven bytes that follow what all keys share, then the least key at or
    after each border."""
    column = F.col(f"`{key}`")
    ends = df.agg(F.min(column), F.max(column)).first()
    if ends[0] is None:
        return []
    shared = len(commonprefix([ends[0].encode(), ends[1].encode()]))
    code = F.conv(F.hex(F.rpad(F.substring(F.encode(column, "UTF-8"), shared + 1, 7), 7, F.lit(b"\0"))), 16, 10).cast("long")
    borders = _quantiles(df, code, "bigint", parts)
    least = [F.min(F.when(code >= b, column)).alias(f"k{i}") for i, b in enumerate(borders)]
    return sorted({k for k in df.agg(*least).first() if k is not None}, key=str.encode) if least else []


def plan_ranges(df: DataFrame, key: str, parts: int) -> list[KeyRange]:
    """About equal ranges of the key, at most ``parts``, and one for rows without a key where the key may be null.

    A key that fills several shares gets one range: a range cannot split a key.
    """
    field, column = df.schema[key], F.col(f"`{key}`")
    dtype = field.dataType
    if isinstance(dtype, T.StringType):
        borders = _text_borders(df, key, parts)
    elif isinstance(dtype, _WHOLE):
        borders = [str(q) for q in _quantiles(df, column.cast("long"), "bigint", parts)]
    elif isinstance(dtype, T.DateType):
        borders = [(_EPOCH + dt.timedelta(days=q)).date().isoformat() for q in _quantiles(df, F.unix_date(column).cast("long"), "bigint", parts)]
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        wall = F.convert_timezone(F.current_timezone(), F.lit("UTC"), column.cast("timestamp_ntz")) if isinstance(dtype, T.TimestampType) else column
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), wall)
        borders = [(_EPOCH + dt.timedelta(microseconds=q)).isoformat() for q in _quantiles(df, micros, "bigint", parts)]
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        borders = [repr(q) for q in _quantiles(df, F.when(~F.isnan(column), column.cast("double")), "double", parts)]
    else:
        raise ValueError(f"cannot plan ranges of {key}: {dtype.simpleString()}")
    ends = [None, *borders, None]
    ranges = [KeyRange(i, low, high) for i, (low, high) in enumerate(zip(ends, ends[1:]))]
    return [*ranges, KeyRange(len(ranges), None, None, True)] if field.nullable else ranges


def predicates(ranges: Sequence[KeyRange], key: str) -> list[str]:
    """The ranges as SQL conditions, for readers that take one condition per partition (``spark.read.jdbc``)."""

    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    found = []
    for r in ranges:
        low, high = r.low is not None and f"{key} >= {text(r.low)}", r.high is not None and f"{key} < {text(r.high)}"
        found.append(f"{key} IS NULL" if r.nulls else " AND ".join(p for p in (low, high) if p) or f"{key} IS NOT NULL")
    return found


def stored_plan(spark: SparkSession, path: str) -> list[KeyRange]:
    rows = read_table(spark, f"{path}/plan", _PLAN_DDL).collect()
    return sorted(KeyRange(*row) for row in rows) if rows else []


def finished(spark: SparkSession, path: str) -> DataFrame:
    """``place, rows, mark`` of the ranges that are landed whole."""
    return read_table(spark, f"{path}/marks", _MARK_DDL, recursiveFileLookup="true")


def land_in_ranges(
    df: DataFrame, key: str, folder: str, state: str, parts: int, write, mark: Column | None = None,
    most: int | None = None, parallel: int = 4,
) -> dict:
    """Land the ranges that have no mark yet, at most ``most`` of them, and return ``rows, mark, complete`` of all.

    ``write(rows, folder, *measures)`` lands the rows of one range, sorted by key within its files, and returns its
    counts.  A range that breaks off has no mark and is written again; an error is raised after the other ranges that
    run beside it are done.
    """
    spark = df.sparkSession
    ranges = stored_plan(spark, state)
    if not ranges:
        ranges = plan_ranges(df, key, parts)
        small_frame(spark, ranges, _PLAN_DDL).coalesce(1).write.mode("overwrite").parquet(f"{state}/plan")
    done = {r["place"] for r in finished(spark, state).select("place").collect()}
    open_ranges = [r for r in ranges if r.place not in done][:most]
    dtype, measures = df.schema[key].dataType, [] if mark is None else [mark.alias("mark")]

    def one(r: KeyRange) -> None:
        rows = df.where(r.contains(key, dtype)).sortWithinPartitions(f"`{key}`")
        seen = write(rows, f"{folder}/range-{r.place:05d}", *measures)
        note = small_frame(spark, [(r.place, seen["rows"], seen.get("mark"))], _MARK_DDL)
        note.coalesce(1).write.mode("overwrite").parquet(f"{state}/marks/range-{r.place:05d}")

    with ThreadPoolExecutor(max_workers=max(parallel, 1)) as pool:
        for result in [pool.submit(one, r) for r in open_ranges]:
            result.result()
    total = finished(spark, state).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.max("mark").alias("mark"), F.count(F.lit(1)).alias("n")
    ).first()
    return {"rows": total["rows"], "mark": total["mark"], "complete": total["n"] == len(ranges)}
