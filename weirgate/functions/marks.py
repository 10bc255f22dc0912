"""High-water marks: typed filters, text forms, comparison."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _utc(value: Any) -> dt.datetime:
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    elif not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    if value.tzinfo is None:
        return value.replace(tzinfo=dt.timezone.utc)
    return value.astimezone(dt.timezone.utc)


def mark_literal(value: Any, dtype: T.DataType) -> Column:
    """The mark as a literal of the column's own type.

    Comparing like with like keeps the column bare in the predicate, so that Parquet and
    JDBC sources can skip data by it.
    """
    if isinstance(dtype, T.StringType):
        return F.lit(str(value))
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(_utc(value).strftime("%Y-%m-%d %H:%M:%S.%f")).cast(dtype)
    if isinstance(dtype, T.TimestampType):
        return F.lit(_utc(value).isoformat()).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.lit(_utc(value).date().isoformat()).cast(dtype)
    return F.lit(value).cast(dtype)


def newer_than(
    df: DataFrame,
    mark_field: str | None,
    value: Any,
    inclusive: bool = False,
    include_null_mark: bool = False,
) -> Column:
    """Rows past the mark; everything when there is no mark yet."""
    if not mark_field or value is None or value == "":
        return F.lit(True)
    mark = F.col(mark_field)
    bound = mark_literal(value, df.schema[mark_field].dataType)
    passed = (mark >= bound) if inclusive else (mark > bound)
    return (passed | mark.isNull()) if include_null_mark else (passed & mark.isNotNull())


def iso_text(moment: Column, dtype: T.DataType) -> Column:
    """ISO-8601 text; the fraction only appears when there is one.

    Zone-aware timestamps are written in UTC with their offset, whatever the session zone.
    """
    zoned = isinstance(dtype, T.TimestampType)
    wall = (
        F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))
        if zoned
        else moment
    )
    fraction = F.date_format(wall, "SSSSSS")
    return F.concat(
        F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == "000000", "").otherwise(F.concat(F.lit("."), fraction)),
        F.lit("+00:00" if zoned else ""),
    )


def mark_text(mark: Column, dtype: T.DataType) -> Column:
    """The mark as stored in the control tables."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(mark, dtype)
    return mark.cast("string")


def parse_mark(value: Column, kind: Column) -> Column:
    """Stored mark text in comparable form.

    Empty means none.  Timestamps become UTC ISO text of fixed width (offset or ``Z``
    honoured, no offset read as UTC, unreadable gives null); strings stay as they are.
    """
    zoneless = F.try_to_timestamp(F.concat(value, F.lit("+00:00")))
    moment = F.when(
        value.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & value.contains(":"), F.try_to_timestamp(value)
    ).otherwise(F.coalesce(zoneless, F.try_to_timestamp(F.concat(value, F.lit("T00:00:00+00:00")))))
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment.cast("timestamp_ntz"))
    as_time = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return F.when(value.isNull() | (value == ""), None).otherwise(
        F.when(kind == "timestamp", as_time).otherwise(value)
    )


def later(current: Column, candidate: Column) -> Column:
    """The larger of two marks; null gives way."""
    return F.greatest(current, candidate)
