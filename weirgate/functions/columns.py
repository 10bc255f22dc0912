"""Hashes, column names, canonical text."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.functions.json_values import JSON_OPTIONS
from weirgate.functions.marks import iso_text

# Fixed value: characters that table formats refuse in column names.
ILLEGAL_IN_NAME = r"[ ,;{}()\n\t=]+"


def content_hash(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def clean_names(names: list[str]) -> list[str]:
    """Legal and distinct column names; a repeated name gets the next free number."""
    taken: set[str] = set()
    result = []
    for name in names:
        stem = re.sub(ILLEGAL_IN_NAME, "_", name).strip("_") or "col"
        candidates = (stem if n == 1 else f"{stem}_{n}" for n in range(1, len(names) + 2))
        chosen = next(c for c in candidates if c not in taken)
        taken.add(chosen)
        result.append(chosen)
    return result


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_names(df.columns))


def text_of(column: Column, dtype: T.DataType) -> Column:
    """One value as plain text: ISO times, seconds, lower-case hex, JSON for nested."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_text(column, dtype)
    if isinstance(dtype, T.DayTimeIntervalType):
        micros = F.timestamp_diff(
            "MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"),
            F.lit("1970-01-01").cast("timestamp_ntz") + column,
        )
        return (micros / F.lit(1e6)).cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.lower(F.hex(column))
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(column, JSON_OPTIONS)
    return column.cast("string")


def canonical_text(df: DataFrame) -> DataFrame:
    return df.select(*[text_of(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def is_blank_list(column: Column) -> Column:
    """True for a null list and for an empty one, under ANSI and legacy rules alike."""
    return F.coalesce(F.size(column), F.lit(0)) <= 0
