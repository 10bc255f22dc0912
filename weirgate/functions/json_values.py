"""Values out of JSON text that survive dirty input."""

from __future__ import annotations

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.functions import json_cut

cloudpickle.register_pickle_by_value(json_cut)  # workers need not have this package

# The first numeric token of a text, and its whole part.
NUMBER_TOKEN = r"-?\d+\.?\d*"
WHOLE_TOKEN = r"-?\d+"

# A document keeps its nulls, and its times to the microsecond.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

WHOLE_TYPES = ("int", "integer", "long", "bigint", "smallint", "tinyint")


def path_text(body: Column, path: str) -> Column:
    return F.get_json_object(body, f"$.{path}")


def document(df: DataFrame) -> Column:
    """The whole row as JSON text; binary columns as lower-case hex."""

    def value(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        return F.lower(F.hex(column)).alias(field.name) if isinstance(field.dataType, T.BinaryType) else column

    return F.to_json(F.struct(*[value(f) for f in df.schema]), JSON_OPTIONS)


def dirty_number(text: Column, type_name: str) -> Column:
    """First number in the text, or null.

    Whole targets take the whole part of the token, and values out of range become null.
    ``1,234`` and ``1e5`` read as 1: the first token ends at the first other character.
    """
    token = WHOLE_TOKEN if type_name in WHOLE_TYPES else NUMBER_TOKEN
    return F.regexp_extract(text, token, 0).try_cast(type_name)


def tolerant_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def typed_text(text: Column, type_name: str) -> Column:
    """One extracted text as the wanted type, null where it does not fit."""
    if type_name == "string":
        return text
    if type_name == "timestamp":
        return tolerant_timestamp(text)
    if type_name in WHOLE_TYPES or type_name in ("double", "float"):
        return dirty_number(text, type_name)
    return text.try_cast(type_name)


def text_array(text: Column) -> Column:
    """JSON array text as strings; anything but an array is null."""
    return F.from_json(text, "array<string>")


def unwrap_key(text: Column) -> Column:
    """A key as text; the extended form ``{"$oid": ...}`` gives its inner value."""
    extended = text.startswith("{") & F.array_contains(F.json_object_keys(text), "$oid")
    return F.when(extended, F.get_json_object(text, "$['$oid']")).otherwise(text)


def source_key(body: Column, key: str = "_id") -> Column:
    return unwrap_key(path_text(body, key))


def body_without(body: Column, fields: tuple[str, ...] | list[str], key: str = "_id") -> Column:
    """JSON text without the given top-level fields; the key always stays.

    What is kept keeps its bytes: numbers, escapes and blanks are not written anew.  Anything but a JSON object is null.
    """
    dropped = tuple(name for name in fields if name != key)
    if not dropped:
        return body

    members_cut = json_cut.cut_members  # by value, unlike a name looked up in this module

    @F.pandas_udf("string")
    def cut(bodies: pd.Series) -> pd.Series:
        return members_cut(bodies, dropped)

    return cut(F.when(F.json_object_keys(body).isNotNull(), body))
