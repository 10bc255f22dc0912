"""From JSON documents to typed tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions.json_values import path_text, text_array, typed_text


class FieldPath(NamedTuple):
    """Dotted path inside the document, output name and type."""

    path: str
    name: str
    type: str = "string"


_PLAIN_PATH = re.compile(r"[A-Za-z_]\w*(\.[A-Za-z_]\w*)*")


def _tree(paths: Sequence[str]) -> dict:
    root: dict = {}
    for path in paths:
        node = root
        for step in path.split("."):
            node = node.setdefault(step, {})
    return root


def _ddl(node: dict) -> str:
    return "struct<" + ",".join(
        f"`{name}`:{_ddl(child) if child else 'string'}" for name, child in node.items()
    ) + ">"


def _shareable(paths: Sequence[str]) -> list[str]:
    """Paths that one struct can carry: plain, and none the parent of another."""
    plain = [p for p in dict.fromkeys(paths) if _PLAIN_PATH.fullmatch(p)]
    return [p for p in plain if not any(q.startswith(p + ".") for q in plain)]


def extract(df: DataFrame, paths: Sequence[str], body: str = "body_json") -> tuple[DataFrame, dict[str, Column]]:
    """Raw text of each path.

    All plain paths come out of a single parse into a struct of strings; the parser skips
    everything else in the document.  Other paths are read one by one.
    """
    shared = _shareable(paths)
    found: dict[str, Column] = {p: path_text(F.col(body), p) for p in paths if p not in shared}
    if shared:
        df = df.withColumn("_doc", F.from_json(F.col(body), _ddl(_tree(shared))))
        for path in shared:
            value = F.col("_doc")
            for step in path.split("."):
                value = value[step]
            found[path] = value
    return df, found


def flatten(
    df: DataFrame, fields: Sequence[FieldPath], keep: Sequence[str] = (), body: str = "body_json"
) -> DataFrame:
    """Typed columns from document paths; values that do not fit become null."""
    parsed, text = extract(df, [f.path for f in fields], body)
    return parsed.select(*keep, *[typed_text(text[f.path], f.type).alias(f.name) for f in fields])


def explode_array(
    df: DataFrame, keys: Sequence[str], array: Column, one_row_per_key: bool = True
) -> DataFrame:
    """Child rows ``keys, position, value``: nulls dropped, each value once at its first place.

    With one row per key (the output of ``latest_record``) the repeats are all in the same
    row: they are removed there by a sort of the array, and nothing is shuffled.  Otherwise
    positions are reduced per (key, value), with partial sums on the map side.
    """
    if not one_row_per_key:
        rows = df.select(*keys, F.posexplode(array).alias("position", "value"))
        return (
            rows.where(F.col("value").isNotNull())
            .groupBy(*keys, "value").agg(F.min("position").alias("position"))
            .select(*keys, "position", "value")
        )
    numbered = F.transform(array, lambda v, i: F.struct(v.alias("value"), i.alias("position")))
    ordered = df.select(*keys, F.array_sort(F.filter(numbered, lambda s: s["value"].isNotNull())).alias("_items"))
    item = F.col("_items")
    firsts = F.filter(
        item, lambda s, i: (i == 0) | (F.get(item, i - 1)["value"] != s["value"])
    )
    return ordered.select(*keys, F.inline(firsts)).select(*keys, "position", "value")


def explode_field(df: DataFrame, path: str, keys: Sequence[str] = ("_source_id",), body: str = "body_json") -> DataFrame:
    """Child table of one JSON array field of the current documents."""
    return explode_array(df, keys, text_array(path_text(F.col(body), path)))


def infer_schema(df: DataFrame, body: str = "body") -> DataFrame:
    """One row with the merged schema of every document, in variant notation."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(body))).alias("schema"))


_TYPE_WORD = re.compile(r"(?P<name>`(?:[^`]|``)*`|[^\s<>,:`]+(?=:))|\bOBJECT(?=<)|\bVOID\b")


def schema_ddl(spark_schema: str) -> str:
    """A variant schema as a type that ``from_json`` accepts.  Field names stay as they are."""
    words = {"OBJECT": "STRUCT", "VOID": "STRING"}
    if not spark_schema.startswith("OBJECT<"):
        return "STRUCT<>"
    return _TYPE_WORD.sub(lambda word: word[0] if word["name"] else words[word[0]], spark_schema)


def expand(
    df: DataFrame, keep: Sequence[str], body: str = "body", schema: str | None = None, rest: str | None = None
) -> DataFrame:
    """Top-level document fields as columns; without a schema it is inferred over all objects.

    Bodies that are no objects have null fields.  ``rest`` names a column that takes their text.
    """
    is_object = F.coalesce(F.regexp_like(F.col(body), F.lit(r"^\s*\{")) & F.try_parse_json(F.col(body)).isNotNull(), F.lit(False))
    objects = df.withColumn(body, F.when(is_object, F.col(body)))
    ddl = schema or schema_ddl(infer_schema(objects, body).first()[0] or "")
    aside = [F.when(~is_object, F.col(body)).alias(rest)] if rest else []
    parsed = F.from_json(F.when(is_object, F.col(body)), ddl).alias("_doc")
    return df.select(*keep, *aside, parsed).select(*keep, *([rest] if rest else []), "_doc.*")


def read_variant(df: DataFrame, keep: Sequence[str], body: str = "body") -> DataFrame:
    return df.select(*keep, F.try_parse_json(F.col(body)).alias("doc"))
