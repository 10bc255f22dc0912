"""Documents under a fixed schema: what fits becomes columns, what does not is kept field by field.

A field fits when its value says nothing that the schema does not know: a whole number fits a double, a null fits
anything, an object fits when all its fields do.  Unknown fields and values of other types are rescued whole, as JSON,
while the rest of the document loads.  All of it is Column expressions over the parsed document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.refine import infer_schema, schema_ddl

BIG_WHOLE = T.DecimalType(38, 0)
_KINDS = {
    T.StringType: "^STRING$",
    T.BooleanType: "^BOOLEAN$",
    T.LongType: "^BIGINT$",
    T.DecimalType: r"^(BIGINT$|DECIMAL\([0-9]+,0\))",
    T.DoubleType: "^(BIGINT|DECIMAL|DOUBLE|FLOAT)",
}


def plain_type(dtype: T.DataType) -> T.DataType:
    """Inferred types as columns have them: fractions are doubles, whole numbers long or as wide as they get."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, plain_type(f.dataType)) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(plain_type(dtype.elementType))
    if isinstance(dtype, T.DecimalType):
        return BIG_WHOLE if dtype.scale == 0 else T.DoubleType()
    return T.DoubleType() if isinstance(dtype, T.FloatType) else dtype


def inferred(df: DataFrame, body: str) -> T.StructType | None:
    """The merged schema of all objects in a column of JSON text, nothing when there are none.  One pass, a partial
    schema for each task."""
    parsed = F.try_parse_json(F.col(body))
    objects = df.where(F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")))
    found = infer_schema(objects, body).first()[0]
    return plain_type(T.StructType.fromDDL(schema_ddl(found))) if found and found.startswith("OBJECT<") else None


def with_added(known: T.StructType, seen: T.StructType) -> T.StructType:
    """``known`` with the fields that only ``seen`` has, at any depth.  Types that are known stay."""

    def joined(old: T.DataType, new: T.DataType) -> T.DataType:
        if isinstance(old, T.StructType) and isinstance(new, T.StructType):
            return with_added(old, new)
        if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
            return T.ArrayType(joined(old.elementType, new.elementType))
        return old

    theirs = {f.name: f.dataType for f in seen}
    kept = [T.StructField(f.name, joined(f.dataType, theirs.get(f.name, f.dataType))) for f in known]
    names = set(known.names)
    return T.StructType(kept + [f for f in seen if f.name not in names])


def fits(value: Column, dtype: T.DataType) -> Column:
    """Whether a variant says nothing beyond the type."""
    kind = F.schema_of_variant(value)
    empty = value.isNull() | (kind == "VOID")
    if isinstance(dtype, T.StructType):
        parts = F.try_variant_get(value, "$", "map<string,variant>")
        inside = F.forall(F.map_entries(parts), lambda e: _field_fits(e["key"], e["value"], dtype))
        return empty | (kind.startswith("OBJECT") & F.coalesce(inside, F.lit(True)))
    if isinstance(dtype, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        return empty | (kind.startswith("ARRAY") & F.coalesce(F.forall(items, lambda x: fits(x, dtype.elementType)), F.lit(True)))
    pattern = _KINDS.get(type(dtype))
    return empty | kind.rlike(pattern) if pattern else F.lit(True)  # a variant takes anything


def _field_fits(name: Column, value: Column, schema: T.StructType) -> Column:
    known = F.lit(False)
    for field in schema:
        known = F.when(name == field.name, fits(value, field.dataType)).otherwise(known)
    return known


def _parts(body: Column) -> Column:
    return F.try_variant_get(F.try_parse_json(body), "$", "map<string,variant>")


def rescued(body: Column, schema: T.StructType) -> Column:
    """The fields outside of the schema as one JSON object, null when there are none.

    A text that is an object to a line parser but not to the stricter one (repeated keys) is rescued whole.
    """
    outside = F.map_filter(_parts(body), lambda name, value: ~_field_fits(name, value, schema))
    unread = F.startswith(F.ltrim(body), F.lit("{")) & F.try_parse_json(body).isNull()
    return F.when(unread, body).when(F.size(outside) > 0, F.to_json(outside))


def typed(body: Column, schema: T.StructType) -> Column:
    """The fields inside the schema as a struct; what was rescued is null."""
    inside = F.map_filter(_parts(body), lambda name, value: _field_fits(name, value, schema))
    return F.from_json(F.to_json(inside), schema)


def expand_known(df: DataFrame, keep: list[str], schema: T.StructType, body: str = "body_json") -> DataFrame:
    """``keep`` and the schema's fields as columns."""
    return df.select(*keep, typed(F.col(body), schema).alias("_doc")).select(*keep, "_doc.*")
