"""Data contracts over JSON documents as one aggregate over the whole batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirgate.functions.json_values import tolerant_timestamp
from weirgate.spec import Contract

PARTS, KINDS = "_parts", "_kinds"


def _holds_type(value: Column, kind: Column, type_name: str) -> Column:
    """Whether a variant value, with its type as text, is of a contract type.

    Dates and ids are text once landed: a date is text that reads as one, an id is 24 hex
    digits or an object that wraps ``$oid``.  A boolean is never a number.
    """
    text = F.try_variant_get(value, "$", "string")
    # A variant keeps 5.0 as a short decimal of scale 0; only a whole number beyond 64 bits
    # needs a long one.
    decimal = kind.startswith("DECIMAL")
    wide = decimal & kind.rlike(r"^DECIMAL\((19|[23]\d),0\)$")
    whole = (kind == "BIGINT") | wide
    checks = {
        "string": lambda: kind == "STRING",
        "int": lambda: whole,
        "double": lambda: kind.isin("DOUBLE", "FLOAT") | (decimal & ~wide),
        "number": lambda: kind.isin("BIGINT", "DOUBLE", "FLOAT") | decimal,
        "bool": lambda: kind == "BOOLEAN",
        "datetime": lambda: (kind == "STRING") & tolerant_timestamp(text).isNotNull(),
        "objectid": lambda: F.when(kind == "STRING", text.rlike("^[0-9a-fA-F]{24}$")).when(
            kind.startswith("OBJECT"), F.try_variant_get(value, "$['$oid']", "string").isNotNull()
        ),
        "array": lambda: kind.startswith("ARRAY"),
        "object": lambda: kind.startswith("OBJECT"),
    }
    return checks[type_name]()


def with_parts(df: DataFrame, contract: Contract, body: str) -> DataFrame:
    """Add what the contract measures: the fields it names, out of one parse that skips all
    others, and the type of each typed field."""
    names = dict.fromkeys([rule.name for rule in contract.fields] + list(contract.forbidden))
    ddl = "struct<" + ",".join(f"`{name}`:variant" for name in names) + ">"
    parsed = df.withColumn(PARTS, F.from_json(F.col(body), ddl))
    kinds = [
        F.schema_of_variant(F.col(PARTS)[rule.name]).alias(rule.name) for rule in contract.fields if rule.type
    ]
    return parsed.withColumn(KINDS, F.struct(*kinds) if kinds else F.lit(None))


def measures(contract: Contract) -> list[Column]:
    """The aggregates a contract needs, for ``agg`` or for an observation of a write."""
    counts: list[Column] = [F.count(F.lit(1)).alias("docs")]
    for rule in contract.fields:
        value = F.col(PARTS)[rule.name]
        # An absent key is a plain null, the null of JSON is a variant that holds null.
        counts.append(F.count_if(value.isNull()).alias(f"missing:{rule.name}"))
        empty = F.is_variant_null(value)
        counts.append(F.count_if(empty).alias(f"null:{rule.name}"))
        if rule.type:
            kind = F.col(KINDS)[rule.name]
            fits = F.coalesce(_holds_type(value, kind, rule.type), F.lit(False))
            wrong = value.isNotNull() & ~kind.isin("VOID") & ~fits
            counts.append(F.count_if(wrong).alias(f"type:{rule.name}"))
    for name in contract.forbidden:
        counts.append(F.count_if(F.col(PARTS)[name].isNotNull()).alias(f"forbidden:{name}"))
    return counts


def contract_metrics(
    df: DataFrame, contract: Contract, body: str = "body_json", by: Sequence[str] = ()
) -> DataFrame:
    """Per contract field: documents seen, key absent, value null, value of another type.

    One parse and one aggregate whatever the number of fields.  Forbidden fields are counted
    as ``present``.  A document that is not a JSON object counts as lacking every field.
    """
    docs = with_parts(df, contract, body).select(*by, PARTS, KINDS)
    return by_field(docs.groupBy(*by).agg(*measures(contract)), contract, by)


def by_field(counted: DataFrame, contract: Contract, by: Sequence[str] = ()) -> DataFrame:
    """One row per contract field from one row of counts."""
    none = F.lit(None).cast("bigint")

    def entry(field, missing, nulls, wrong, forbidden, required, may_be_null, type_name):
        return F.struct(
            F.lit(field).alias("field"),
            F.lit(type_name).cast("string").alias("type"),
            F.lit(required).alias("required"),
            F.lit(may_be_null).alias("nullable"),
            missing.alias("missing"),
            nulls.alias("nulls"),
            wrong.alias("wrong_type"),
            forbidden.alias("present"),
        )

    entries = [
        entry(
            r.name, F.col(f"`missing:{r.name}`"), F.col(f"`null:{r.name}`"),
            F.col(f"`type:{r.name}`") if r.type else F.lit(0).cast("bigint"), none,
            r.required, r.may_be_null, r.type,
        )
        for r in contract.fields
    ] + [
        entry(name, none, none, none, F.col(f"`forbidden:{name}`"), False, True, None)
        for name in contract.forbidden
    ]
    return counted.select(*by, "docs", F.inline(F.array(*entries)))


def contract_violations(metrics: DataFrame, contract: Contract, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``field, kind, detail, hits, violation_pct`` beyond what the contract tolerates."""
    n = F.col("docs")
    limit = F.lit(float(contract.max_violation_pct))

    def candidate(kind: str, hits: Column, applies: Column, detail: Column) -> Column:
        pct = F.when(n > 0, hits / n * 100.0).otherwise(0.0)
        broken = applies & (pct > (F.lit(0.0) if kind == "forbidden" else limit))
        return F.struct(
            F.lit(kind).alias("kind"), detail.alias("detail"), hits.alias("hits"),
            pct.alias("violation_pct"), F.coalesce(broken, F.lit(False)).alias("_broken"),
        )

    ratio = "%d of %d documents"
    candidates = F.array(
        candidate("missing", F.col("missing"), F.col("required"),
                  F.format_string(f"absent in {ratio}", "missing", "docs")),
        candidate("null", F.col("nulls"), ~F.col("nullable"),
                  F.format_string(f"null in {ratio}", "nulls", "docs")),
        candidate("type", F.col("wrong_type"), F.lit(True),
                  F.format_string(f"not %s in {ratio}", "type", "wrong_type", "docs")),
        candidate("forbidden", F.col("present"), F.lit(True),
                  F.format_string(f"present in {ratio}", "present", "docs")),
    )
    found = metrics.select(*by, "docs", "field", F.inline(candidates)).where("_broken").drop("_broken")
    if by or contract.allow_empty:
        return found.drop("docs")
    empty = metrics.where(n == 0).select(
        F.lit("*").alias("field"), F.lit("missing").alias("kind"),
        F.lit("no documents although the contract does not allow empty").alias("detail"),
        F.lit(0).cast("bigint").alias("hits"), F.lit(0.0).alias("violation_pct"),
    ).distinct()
    return found.drop("docs").unionByName(empty)


def contract_summary(violations: DataFrame, metrics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One line of text per group; bounded by the number of contract fields."""
    line = F.format_string("%s:%s(%.1f%%)", "field", "kind", "violation_pct")
    lines = violations.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(line)), ", ").alias("_lines"))
    sizes = metrics.groupBy(*by).agg(F.max("docs").alias("docs"))
    if by:
        joined = sizes.join(lines, list(by), "left")
    else:
        joined = sizes.withColumn("_lines", lines.scalar())
    broken = F.coalesce(F.col("_lines"), F.lit("")) != ""
    return joined.select(
        *by, "docs", (~broken).alias("contract_ok"),
        F.when(broken, F.concat(F.lit("contract broken: "), F.col("_lines")))
        .otherwise(F.format_string("contract ok (%d documents)", "docs")).alias("summary"),
    )
