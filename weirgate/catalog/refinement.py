"""Current records, deduplication, typing, child tables, references."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.catalog.inputs import EVENT_DOC_SQL, event_docs, shaped_documents, zoneless
from weirgate.catalog.registry import query, table
from weirgate.functions.json_values import dirty_number, path_text, text_array
from weirgate.functions.json_values import tolerant_timestamp as to_timestamp
from weirgate.operators import latest, refine, references
from weirgate.operators.refine import FieldPath

_LINE_KEYS = ["l_orderkey", "l_linenumber"]
_LINE_REST = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]
_LINE_ORDER_SQL = ", ".join(f"{c} desc" for c in _LINE_REST)


@query("latest_record", f"""
  select * exclude (rn) from (select *, row_number() over (
    partition by l_orderkey, l_linenumber order by {_LINE_ORDER_SQL}) as rn from lineitem) where rn = 1
""")
def latest_record(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    order = [F.col(c).desc() for c in _LINE_REST]
    return latest.latest_record(lines, _LINE_KEYS, order)


@query("dedup_by_pk", """
  select user_id, event_id, event_type, value, _ingested_at from (
    select *, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as _ingested_at,
      row_number() over (partition by user_id order by ts desc) as rn from events) where rn = 1
""")
def dedup_by_pk(spark, sf_dir):
    audited = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", "value",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_ingested_at"),
    )
    return latest.deduplicate(audited, ["user_id"])


@query("dedup_all_columns", """
  select text, lang, max(printf('%020d', doc_id)) as _ingested_at from documents group by text, lang
""")
def dedup_all_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "text", "lang", F.lpad(F.col("doc_id").cast("string"), 20, "0").alias("_ingested_at")
    )
    return latest.deduplicate(docs)


@query("dedup_distinct_rows", "select distinct l_returnflag, l_linestatus, l_quantity, l_discount from lineitem")
def dedup_distinct_rows(spark, sf_dir):
    return latest.deduplicate(
        table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_discount")
    )


@query("dedup_report", """
  select count(*) as rows_read, count(distinct (l_orderkey, l_linenumber)) as rows_kept,
    count(*) - count(distinct (l_orderkey, l_linenumber)) as rows_removed from lineitem
""")
def dedup_report(spark, sf_dir):
    return latest.dedup_report(table(spark, sf_dir, "lineitem"), _LINE_KEYS)


_WORDS_SQL = """
  select conv_id, turn, role, unnest(string_split(text, ' ')) as value,
    unnest(range(len(string_split(text, ' ')))) as pos from conversations
"""


@query("explode_array", f"""
  select conv_id, turn, value, cast(min(pos) as integer) as position from ({_WORDS_SQL}) group by conv_id, turn, value
""")
def explode_array(spark, sf_dir):
    docs = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.to_json(F.split("text", " ")).alias("words")
    )
    return refine.explode_array(docs, ["conv_id", "turn"], text_array(F.col("words")))


@query("explode_array_many_rows", f"""
  select conv_id, value, cast(min(pos) as integer) as position from ({_WORDS_SQL}) group by conv_id, value
""")
def explode_array_many_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "conversations").select("conv_id", F.split("text", " ").alias("words"))
    return refine.explode_array(docs, ["conv_id"], F.col("words"), one_row_per_key=False)


@query("json_extract", "select event_id, json_extract_string(props, '$.k') as k from events")
def json_extract(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", path_text(F.col("props"), "k").alias("k"))


@query("dirty_numeric_cast", """
  select p_partkey, p_size as size_int, p_retailprice as price, try_cast(p_partkey * 3000000 as integer) as wide,
    cast(null as bigint) as none
  from part
""")
def dirty_numeric_cast(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    size, price = F.col("p_size").cast("string"), F.col("p_retailprice").cast("string")
    return part.select(
        "p_partkey",
        dirty_number(F.concat(F.lit(" "), size, F.lit("è")), "int").alias("size_int"),
        dirty_number(F.concat(F.lit("USD "), price, F.lit(" ca.")), "double").alias("price"),
        dirty_number(F.concat((F.col("p_partkey") * 3000000).cast("string"), F.lit(".75x")), "int").alias("wide"),
        dirty_number(F.translate("p_type", "0123456789", ""), "bigint").alias("none"),
    )


@query("tolerant_timestamp", """
  select event_id, case when event_type = 'error' then null
      when event_type = 'view' then date_trunc('day', ts)
      when event_type = 'click' then date_trunc('second', ts) else ts end as ts
  from events
""")
def tolerant_timestamp(spark, sf_dir):
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.concat(F.lit("at "), F.date_format("ts", "HH:mm")))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == "signup", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("000")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))
    )
    return zoneless(table(spark, sf_dir, "events").select("event_id", to_timestamp(text).alias("ts")), "ts")


@query("silver_flat", """
  select cast(s_suppkey as varchar) as _source_id, s_name as name, n_name as nation, r_name as region,
    n_regionkey as region_key, s_acctbal as balance, cast(trunc(s_acctbal) as integer) as whole_balance,
    timestamp '2024-02-01 12:00:00' as _ingestion_timestamp, 'run-1' as _ingestion_id,
    cast(null as double) as rating
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def silver_flat(spark, sf_dir):
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    docs = suppliers.select(
        F.col("s_suppkey").alias("_id"),
        F.col("s_name").alias("name"),
        F.struct(
            F.col("n_name").alias("name"), F.struct(F.col("r_name").alias("name"), F.col("n_regionkey").alias("key")).alias("region")
        ).alias("nation"),
        F.concat(F.lit("~ "), F.col("s_acctbal").cast("decimal(12,2)").cast("string"), F.lit(" EUR")).alias("balance"),
        F.lit("n/a").alias("scores"),
    )
    fields = [
        FieldPath("name", "name"), FieldPath("nation.name", "nation"), FieldPath("nation.region.name", "region"),
        FieldPath("nation.region.key", "region_key", "int"), FieldPath("balance", "balance", "double"),
        FieldPath("balance", "whole_balance", "int"), FieldPath("scores.rating", "rating", "double"),
    ]
    current = latest.latest_bronze(shaped_documents(docs, "run-1", "full"))
    flat = refine.flatten(current, fields, keep=["_source_id", "_ingestion_id", "_ingestion_timestamp"])
    return zoneless(flat, "_ingestion_timestamp")


@query("silver_events", """
  select cast(event_id as varchar) as _source_id, user_id, event_type, ts,
    cast(json_extract_string(props, '$.k') as integer) as k from events
""")
def silver_events(spark, sf_dir):
    current = latest.latest_bronze(shaped_documents(event_docs(spark, sf_dir), "run-1"))
    fields = [
        FieldPath("user_id", "user_id", "bigint"), FieldPath("event_type", "event_type"),
        FieldPath("ts", "ts", "timestamp"), FieldPath("props", "props"),
    ]
    flat = refine.flatten(current, fields, keep=["_source_id"])
    inner = refine.flatten(flat, [FieldPath("k", "k", "int")], keep=["_source_id", "user_id", "event_type", "ts"], body="props")
    return zoneless(inner, "ts")


@query("expand_json", f"""
  select cast(_id as varchar) as doc_key, _id, user_id, event_type, ts, props from ({EVENT_DOC_SQL})
""")
def expand_json(spark, sf_dir):
    docs = event_docs(spark, sf_dir)
    bodies = docs.select(F.col("_id").cast("string").alias("doc_key"), F.to_json(F.struct(*docs.columns)).alias("body"))
    return refine.expand(bodies, ["doc_key"]).select("doc_key", "_id", "user_id", "event_type", "ts", "props")


@query("variant_read", """
  select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, 'OBJECT<k: BIGINT>' as shape from events
""")
def variant_read(spark, sf_dir):
    docs = refine.read_variant(table(spark, sf_dir, "events"), ["event_id"], body="props")
    return docs.select(
        "event_id", F.variant_get("doc", "$.k", "bigint").alias("k"), F.schema_of_variant("doc").alias("shape")
    )


@query("infer_schema", """
  select 'OBJECT<' || string_agg(field || ': ' || kind, ', ' order by field) || '>' as "schema" from (
    select field, case when bool_and(t in ('BIGINT', 'UBIGINT')) then 'BIGINT'
        when bool_and(t = 'VARCHAR') then 'STRING' else 'VARIANT' end as kind
    from (select unnest(json_keys(body)) as field, unnest(list_transform(json_keys(body),
            lambda f: json_type(body, '$.' || f))) as t
          from (select to_json({a_key: event_id, b_type: event_type, c_user:
            case when value > 100 then null else user_id end})::varchar as body from events))
    where t <> 'NULL' group by field)
""")
def infer_schema(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    user = F.when(F.col("value") > 100, None).otherwise(F.col("user_id"))
    body = F.to_json(F.struct(F.col("event_id").alias("a_key"), F.col("event_type").alias("b_type"), user.alias("c_user")),
                     {"ignoreNullFields": "false"})
    return refine.infer_schema(events.select(body.alias("body")))


@query("orphan_references", """
  select doc_id, count(*) as child_rows from documents
  where doc_id not in (select doc_id from labels) group by doc_id
""")
def orphan_references(spark, sf_dir):
    return references.orphan_keys(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id")


@query("orphan_lines", """
  select l_orderkey, count(*) as child_rows from lineitem
  where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'F') group by l_orderkey
""")
def orphan_lines(spark, sf_dir):
    kept = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "F")
    return references.orphan_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", kept, "o_orderkey")


@query("enrich_reference", """
  select event_id, e.user_id, event_type, c_name, c_mktsegment
  from (select event_id, case when event_type = 'error' then 7 when event_type = 'view' then null
          else user_id end as user_id, event_type from events) e
  left join customer on e.user_id = c_custkey
""")
def enrich_reference(spark, sf_dir):
    kind = F.col("event_type")
    user = F.when(kind == "error", F.lit(7).cast("bigint")).when(kind == "view", None).otherwise(F.col("user_id"))
    events = table(spark, sf_dir, "events").select("event_id", user.alias("user_id"), "event_type")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    current = latest.latest_record(customer, ["c_custkey"], latest.total_order(customer, ["c_custkey"], []))
    return references.enrich(events, "user_id", current, "c_custkey")
