"""Landing, Bronze, upsert, streaming and whole runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from weirgate.catalog.inputs import (
    EVENT_BODY_SQL, EVENT_LINES_SQL, event_docs, event_lines, shaped_documents, zoneless,
)
from weirgate.catalog.registry import MARK, RUN_AT, TAG, query, table
from weirgate.functions.columns import canonical_text as to_canonical_text
from weirgate.functions.columns import content_hash as hash_of
from weirgate.functions.columns import sanitize_columns as to_clean_columns
from weirgate.functions.json_values import source_key as key_of
from weirgate.operators import upsert
from weirgate.operators.latest import latest_bronze, total_order
from weirgate.operators.refine import FieldPath
from weirgate.plans import bronze, control
from weirgate.plans.refine_job import build_silver
from weirgate.plans.run import RunContext, documents, reprocess, run
from weirgate.plans.snapshots import append_manifest, consolidate, export_by_day, read_manifest, snapshot_tables
from weirgate.session import work_dir
from weirgate.sources.files import read_lines
from weirgate.spec import Contract, DatasetSpec, FieldRule, Layout
from weirgate.streaming.landing_stream import consume_landing

DOCS = DatasetSpec("events", load_type="incremental", mark_field="ts", mark_kind="string")


@query("bronze_shape", f"""
  select cast(_id as varchar) as _source_id, body as body_json, cast(null as varchar) as _rescued_data,
    sha256(body) as _source_hash, 'run-1' as _ingestion_id,
    timestamp '2024-02-01 12:00:00' as _ingestion_timestamp, 'tables/events' as _source_path,
    'incremental' as _load_type, date '2024-02-01' as _ingestion_date
  from ({EVENT_BODY_SQL})
""")
def bronze_shape(spark, sf_dir):
    return zoneless(shaped_documents(event_docs(spark, sf_dir), "run-1"), "_ingestion_timestamp").drop("_source_file")


@query("content_hash", "select doc_id, sha256(coalesce(text, '')) as _source_hash from documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", hash_of(F.col("text")).alias("_source_hash"))


@query("source_key", f"""
  select line as body, case when value < 1 then null else source_id end as _source_id
  from ({EVENT_LINES_SQL})
""")
def source_key(spark, sf_dir):
    return event_lines(spark, sf_dir).select(F.col("value").alias("body"), key_of(F.col("value")).alias("_source_id"))


@query("landing_parse", f"""
  select line as value, source_id as _source_id, case when value < 1 then line end as _rescued_data
  from ({EVENT_LINES_SQL})
""")
def landing_parse(spark, sf_dir):
    path = work_dir(spark, "lines")
    event_lines(spark, sf_dir).write.text(path)
    return bronze.parse_lines(read_lines(spark, path)).drop("_source_file")


@query("quarantine_split", f"""
  select source_id as _source_id, sha256(line) as _source_hash,
    case when value < 1 then 'not a JSON object' when source_id is null then 'no key' end as _reason
  from ({EVENT_LINES_SQL})
""")
def quarantine_split(spark, sf_dir):
    folder, path = work_dir(spark, "lines"), work_dir(spark, "bronze")
    event_lines(spark, sf_dir).write.text(folder)
    parsed = bronze.parse_lines(read_lines(spark, folder))
    bronze.append_load(bronze.shape(parsed, "run-1", RUN_AT, TAG, "full"), path, "run-1")
    good = bronze.read_bronze(spark, path).withColumn("_reason", F.lit(None).cast("string"))
    both = good.unionByName(bronze.read_quarantine(spark, path))
    return both.select("_source_id", "_source_hash", "_reason")


@query("quarantine_reason", """
  select conv_id, turn, len(long_words) as n_words,
    case when len(long_words) = 0 then timestamp '2024-02-01 12:00:00' end as quarentena_em,
    case when len(long_words) = 0 then 'no long words' end as motivo
  from (select *, list_filter(string_split(text, ' '), lambda w: length(w) > 14) as long_words from conversations)
""")
def quarantine_reason(spark, sf_dir):
    words = F.filter(F.split("text", " "), lambda w: F.length(w) > 14)
    listed = table(spark, sf_dir, "conversations").select("conv_id", "turn", words.alias("long_words"))
    marked = bronze.mark_blank(listed, "long_words", RUN_AT, "no long words")
    return zoneless(marked, "quarentena_em").select(
        "conv_id", "turn", F.size("long_words").cast("bigint").alias("n_words"), "quarentena_em", "motivo"
    )


@query("sanitize_columns", """
  select c_custkey as c_custkey, c_name as c_name, c_nationkey as c_name_2, c_mktsegment as col from customer
""")
def sanitize_columns(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return to_clean_columns(customer.toDF("c custkey", " c;{name}", "c(name", "=,;"))


@query("canonical_text", """
  select cast(event_id as varchar) as event_id,
    case when date_part('microsecond', ts) % 1000000 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S')
         else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') end as ts,
    cast(user_id as varchar) as user_id, event_type, cast(value as varchar) as value, props,
    lower(hex(encode(event_type))) as raw, strftime(cast(ts as date), '%Y-%m-%d') as day,
    cast(cast(value as decimal(12, 2)) as varchar) as price
  from events
""")
def canonical_text(spark, sf_dir):
    return to_canonical_text(table(spark, sf_dir, "events").withColumns({
        "raw": F.encode("event_type", "utf-8"),
        "day": F.to_date("ts"),
        "price": F.col("value").cast("decimal(12,2)"),
    }))


@query("append_two_runs", """
  select case when ts <= timestamp '2024-01-15' then 'run-1' else 'run-2' end as _ingestion_id,
    count(*) as n_rows, count(distinct event_id) as n_keys
  from events group by 1
""")
def append_two_runs(spark, sf_dir):
    docs, path = event_docs(spark, sf_dir), work_dir(spark, "bronze")
    early = docs.where(F.col("ts") <= f"{MARK}.000000")
    late = docs.where(F.col("ts") > f"{MARK}.000000")
    # The second run is written twice, as after a crash: its folder is replaced.
    for run_id, part in (("run-1", early), ("run-2", late), ("run-2", late)):
        bronze.append_load(shaped_documents(part, run_id), path, run_id)
    per_key = bronze.read_bronze(spark, path).groupBy("_ingestion_id", "_source_id").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("_ingestion_id").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys")
    )


def _order_changes(orders):
    """Pending orders move twice and the later state wins; finished ones come back as new keys."""
    pending = orders.where(F.col("o_orderstatus") == "P")
    day = F.make_dt_interval(days=F.lit(1))
    first = pending.withColumns({"o_orderdate": F.col("o_orderdate") + day, "o_orderstatus": F.lit("F")})
    second = pending.withColumns({"o_orderdate": F.col("o_orderdate") + day + day, "o_orderstatus": F.lit("O")})
    new = orders.where(F.col("o_orderstatus") == "F").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return first.unionByName(second).unionByName(new)


@query("upsert_merge", """
  select o_orderkey, o_custkey, o_totalprice, o_orderpriority,
    case when o_orderstatus = 'P' then 'O' else o_orderstatus end as o_orderstatus,
    case when o_orderstatus = 'P' then o_orderdate + interval 2 day else o_orderdate end as o_orderdate
  from orders
  union all
  select -o_orderkey - 1, o_custkey, o_totalprice, o_orderpriority, o_orderstatus, o_orderdate
  from orders where o_orderstatus = 'F'
""")
def upsert_merge(spark, sf_dir):
    orders, path = table(spark, sf_dir, "orders"), work_dir(spark, "keyed")
    newest = total_order(orders, ["o_orderkey"], ["o_orderdate"])
    upsert.upsert(orders, path, "o_orderkey", newest)
    upsert.upsert(_order_changes(orders), path, "o_orderkey", newest)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in orders.schema)
    return upsert.read_keyed(spark, path, ddl)


@query("reprocess_landing", f"""
  select cast(_id as varchar) as _source_id, sha256(body) as _source_hash,
    case when ts <= '2024-01-15T00:00:00.000000' then 'run-1' else 'run-2' end as _ingestion_id
  from ({EVENT_BODY_SQL})
""")
def reprocess_landing(spark, sf_dir):
    layout = Layout(work_dir(spark, "root"))
    docs = event_docs(spark, sf_dir)
    folder = layout.landing(DOCS.name)
    bronze.write_landing(docs.where(F.col("ts") <= f"{MARK}.000000"), f"{folder}/run_id=run-1")
    bronze.write_landing(docs.where(F.col("ts") > f"{MARK}.000000"), f"{folder}/run_id=run-2")
    ctx = RunContext(spark, layout, at=RUN_AT)
    reprocess(ctx, DOCS)
    return documents(ctx, DOCS).select("_source_id", "_source_hash", "_ingestion_id")


@query("idempotent_rerun", """
  with m as (select max(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')) filter (where ts <= timestamp '2024-01-15') as first_mark,
      max(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')) as last_mark,
      count(*) filter (where ts <= timestamp '2024-01-15') as early, count(*) as n from events)
  select 'run-1' as run_id, 'SUCCESS' as status, early as qtd_lida_origem, early as qtd_gravada_destino,
    cast(null as varchar) as watermark_inicial, first_mark as watermark_final from m
  union all select 'run-2', 'SUCCESS', 0, 0, first_mark, first_mark from m
  union all select 'run-3', 'SUCCESS', n - early, n - early, first_mark, last_mark from m
  union all select 'run-4', 'SUCCESS', 0, 0, last_mark, last_mark from m
""")
def idempotent_rerun(spark, sf_dir):
    docs, layout = event_docs(spark, sf_dir), Layout(work_dir(spark, "root"))
    early = docs.where(F.col("ts") <= f"{MARK}.000000")
    for n, source in enumerate((early, early, docs, docs), start=1):
        run(RunContext(spark, layout, run_id=f"run-{n}", source_tag=TAG), {"events": source}, [DOCS])
    return control.run_log(spark, layout).select(
        F.col("_ingestion_id").alias("run_id"), "status", "qtd_lida_origem", "qtd_gravada_destino",
        "watermark_inicial", "watermark_final",
    )


@query("empty_load", """
  select 'allowed' as collection, case when count(*) = 0 then 'SUCCESS' end as status,
    count(*) as qtd_lida_origem, count(*) as qtd_gravada_destino from events where value < 0
  union all
  select 'expected', case when count(*) = 0 then 'PARTIAL' end, count(*), count(*) from events where value < 0
""")
def empty_load(spark, sf_dir):
    none = event_docs(spark, sf_dir).join(
        table(spark, sf_dir, "events").where(F.col("value") < 0).select(F.col("event_id").alias("_id")), "_id", "left_semi"
    )
    specs = [DatasetSpec("allowed", allow_empty=True), DatasetSpec("expected")]
    layout = Layout(work_dir(spark, "root"))
    done = run(RunContext(spark, layout, run_id="run-1"), {"allowed": none, "expected": none}, specs)
    return done.select("collection", "status", "qtd_lida_origem", "qtd_gravada_destino")


@query("full_run_upsert", """
  select cast(c_custkey as varchar) as _source_id,
    to_json({c_custkey: c_custkey, c_name: case when c_mktsegment = 'BUILDING' then c_name || ' Ltd' else c_name end,
      c_nationkey: c_nationkey, c_mktsegment: c_mktsegment})::varchar as body_json,
    'run-2' as _ingestion_id, 'full' as _load_type
  from customer
""")
def full_run_upsert(spark, sf_dir):
    customer, layout = table(spark, sf_dir, "customer"), Layout(work_dir(spark, "root"))
    spec = DatasetSpec("customer", key="c_custkey", exclude=("c_acctbal",), rows_per_bucket=1000)
    longer = F.when(F.col("c_mktsegment") == "BUILDING", F.concat("c_name", F.lit(" Ltd"))).otherwise(F.col("c_name"))
    for n, source in enumerate((customer, customer.withColumn("c_name", longer)), start=1):
        run(RunContext(spark, layout, run_id=f"run-{n}"), {"customer": source}, [spec])
    return documents(RunContext(spark, layout), spec).select("_source_id", "body_json", "_ingestion_id", "_load_type")


SIX = [
    DatasetSpec("events", key="event_id", load_type="incremental", mark_field="ts"),
    DatasetSpec("orders", key="o_orderkey", load_type="incremental", mark_field="o_orderdate", threshold_pct=0.5),
    DatasetSpec("customer", key="c_custkey", exclude=("c_acctbal",), threshold_pct=0.0),
    DatasetSpec("supplier", key="s_suppkey", threshold_pct=0.0),
    DatasetSpec("documents", key="doc_id", expected_min=10),
    DatasetSpec("embeddings", key="vec_id", exclude=("embedding",)),
]
SIX_CONTRACTS = {
    "events": Contract("events", (FieldRule("event_id", "int", required=True), FieldRule("ts", "datetime", required=True))),
    "customer": Contract("customer", (FieldRule("c_name", "string", required=True),), forbidden=("c_acctbal",)),
    "supplier": Contract("supplier", (FieldRule("s_acctbal", "number"),), forbidden=("s_name",)),
    "embeddings": Contract("embeddings", (FieldRule("label", "int"),), forbidden=("embedding",)),
}


@query("full_run", """
  select 'events' as collection, 'incremental' as load_type, 'SUCCESS' as status, count(*) as qtd_lida_origem,
    count(*) as qtd_gravada_destino, strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f') as watermark_final, 0.0::double as divergencia_pct
  from events
  union all select 'orders', 'incremental', 'SUCCESS', count(*), count(*),
    strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S'), 0.0 from orders
  union all select 'customer', 'full', 'SUCCESS', count(*), count(distinct c_custkey), null, 0.0 from customer
  union all select 'supplier', 'full', 'PARTIAL', count(*), count(distinct s_suppkey), null, 0.0 from supplier
  union all select 'documents', 'full', 'SUCCESS', count(*), count(distinct doc_id), null, 0.0 from documents
  union all select 'embeddings', 'full', 'SUCCESS', count(*), count(distinct vec_id), null, 0.0 from embeddings
""")
def full_run(spark, sf_dir):
    """Six datasets in one run; one of them leaks a field that its contract forbids."""
    ctx = RunContext(spark, Layout(work_dir(spark, "root")), run_id="run-1", contracts=SIX_CONTRACTS)
    done = run(ctx, {spec.name: table(spark, sf_dir, spec.name) for spec in SIX}, SIX, parallel=3)
    return done.select(
        "collection", "load_type", "status", "qtd_lida_origem", "qtd_gravada_destino", "watermark_final", "divergencia_pct"
    )


@query("silver_tables", """
  select 'turns_words' as "table", conv_id || '-' || turn as _source_id, value, cast(min(pos) as integer) as position, cast(null as varchar) as role
  from (select conv_id, turn, unnest(string_split(text, ' ')) as value,
      unnest(range(len(string_split(text, ' ')))) as pos from conversations) group by conv_id, turn, value
  union all select 'turns', conv_id || '-' || turn, null, null, role from conversations
""")
def silver_tables(spark, sf_dir):
    layout = Layout(work_dir(spark, "root"))
    docs = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("_id"), "role", F.split("text", " ").alias("words")
    )
    current = latest_bronze(shaped_documents(docs, "run-1", "full"))
    # The second build replaces the first, whose columns were others.
    build_silver(current, layout, "turns", [FieldPath("words", "raw_words")])
    build_silver(current, layout, "turns", [FieldPath("role", "role")], ["words"])
    flat = spark.read.parquet(layout.silver("turns")).select(F.lit("turns").alias("table"), "_source_id", "role")
    words = spark.read.parquet(layout.silver("turns_words")).withColumn("table", F.lit("turns_words"))
    return words.unionByName(flat, allowMissingColumns=True)


@query("stream_bronze", f"""
  select source_id as _source_id, sha256(line) as _source_hash from ({EVENT_LINES_SQL}) where source_id is not null
""")
def stream_bronze(spark, sf_dir):
    layout = Layout(work_dir(spark, "root"))
    folder = f"{layout.landing('events')}/drop"
    event_lines(spark, sf_dir).repartition(3).write.text(folder)
    ctx = RunContext(spark, layout, at=RUN_AT)
    consume_landing(ctx, DOCS, folder, max_files=2)
    consume_landing(ctx, DOCS, folder, max_files=2)
    return documents(ctx, DOCS).select("_source_id", "_source_hash")


@query("consolidate_days", """
  with days as (select *, cast(ts as date) as dt from events
      where cast(ts as date) between date '2024-01-03' and date '2024-01-20')
  select 'events' as table_name, 'OK' as status, count(*) as linhas_lidas,
    count(distinct user_id) as linhas_bronze from days
  union all select 'returns', 'SKIP', 0, 0 where (select count(*) from events) >= 0
""")
def consolidate_days(spark, sf_dir):
    root = work_dir(spark, "snap")
    export_by_day(table(spark, sf_dir, "events"), f"{root}/events", F.to_date("ts"))
    done = consolidate(
        spark, {"events": f"{root}/events", "returns": f"{root}/returns"},
        dt.date(2024, 1, 3), dt.date(2024, 1, 20), f"{root}/out", {"events": ["user_id"]},
    )
    return done.select("table_name", "status", "linhas_lidas", "linhas_bronze")


@query("snapshot_run", """
  select 'customer' as source_table, 'OK' as status, count(*) as row_count, true as has_size from customer
  union all select 'orders', 'OK', count(*), true from orders
""")
def snapshot_run(spark, sf_dir):
    root = work_dir(spark, "snap")
    tables = {name: table(spark, sf_dir, name) for name in ("customer", "orders")}
    append_manifest(snapshot_tables(spark, tables, f"{root}/tables", "run-1", RUN_AT), f"{root}/manifest")
    done = read_manifest(spark, f"{root}/manifest")
    return done.select("source_table", "status", "row_count", (F.col("file_size_bytes") > 0).alias("has_size"))
