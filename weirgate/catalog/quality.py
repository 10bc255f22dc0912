"""Metrics, reconciliation, contracts, marks and control rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.catalog.inputs import (
    CONTRACT_DOCS_SQL, RUN_LOG_SQL, contract_docs, order_mark_history, order_run_log, zoneless,
)
from weirgate.catalog.registry import query, table
from weirgate.functions.marks import later, parse_mark
from weirgate.operators import contract as contracts
from weirgate.operators import quality
from weirgate.operators.profile import table_counts
from weirgate.plans import control
from weirgate.session import small_frame
from weirgate.spec import Contract, FieldRule

_DIRTY_SQL = "select case when event_type = 'signup' and value < 20 then null else event_id end as key, event_type from events"


@query("batch_key_quality", f"""
  select event_type, count(*) as "rows", count(*) filter (where key is null) as null_keys,
    round(count(*) filter (where key is null) * 100.0::double / count(*), 4) as null_key_pct,
    cast(0 as bigint) as duplicate_keys
  from ({_DIRTY_SQL}) group by event_type
""")
def batch_key_quality(spark, sf_dir):
    blank = (F.col("event_type") == "signup") & (F.col("value") < 20)
    keyed = table(spark, sf_dir, "events").select(F.when(~blank, F.col("event_id")).alias("key"), "event_type")
    return quality.batch_metrics(keyed, ["key"], ["event_type"]).withColumn("null_key_pct", F.round("null_key_pct", 4))


@query("batch_duplicates", """
  select l_returnflag, cast(sum(n) as bigint) as "rows", cast(0 as bigint) as null_keys, 0.0::double as null_key_pct,
    count(*) filter (where n > 1) as duplicate_keys
  from (select l_returnflag, l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2, 3) group by 1
""")
def batch_duplicates(spark, sf_dir):
    return quality.batch_metrics(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_returnflag"])


@query("duplicate_keys", """
  select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1
""")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


# What a faulty load left of the orders of each month:
#   month 2 lost the cheapest, month 3 lost a fifth, month 4 doubled some, month 5 has rows
#   without a key, month 6 lost everything, the others are whole.
_TARGET_SQL = """
  select o_orderkey as key, strftime(o_orderdate, '%Y-%m') as month, month(o_orderdate) as m, o_totalprice from orders
  where not (month(o_orderdate) = 2 and o_totalprice < 15000)
    and not (month(o_orderdate) = 3 and o_totalprice < 100000) and month(o_orderdate) <> 6
"""


@query("reconcile_status", f"""
  with src as (select strftime(o_orderdate, '%Y-%m') as month, count(*) as source_count from orders group by 1),
  arrived as (
    select case when m = 5 and o_totalprice > 450000 then null else key end as key, month from ({_TARGET_SQL})
    union all select key, month from ({_TARGET_SQL}) where m = 4 and o_totalprice > 480000),
  dst as (select month, cast(sum(n) as bigint) as written_count,
      cast(coalesce(sum(n) filter (where key is null), 0) as bigint) as null_keys,
      count(*) filter (where n > 1 and key is not null) as duplicate_keys
    from (select month, key, count(*) as n from arrived group by 1, 2) group by 1),
  m as (select coalesce(src.month, dst.month) as month, coalesce(source_count, 0) as s, coalesce(written_count, 0) as w,
      coalesce(null_keys, 0) as nk, coalesce(duplicate_keys, 0) as dup,
      case when right(coalesce(src.month, dst.month), 2) = '07' then 0.0::double else 1.0::double end as lim
    from src full join dst on src.month = dst.month),
  d as (select *, case when s <= 0 then case when w <= 0 then 0.0 else 100.0 end
      else abs(s - w)::double / s * 100.0 end as div from m),
  j as (select *, case when nk > 0 or (w < s and div > 5.0) then 'FAILED'
      when div > lim or dup > 0 then 'PARTIAL' else 'SUCCESS' end as status from d)
  select month, s as source_count, w as written_count, nk as null_keys, dup as duplicate_keys,
    round(div, 4) as divergencia_pct, status, status = 'SUCCESS' or (status = 'PARTIAL' and not w < s) as may_advance
  from j
""")
def reconcile_status(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        F.month("o_orderdate").alias("m"), "o_totalprice",
    )
    m, price = F.col("m"), F.col("o_totalprice")
    lost = ((m == 2) & (price < 15000)) | ((m == 3) & (price < 100000)) | (m == 6)
    kept = orders.where(~lost)
    keyless = (m == 5) & (price > 450000)
    arrived = kept.withColumn("key", F.when(~keyless, F.col("key"))).unionByName(
        kept.where((m == 4) & (price > 480000))
    )
    own = orders.select("month").distinct().where(F.col("month").endswith("07"))
    judged = quality.reconcile(
        orders, arrived, ["key"], ["month"], thresholds=own.withColumn("threshold_pct", F.lit(0.0))
    )
    return judged.select(
        "month", "source_count", "written_count", "null_keys", "duplicate_keys", "divergencia_pct", "status", "may_advance"
    )


@query("accumulated_recon", f"""
  with held as (
    select collection, upserted, count(*) as n, count(distinct key) as k from (
      select o_orderpriority as collection, o_orderpriority < '3' as upserted, o_custkey as key from orders
      where o_orderstatus <> 'F' and o_orderpriority >= '3'
      union all
      select distinct o_orderpriority, true, o_custkey from orders where o_orderstatus <> 'F' and o_orderpriority < '3')
    group by 1, 2),
  logged as (select o_orderpriority as collection,
      count(*) filter (where o_orderstatus <> 'F') + case when o_orderpriority = '5-LOW' then 1 else 0 end as s
    from orders group by o_orderpriority)
  select logged.collection, s as soma_control_log, n as linhas_bronze, n - s as delta,
    case when upserted then k = n and n <= s else n = s end as accumulated_ok
  from logged join held on logged.collection = held.collection
""")
def accumulated_recon(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    runs = orders.groupBy(
        F.col("o_orderpriority").alias("collection"), F.date_format("o_orderdate", "yyyy-MM").alias("_ingestion_id"),
        F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCESS").alias("status"),
    ).agg(F.count(F.lit(1)).alias("qtd_gravada_destino"))
    # One dataset logs a row that never arrived.
    extra = orders.where(F.col("o_orderpriority") == "5-LOW").groupBy(F.col("o_orderpriority").alias("collection")).agg(
        F.lit(1).cast("bigint").alias("qtd_gravada_destino")
    ).select("collection", F.lit("late").alias("_ingestion_id"), F.lit("PARTIAL").alias("status"), "qtd_gravada_destino")
    stored = orders.where(F.col("o_orderstatus") != "F").select(
        F.col("o_orderpriority").alias("collection"), (F.col("o_orderpriority") < "3").alias("upserted"), F.col("o_custkey").alias("key")
    )
    tables = stored.where(~F.col("upserted")).unionByName(stored.where("upserted").distinct())
    checked = quality.accumulated_check(runs.unionByName(extra), tables, "key")
    return checked.select("collection", "soma_control_log", "linhas_bronze", "delta", "accumulated_ok")


EVENT_CONTRACT = Contract(
    "events",
    (
        FieldRule("_id", "objectid", required=True),
        FieldRule("event_type", "string", required=True),
        FieldRule("user_id", "int", required=True),
        FieldRule("ts", "datetime", nullable=True),
        FieldRule("note", "object"),
    ),
    forbidden=("secret", "password"),
)

_COUNTS_SQL = f"""
  select count(*) as docs, count(*) filter (where type_missing) as tm, count(*) filter (where type_null) as tn,
    count(*) filter (where user_text) as ut, count(*) filter (where ts_bad) as tb, count(*) filter (where has_secret) as sec
  from ({CONTRACT_DOCS_SQL})
"""


@query("contract_check", f"""
  select docs, '_id' as field, 0 as missing, 0 as nulls, 0 as wrong_type, null as present from ({_COUNTS_SQL})
  union all select docs, 'event_type', tm, tn, 0, null from ({_COUNTS_SQL})
  union all select docs, 'user_id', 0, 0, ut, null from ({_COUNTS_SQL})
  union all select docs, 'ts', 0, 0, tb, null from ({_COUNTS_SQL})
  union all select docs, 'note', docs, 0, 0, null from ({_COUNTS_SQL})
  union all select docs, 'secret', null, null, null, sec from ({_COUNTS_SQL})
  union all select docs, 'password', null, null, null, 0 from ({_COUNTS_SQL})
""")
def contract_check(spark, sf_dir):
    metrics = contracts.contract_metrics(contract_docs(spark, sf_dir), EVENT_CONTRACT)
    return metrics.drop("type", "required", "nullable")


_VIOLATIONS_SQL = f"""
  select * from (
    select 'event_type' as field, 'missing' as kind, tm as hits, tm * 100.0::double / docs as pct, 5.0 as lim from ({_COUNTS_SQL})
    union all select 'event_type', 'null', tn, tn * 100.0::double / docs, 5.0 from ({_COUNTS_SQL})
    union all select 'user_id', 'type', ut, ut * 100.0::double / docs, 5.0 from ({_COUNTS_SQL})
    union all select 'ts', 'type', tb, tb * 100.0::double / docs, 5.0 from ({_COUNTS_SQL})
    union all select 'secret', 'forbidden', sec, sec * 100.0::double / docs, 0.0 from ({_COUNTS_SQL})
  ) where pct > lim
"""


@query("contract_violations", f"select field, kind, hits, round(pct, 4) as violation_pct from ({_VIOLATIONS_SQL})")
def contract_violations(spark, sf_dir):
    metrics = contracts.contract_metrics(contract_docs(spark, sf_dir), EVENT_CONTRACT)
    found = contracts.contract_violations(metrics, EVENT_CONTRACT)
    return found.drop("detail").withColumn("violation_pct", F.round("violation_pct", 4))


@query("contract_by_kind", f"""
  with c as (select kind, count(*) as docs, count(*) filter (where type_missing) as tm,
      count(*) filter (where user_text) as ut, count(*) filter (where ts_bad) as tb,
      count(*) filter (where has_secret) as sec from ({CONTRACT_DOCS_SQL}) group by kind)
  select kind as event_kind, field, broken, hits from (
    select kind, 'event_type' as field, 'missing' as broken, tm as hits, tm * 100.0::double / docs > 5 as bad from c
    union all select kind, 'user_id', 'type', ut, ut * 100.0::double / docs > 5 from c
    union all select kind, 'ts', 'type', tb, tb * 100.0::double / docs > 5 from c
    union all select kind, 'secret', 'forbidden', sec, sec > 0 from c) where bad
""")
def contract_by_kind(spark, sf_dir):
    docs = contract_docs(spark, sf_dir).withColumnRenamed("kind", "event_kind")
    rules = Contract(EVENT_CONTRACT.dataset, tuple(r for r in EVENT_CONTRACT.fields if r.name != "note"), ("secret",))
    metrics = contracts.contract_metrics(docs, rules, by=["event_kind"])
    found = contracts.contract_violations(metrics, rules, by=["event_kind"])
    return found.where(F.col("kind") != "null").select("event_kind", "field", F.col("kind").alias("broken"), "hits")


@query("contract_summary", f"""
  select docs, lines is null as contract_ok,
    case when lines is null then 'contract ok (' || docs || ' documents)' else 'contract broken: ' || lines end as summary
  from (select max(docs) as docs from ({_COUNTS_SQL})),
    (select string_agg(line, ', ' order by line) as lines from (
      select field || ':' || kind || '(' || printf('%.1f', pct) || '%)' as line from ({_VIOLATIONS_SQL})))
""")
def contract_summary(spark, sf_dir):
    metrics = contracts.contract_metrics(contract_docs(spark, sf_dir), EVENT_CONTRACT)
    return contracts.contract_summary(contracts.contract_violations(metrics, EVENT_CONTRACT), metrics)


@query("forbidden_fields", f"select 'secret' as field, sec as hits from ({_COUNTS_SQL}) where sec > 0")
def forbidden_fields(spark, sf_dir):
    rules = Contract("events", forbidden=("secret", "password", "jwt"))
    metrics = contracts.contract_metrics(contract_docs(spark, sf_dir), rules)
    return contracts.contract_violations(metrics, rules).select("field", "hits")


_DOCUMENTED = {"orders": (20000, 10), "events": (50000, 1000000000), "labels": (400, 0)}


@query("volume_check", " union all ".join(
    f"select '{name}' as collection, count(*) as n_rows, {rows} as documented_rows, {least} as expected_min, "
    f"count(*) < {least} as below_minimum from {name}" for name, (rows, least) in _DOCUMENTED.items()
))
def volume_check(spark, sf_dir):
    counts = table_counts({name: table(spark, sf_dir, name) for name in _DOCUMENTED})
    rows = [(name, *values) for name, values in _DOCUMENTED.items()]
    documented = small_frame(spark, rows, "collection string, documented_rows int, expected_min int")
    return quality.volume_check(counts, documented)


@query("watermark_parse", """
  select event_id, case event_type when 'view' then null when 'error' then strftime(ts, '%Y-%m-%d %H:%M:%S')
      when 'signup' then strftime(date_trunc('day', ts), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
      when 'purchase' then strftime(ts - interval 2 hour, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'
      else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' end as mark
  from events
""")
def watermark_parse(spark, sf_dir):
    kind = F.col("event_type")
    stored = (
        F.when(kind == "view", "")
        .when(kind == "error", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == "purchase", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    )
    mark_kind = F.when(kind == "error", "string").otherwise("timestamp")
    return table(spark, sf_dir, "events").select("event_id", parse_mark(stored, mark_kind).alias("mark"))


@query("watermark_history", """
  select o_orderpriority as collection, 'o_orderdate' as watermark_field,
    strftime(max(o_orderdate), '%Y-%m-%d') as watermark_value, 'string' as watermark_type,
    strftime(max(o_orderdate), '%Y-%m') as _ingestion_id, max(o_orderdate) as updated_at
  from orders group by 1
""")
def watermark_history(spark, sf_dir):
    return zoneless(control.current_marks(order_mark_history(spark, sf_dir)), "updated_at")


@query("watermark_advance", """
  with r as (select strftime(o_orderdate, '%Y-%m') as _ingestion_id, o_orderpriority as collection,
      count(*) as s, count(*) filter (where o_totalprice >= 20000) as w,
      strftime(max(o_orderdate) filter (where o_totalprice >= 480000), '%Y-%m-%d') as final_mark,
      strftime(min(o_orderdate), '%Y-%m-%d') as previous_mark, max(o_orderdate) as updated_at
    from orders group by 1, 2),
  d as (select *, (s - w)::double / s * 100.0 as div from r)
  select collection, 'o_orderdate' as watermark_field, greatest(previous_mark, final_mark) as watermark_value,
    'string' as watermark_type, _ingestion_id, updated_at
  from d where div <= 1.0 and collection <> '5-LOW'
""")
def watermark_advance(spark, sf_dir):
    price, day = F.col("o_totalprice"), F.col("o_orderdate")
    runs = table(spark, sf_dir, "orders").groupBy(
        F.date_format("o_orderdate", "yyyy-MM").alias("_ingestion_id"), F.col("o_orderpriority").alias("collection")
    ).agg(
        F.count(F.lit(1)).alias("source_count"),
        F.count_if(price >= 20000).alias("written_count"),
        F.date_format(F.max(F.when(price >= 480000, day)), "yyyy-MM-dd").alias("seen_mark"),
        F.date_format(F.min(day), "yyyy-MM-dd").alias("previous_mark"),
        F.max(day).cast("timestamp").alias("updated_at"),
    ).withColumns({
        "null_key_pct": F.lit(0.0), "duplicate_keys": F.lit(0), "contract_ok": F.lit(True),
        "final_mark": later(F.col("previous_mark"), F.col("seen_mark")),
        "load_type": F.when(F.col("collection") == "5-LOW", "full").otherwise("incremental"),
        "forced_full": F.lit(False), "watermark_field": F.lit("o_orderdate"), "watermark_type": F.lit("string"),
    })
    return zoneless(control.advance_marks(quality.judge(runs)), "updated_at")


@query("control_log_build", f"""
  select *, cast(null as varchar) as watermark_inicial, cast(null as varchar) as watermark_final,
    true as contrato_ok, 'batch' as ingest_mode, '' as pipeline_version from ({RUN_LOG_SQL})
""")
def control_log_build(spark, sf_dir):
    return zoneless(order_run_log(spark, sf_dir), "start_time", "end_time").drop("landing_files")


@query("run_lineage", """
  select event_id, cast(ts as date) as _ingestion_date, event_type as _ingestion_id from events
  where event_type in ('click', 'signup') and cast(ts as date) in (date '2024-01-03', date '2024-01-09')
  order by event_id
""")
def run_lineage(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.to_date("ts").alias("_ingestion_date"), F.col("event_type").alias("_ingestion_id")
    )
    return control.of_runs(rows, ["click", "signup"], ["2024-01-03", "2024-01-09"]).orderBy("event_id")


@query("run_verdict", """
  select "month", bool_and(status <> 'FAILED') as ok, count(*) filter (where status = 'FAILED') as failed_count,
    coalesce(string_agg(collection, ',' order by collection) filter (where status = 'FAILED'), '') as failed
  from (select strftime(o_orderdate, '%Y-%m') as "month", o_orderpriority as collection,
      case when count(*) filter (where o_totalprice < 10000) > 0 then 'FAILED' else 'SUCCESS' end as status
    from orders group by 1, 2)
  group by "month"
""")
def run_verdict(spark, sf_dir):
    judged = table(spark, sf_dir, "orders").groupBy(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderpriority").alias("collection")
    ).agg(F.when(F.count_if(F.col("o_totalprice") < 10000) > 0, "FAILED").otherwise("SUCCESS").alias("status"))
    return quality.run_verdict(judged, "month", "collection")


@query("first_run", """
  select _ingestion_id from (select cast(o_orderkey as varchar) as _ingestion_id, o_orderdate from orders)
  order by o_orderdate, _ingestion_id limit 1
""")
def first_run(spark, sf_dir):
    return control.first_run(order_run_log(spark, sf_dir))
