"""Dashboards over the run log, drift and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.catalog.inputs import (
    CONTRACT_DOCS_SQL, RUN_LOG_SQL, contract_docs, order_mark_history, order_run_log, zoneless,
)
from weirgate.catalog.registry import RUN_AT, query, table
from weirgate.operators import contract as contracts
from weirgate.operators import profile
from weirgate.plans import observe
from weirgate.spec import Contract, FieldRule


@query("obs_daily_volume", f"""
  select cast(start_time as date) as dia, collection, cast(sum(qtd_lida_origem) as bigint) as lidos_origem,
    cast(sum(qtd_gravada_destino) as bigint) as gravados_bronze, cast(sum(qtd_quarentena) as bigint) as quarentena
  from ({RUN_LOG_SQL}) group by 1, 2
""")
def obs_daily_volume(spark, sf_dir):
    return observe.daily_volume(order_run_log(spark, sf_dir))


@query("obs_throughput", f"""
  select _ingestion_id, start_time, collection, duracao_seg, qtd_gravada_destino,
    round(qtd_gravada_destino / nullif(duracao_seg, 0), 1) as linhas_por_seg from ({RUN_LOG_SQL})
""")
def obs_throughput(spark, sf_dir):
    return zoneless(observe.throughput(order_run_log(spark, sf_dir)), "start_time")


@query("obs_failure_rate", f"""
  select cast(start_time as date) as dia, count(*) as execucoes, count(*) filter (where status = 'SUCCESS') as ok,
    count(*) filter (where status = 'PARTIAL') as partial, count(*) filter (where status = 'FAILED') as failed,
    round(100.0::double * count(*) filter (where status = 'FAILED') / count(*), 2) as pct_falha
  from ({RUN_LOG_SQL}) group by 1
""")
def obs_failure_rate(spark, sf_dir):
    return observe.failure_rate(order_run_log(spark, sf_dir))


@query("obs_divergent_runs", f"""
  select _ingestion_id, collection, start_time, qtd_lida_origem, qtd_gravada_destino, divergencia_pct,
    qtd_duplicada_lote, status from ({RUN_LOG_SQL}) where divergencia_pct > 0 or status <> 'SUCCESS'
""")
def obs_divergent_runs(spark, sf_dir):
    return zoneless(observe.divergent_runs(order_run_log(spark, sf_dir)), "start_time")


@query("obs_last_status", f"""
  select collection, load_type, status, qtd_lida_origem, qtd_gravada_destino, divergencia_pct, duracao_seg, end_time
  from (select *, row_number() over (partition by collection order by start_time desc, _ingestion_id desc) as rn
    from ({RUN_LOG_SQL})) where rn = 1
""")
def obs_last_status(spark, sf_dir):
    return zoneless(observe.last_status(order_run_log(spark, sf_dir)), "end_time")


@query("obs_watermark_progress", """
  select o_orderpriority as collection, 'o_orderdate' as watermark_field,
    strftime(max(o_orderdate), '%Y-%m-%d') as watermark_value, 'string' as watermark_type, max(o_orderdate) as updated_at
  from orders group by 1
""")
def obs_watermark_progress(spark, sf_dir):
    return zoneless(observe.mark_progress(order_mark_history(spark, sf_dir)), "updated_at")


@query("obs_contract_violations", f"""
  with c as (select kind, count(*) as docs, count(*) filter (where type_missing) as tm,
      count(*) filter (where has_secret) as sec from ({CONTRACT_DOCS_SQL}) group by kind)
  select collection, field, kind,
    case kind when 'missing' then 'absent' else 'present' end || ' in ' || hits || ' of ' || docs || ' documents' as detail,
    round(hits * 100.0::double / docs, 4) as violation_pct, timestamp '2024-02-01 12:00:00' as detected_at from (
    select kind as collection, 'event_type' as field, 'missing' as kind, tm as hits, docs from c
      where tm * 100.0::double / docs > 5
    union all select kind, 'secret', 'forbidden', sec, docs from c where sec > 0)
""")
def obs_contract_violations(spark, sf_dir):
    rules = Contract("events", (FieldRule("event_type", "string", required=True, nullable=True),), ("secret",))
    docs = contract_docs(spark, sf_dir).withColumnRenamed("kind", "collection")
    metrics = contracts.contract_metrics(docs, rules, by=["collection"])
    found = contracts.contract_violations(metrics, rules, by=["collection"])
    stamped = found.withColumn("detected_at", F.lit(RUN_AT.isoformat()).cast("timestamp"))
    listed = observe.newest_violations(stamped).withColumn("violation_pct", F.round("violation_pct", 4))
    return zoneless(listed, "detected_at")


@query("schema_drift", """
  select field, count(*) as occurrences,
    round(count(*) * 100.0::double / (select count(*) from events), 1) as pct_docs
  from (select unnest(case when value > 100 then ['event_id', 'event_type', 'user_id', 'value']
      when value > 20 then ['event_id', 'event_type', 'user_id'] else ['event_id', 'event_type'] end) as field
    from events) group by field
""")
def schema_drift(spark, sf_dir):
    value = F.col("value")
    body = F.to_json(F.struct(
        "event_id", "event_type", F.when(value > 20, F.col("user_id")).alias("user_id"), F.when(value > 100, value).alias("value")
    ))
    return profile.schema_drift(table(spark, sf_dir, "events").select(body.alias("body")))


_NUMERIC = ["c_custkey", "c_nationkey", "c_acctbal"]
_TEXT = ["c_name", "c_mktsegment"]


@query("column_profile", " union all ".join([
    f"select '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_null, "
    f"round(avg({c}), 4) as mean_value, round(stddev_samp({c}), 4) as stddev_value, "
    f"cast(min({c}) as double) as min_value, cast(max({c}) as double) as max_value, "
    f"cast(null as varchar) as min_text, cast(null as varchar) as max_text from customer" for c in _NUMERIC
] + [
    f"select '{c}', count(*), count(*) - count({c}), null, null, null, null, min({c}), max({c}) from customer"
    for c in _TEXT
]))
def column_profile(spark, sf_dir):
    stats = profile.column_profile(table(spark, sf_dir, "customer"))
    return stats.withColumns({c: F.round(c, 4) for c in ("mean_value", "stddev_value")})


_MANIFEST_SQL = """
  select strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as ingested_at, o_orderpriority as source_table,
    case o_orderstatus when 'F' then 'ERRO' when 'O' then 'OK' else 'SKIP' end as status,
    o_custkey as row_count, cast(floor(o_totalprice) as bigint) as file_size_bytes, o_orderkey from orders
"""


def _manifest(spark, sf_dir):
    """Each order stands for one transferred file."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"),
        F.concat_ws("/", "o_orderpriority", F.col("o_orderkey").cast("string")).alias("source_table"),
        F.when(status == "F", "ERRO").when(status == "O", "OK").otherwise("SKIP").alias("status"),
        F.col("o_custkey").alias("row_count"),
        F.floor("o_totalprice").alias("file_size_bytes"),
        F.when(status == "F", F.format_string("timeout on %d", "o_orderkey")).otherwise("").alias("error"),
    )


@query("manifest_daily", f"""
  select cast(ingested_at[:10] as date) as dia, count(*) as arquivos, cast(sum(row_count) as bigint) as linhas,
    round(sum(file_size_bytes) / 1048576.0::double, 2) as mb
  from ({_MANIFEST_SQL}) where status = 'OK' group by 1
""")
def manifest_daily(spark, sf_dir):
    return observe.manifest_daily(_manifest(spark, sf_dir))


@query("manifest_errors", f"""
  select ingested_at, source_table || '/' || o_orderkey as source_table, 'timeout on ' || o_orderkey as error
  from ({_MANIFEST_SQL}) where status = 'ERRO'
  order by ingested_at desc, source_table || '/' || o_orderkey limit 50
""")
def manifest_errors(spark, sf_dir):
    return observe.manifest_errors(_manifest(spark, sf_dir))


@query("job_result_counts", f"select status, count(*) as n from ({_MANIFEST_SQL}) group by status")
def job_result_counts(spark, sf_dir):
    return observe.result_counts(_manifest(spark, sf_dir))
