"""Documents and run logs that the queries derive from the given tables.

Each has a Spark and an SQL form.  Dirt is placed by what a row holds, so it grows with the
tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirgate.catalog.registry import RUN_AT, TAG, table
from weirgate.plans import bronze
from weirgate.plans.control import build_run_log
from weirgate.sources.scans import document_frame

# One document per event; the time stays text to the microsecond.
EVENT_DOC_SQL = """
  select event_id as _id, user_id, event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as ts, props from events
"""

_DOC_JSON = "to_json({_id: _id, user_id: user_id, event_type: event_type, ts: ts, props: props})::varchar"
EVENT_BODY_SQL = f"select *, {_DOC_JSON} as body from ({EVENT_DOC_SQL})"


def event_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_documents(table(spark, sf_dir, "events"))


def as_documents(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("_id"), "user_id", "event_type",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "props",
    )


def shaped_documents(docs: DataFrame, run_id: str, load_type: str = "incremental") -> DataFrame:
    """Documents in Bronze form, as if they had been landed and read back."""
    lines = document_frame(docs, "_id").select(F.col("body").alias("value"), F.lit("").alias("_source_file"))
    return bronze.shape(bronze.parse_lines(lines), run_id, RUN_AT, TAG, load_type)


# Landing lines: small values come broken, cheap signups come without a key, errors carry
# the extended form of the key.
EVENT_LINES_SQL = """
  select event_id, event_type, value,
    case when value < 1 then left(line, length(line) - 3) else line end as line,
    case when value < 1 or (event_type = 'signup' and value < 20) then null
         else cast(event_id as varchar) end as source_id
  from (select event_id, event_type, value,
    '{' || case when event_type = 'signup' and value < 20 then ''
                when event_type = 'error' then '"_id":{"$oid":"' || event_id || '"},'
                else '"_id":' || event_id || ',' end
        || '"user_id":' || user_id || ',"event_type":"' || event_type || '"}' as line
    from events)
"""


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = (
        F.when((F.col("event_type") == "signup") & (F.col("value") < 20), "")
        .when(F.col("event_type") == "error", F.format_string('"_id":{"$oid":"%d"},', "event_id"))
        .otherwise(F.format_string('"_id":%d,', "event_id"))
    )
    line = F.concat(
        F.lit("{"), key, F.format_string('"user_id":%d,"event_type":"%s"}', "user_id", "event_type")
    )
    broken = F.left(line, F.length(line) - 3)
    return table(spark, sf_dir, "events").select(F.when(F.col("value") < 1, broken).otherwise(line).alias("value"))


# Documents that break their contract, differently per event type:
#   event_type  missing when value < 10, null when value in [10, 12)
#   user_id     text instead of a number for errors with value < 30
#   ts          not a time for views with value < 15
#   secret      present when value > 300
CONTRACT_DOCS_SQL = """
  select event_id, event_type as kind, value,
    value < 10 as type_missing, value >= 10 and value < 12 as type_null,
    event_type = 'error' and value < 30 as user_text,
    event_type = 'view' and value < 15 as ts_bad, value > 300 as has_secret
  from events
"""


def contract_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, kind = F.col("value"), F.col("event_type")
    parts = F.concat_ws(
        ",",
        F.format_string('"_id":"%024x"', "event_id"),
        F.when(value < 10, None).when(value < 12, '"event_type":null')
        .otherwise(F.format_string('"event_type":"%s"', kind)),
        F.when((kind == "error") & (value < 30), F.format_string('"user_id":"%d"', "user_id"))
        .otherwise(F.format_string('"user_id":%d', "user_id")),
        F.when((kind == "view") & (value < 15), '"ts":"soon"')
        .otherwise(F.format_string('"ts":"%s"', F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))),
        F.when(value > 300, '"secret":"x"'),
    )
    body = F.concat(F.lit("{"), parts, F.lit("}"))
    return table(spark, sf_dir, "events").select("event_id", kind.alias("kind"), body.alias("body_json"))


# A run log with one run per order: the priority is the dataset, the customer number stands
# for seconds and for losses.
RUN_LOG_SQL = """
  select cast(o_orderkey as varchar) as _ingestion_id, o_orderpriority as collection,
    case when o_orderstatus = 'O' then 'full' else 'incremental' end as load_type,
    lida as qtd_lida_origem, gravada as qtd_gravada_destino,
    o_orderdate as start_time, o_orderdate + to_seconds(o_custkey) as end_time,
    cast(o_custkey as double) as duracao_seg,
    case o_orderstatus when 'F' then 'FAILED' when 'P' then 'PARTIAL' else 'SUCCESS' end as status,
    case when o_orderstatus = 'F' then repeat('lost ', 900)[:4000] end as mensagem_erro,
    o_custkey as qtd_quarentena, cast(o_custkey % 3 as bigint) as qtd_duplicada_lote,
    round((lida - gravada) * 100.0::double / lida, 4) as divergencia_pct
  from (select *, cast(floor(o_totalprice) as bigint) as lida,
          cast(floor(o_totalprice) as bigint) - case when o_orderstatus = 'F' then o_custkey else 0 end as gravada
        from orders)
"""


def order_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    counted = table(spark, sf_dir, "orders").withColumn("lida", F.floor("o_totalprice")).withColumn(
        "gravada", F.col("lida") - F.when(status == "F", F.col("o_custkey")).otherwise(F.lit(0))
    )
    runs = counted.select(
        F.col("o_orderkey").cast("string").alias("_ingestion_id"),
        F.col("o_orderpriority").alias("collection"),
        F.when(status == "O", "full").otherwise("incremental").alias("load_type"),
        F.col("lida").alias("qtd_lida_origem"),
        F.col("gravada").alias("qtd_gravada_destino"),
        F.col("o_orderdate").cast("timestamp").alias("start_time"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_custkey"))).cast("timestamp").alias("end_time"),
        F.when(status == "F", "FAILED").when(status == "P", "PARTIAL").otherwise("SUCCESS").alias("status"),
        F.when(status == "F", F.repeat(F.lit("lost "), F.lit(900))).otherwise("").alias("mensagem_erro"),
        F.col("o_custkey").alias("qtd_quarentena"),
        (F.col("o_custkey") % 3).alias("qtd_duplicada_lote"),
        F.round((F.col("lida") - F.col("gravada")) * F.lit(100.0) / F.col("lida"), 4).alias("divergencia_pct"),
    )
    return build_run_log(runs)


def order_mark_history(spark, sf_dir):
    """Each month of orders is a run that stored its newest order date."""
    return table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("collection"), F.date_format("o_orderdate", "yyyy-MM").alias("_ingestion_id")
    ).agg(
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("watermark_value"),
        F.max("o_orderdate").cast("timestamp").alias("updated_at"),
    ).withColumns({"watermark_field": F.lit("o_orderdate"), "watermark_type": F.lit("string")})


def zoneless(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps without zone, as the given tables have them."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})
