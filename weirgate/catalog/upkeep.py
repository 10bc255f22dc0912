"""Tables that are kept up batch by batch, and rebuilt from what was landed."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from weirgate.catalog.inputs import EVENT_BODY_SQL, event_docs, order_mark_history
from weirgate.catalog.registry import RUN_AT, query, table
from weirgate.functions.json_values import document
from weirgate.operators import upsert
from weirgate.operators.latest import total_order
from weirgate.operators.refine import FieldPath, flatten
from weirgate.plans import accumulated, control
from weirgate.plans.run import RunContext, documents, reprocess, run
from weirgate.plans.snapshots import export_named_documents, write_named_file
from weirgate.schemas import WATERMARK_DDL
from weirgate.session import work_dir
from weirgate.spec import DatasetSpec, Layout


@query("upsert_small_batches", """
  select o_orderkey, o_custkey, o_orderpriority, o_orderdate,
    case when day(o_orderdate) <= 6 then 'X' else o_orderstatus end as o_orderstatus,
    case when day(o_orderdate) <= 6 then o_totalprice + day(o_orderdate) else o_totalprice end as o_totalprice
  from orders
""")
def upsert_small_batches(spark, sf_dir):
    """Six batches, one for each of the first days of a month; each changes a few rows of every bucket."""
    orders, path = table(spark, sf_dir, "orders"), work_dir(spark, "keyed")
    newest = total_order(orders, ["o_orderkey"], ["o_orderdate"])
    upsert.upsert(orders, path, "o_orderkey", newest)
    for day in range(1, 7):
        changed = orders.where(F.dayofmonth("o_orderdate") == day).withColumns({
            "o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + day
        })
        upsert.upsert(changed, path, "o_orderkey", newest)
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in orders.schema)
    return upsert.read_keyed(spark, path, ddl)


KEPT = DatasetSpec("events", load_type="incremental", mark_field="loaded", mark_kind="string", keep_current=True)


@query("current_incremental", """
  select cast(event_id as varchar) as _source_id,
    case when event_type = 'click' and ts < timestamp '2024-01-21' then 'tap' else event_type end as event_type,
    cast(case when event_type = 'error' and ts < timestamp '2024-01-11' then -1 else user_id end as bigint) as user_id,
    case when ts >= timestamp '2024-01-21' or event_type = 'click' then 'run-3'
         when ts >= timestamp '2024-01-11' or event_type = 'error' then 'run-2' else 'run-1' end as _ingestion_id
  from events
""")
def current_incremental(spark, sf_dir):
    """Three loads, the later ones with new versions of earlier events.  Two are folded, the last lies over the fold."""
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("_id"), "user_id", "event_type", "ts")
    first, second = F.col("ts") < "2024-01-11", (F.col("ts") >= "2024-01-11") & (F.col("ts") < "2024-01-21")
    errors = events.where(first & (F.col("event_type") == "error")).withColumn("user_id", F.lit(-1).cast("bigint"))
    taps = events.where((F.col("ts") < "2024-01-21") & (F.col("event_type") == "click")).withColumn("event_type", F.lit("tap"))
    loads = [events.where(first), events.where(second).unionByName(errors), events.where(F.col("ts") >= "2024-01-21").unionByName(taps)]
    layout = Layout(work_dir(spark, "root"))
    for n, rows in enumerate(loads, start=1):
        ctx = RunContext(spark, layout, run_id=f"run-{n}", at=RUN_AT + dt.timedelta(days=n))
        source = rows.drop("ts").withColumn("loaded", F.lit(f"load-{n}"))
        run(ctx, {"events": source}, [KEPT if n < 3 else replace(KEPT, keep_current=False)])
    fields = [FieldPath("event_type", "event_type"), FieldPath("user_id", "user_id", "bigint")]
    return flatten(documents(RunContext(spark, layout), KEPT), fields, keep=["_source_id", "_ingestion_id"])


DAILY = DatasetSpec("events", load_type="incremental", mark_field="ts", mark_kind="string", expected_min=1)


@query("reprocess_many_runs", f"""
  with days as (select strftime(cast(ts as timestamp), 'day-%d') as day, cast(_id as varchar) as id, sha256(body) as h from ({EVENT_BODY_SQL}))
  select day as _ingestion_id, 'SUCCESS' as status, count(*) as qtd_lida_origem, count(*) as qtd_gravada_destino,
    count(distinct id) as documents, min(h) as least_hash from days group by day
""")
def reprocess_many_runs(spark, sf_dir):
    """A run for each day, all rebuilt from their landing folders at once."""
    layout = Layout(work_dir(spark, "root"))
    docs = event_docs(spark, sf_dir)
    day = F.date_format(F.to_timestamp("ts"), "'day-'dd")
    docs.select(document(docs).alias("value"), day.alias("run_id")).write.partitionBy("run_id").text(layout.landing("events"))
    ctx = RunContext(spark, layout, at=RUN_AT)
    reprocess(ctx, DAILY)
    held = documents(ctx, DAILY).groupBy("_ingestion_id").agg(
        F.count(F.lit(1)).alias("documents"), F.min("_source_hash").alias("least_hash")
    )
    log = control.run_log(spark, layout).select("_ingestion_id", "status", "qtd_lida_origem", "qtd_gravada_destino")
    return log.join(held, "_ingestion_id")


CHECKED = [
    DatasetSpec("orders", key="o_orderkey", load_type="incremental", mark_field="o_orderdate"),
    DatasetSpec("customer", key="c_custkey"),
]


@query("accumulated_in_run", """
  select 'orders' as collection, 'run-1' as run_id, count(*) as soma_control_log, count(*) as linhas_bronze, 0 as delta, true as accumulated_ok
  from orders where o_orderdate < timestamp '1996-01-01'
  union all select 'orders', 'run-2', count(*), count(*), 0, true from orders
  union all select 'customer', 'run-1', count(*), count(*), 0, true from customer
  union all select 'customer', 'run-2', 2 * count(*), count(*), -count(*), true from customer
""")
def accumulated_in_run(spark, sf_dir):
    """Two runs that check what all runs wrote: an appended dataset, and an upserted one that is loaded twice."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    layout = Layout(work_dir(spark, "root"))
    for n, source in enumerate((orders.where(F.col("o_orderdate") < "1996-01-01"), orders), start=1):
        ctx = RunContext(spark, layout, run_id=f"run-{n}", accumulate=True)
        run(ctx, {"orders": source, "customer": customer}, CHECKED, parallel=2)
    return accumulated.checks(spark, layout).select(
        "collection", F.col("_ingestion_id").alias("run_id"), "soma_control_log", "linhas_bronze", "delta", "accumulated_ok"
    )


@query("control_folded", """
  select o_orderpriority as collection, strftime(max(o_orderdate), '%Y-%m-%d') as watermark_value from orders group by 1
""")
def control_folded(spark, sf_dir):
    """Marks appended year by year, folded twice on the way, and read as the newest of each dataset."""
    layout = Layout(work_dir(spark, "root"))
    marks = order_mark_history(spark, sf_dir)
    for year in range(1995, 2002):
        part = marks.where(F.col("_ingestion_id").startswith(str(year)))
        control.append(part.select(*[c.split()[0] for c in WATERMARK_DDL.split(", ")]), layout, control.WATERMARKS, f"year-{year}")
        if year in (1997, 2000):
            control.fold(spark, layout, control.WATERMARKS, WATERMARK_DDL)
    return control.current_marks(control.watermarks(spark, layout)).select("collection", "watermark_value")


@query("named_file_export", """
  select c_custkey, c_name, c_mktsegment, 'customer.parquet' as file_name from customer
""")
def named_file_export(spark, sf_dir):
    """A table as one file of a given name, written twice and read back."""
    path = f"{work_dir(spark, 'files')}/customer.parquet"
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    write_named_file(customer.limit(1), path)
    write_named_file(customer, path)
    return spark.read.parquet(path).withColumn("file_name", F.element_at(F.split(F.input_file_name(), "/"), -1))


@query("documents_to_files", """
  select 'part-' || p_partkey || '.json' as file_name,
    to_json({id: 'part-' || p_partkey, p_name: p_name, p_size: p_size})::varchar as body
  from part order by 'part-' || p_partkey limit 50
""")
def documents_to_files(spark, sf_dir):
    """The first fifty documents by key, each as a file that bears its key."""
    folder = work_dir(spark, "files")
    parts = table(spark, sf_dir, "part").select(F.concat(F.lit("part-"), "p_partkey").alias("id"), "p_name", "p_size")
    export_named_documents(parts, folder, "id", 50)
    lines = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json")
    return lines.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file_name"), F.rtrim(F.regexp_replace("value", "\n$", "")).alias("body"))
