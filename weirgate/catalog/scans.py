"""Scans, counts, marks and file sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.catalog.inputs import EVENT_BODY_SQL, event_docs
from weirgate.catalog.registry import MARK, RUN_AT, query, table
from weirgate.functions.json_values import body_without
from weirgate.functions.marks import mark_text
from weirgate.operators.profile import table_counts
from weirgate.operators.refine import FieldPath, flatten
from weirgate.plans.bronze import write_landing
from weirgate.plans.snapshots import export_by_day, with_audit
from weirgate.session import work_dir
from weirgate.sources import keyed_scan, scans
from weirgate.sources.files import read_csv, read_days, read_lines
from weirgate.spec import DatasetSpec

EVENTS = DatasetSpec(
    "events", key="event_id", load_type="incremental", mark_field="ts", exclude=("props", "event_id")
)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@query("scan_incremental", """
  select event_id, ts, user_id, event_type, value from events where ts > timestamp '2024-01-15'
""")
def scan_incremental(spark, sf_dir):
    return scans.scan_incremental(table(spark, sf_dir, "events"), EVENTS, MARK)


@query("scan_resumed", """
  select cast(event_id as varchar) as _id, user_id, event_type from events
""")
def scan_resumed(spark, sf_dir):
    """A scan in eight ranges of the key that stops after three and goes on from its marks."""
    events, root = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), work_dir(spark, "scan")
    for most in (3, None):
        keyed_scan.land_in_ranges(events, "event_id", f"{root}/landing", f"{root}/state", 8, write_landing, most=most)
    fields = [FieldPath("event_id", "_id"), FieldPath("user_id", "user_id", "bigint"), FieldPath("event_type", "event_type")]
    return flatten(read_lines(spark, f"{root}/landing"), fields, body="value")


@query("key_ranges", """
  select 'o_totalprice' as key, 10 as ranges, count(*) as "rows", true as even from orders
  union all select 'ts', 10, count(*), true from events
  union all select 'c_name', 10, count(*), true from customer
  union all select 'l_partkey', 10, count(*), true from lineitem where l_returnflag = 'R'
""")
def key_ranges(spark, sf_dir):
    """Ranges planned from a sketch: a price, a time, a text and a repeated number; none far from its share."""
    parts = []
    for name, key, rows in (
        ("orders", "o_totalprice", None), ("events", "ts", None), ("customer", "c_name", None), ("lineitem", "l_partkey", "l_returnflag = 'R'"),
    ):
        df = table(spark, sf_dir, name)
        df = df.where(rows) if rows else df
        ranges = keyed_scan.plan_ranges(df, key, 10)
        place = F.lit(-1)
        for r in ranges:
            place = F.when(r.contains(key, df.schema[key].dataType), r.place).otherwise(place)
        counts = df.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n"))
        share = F.col("rows") / 10
        parts.append(counts.agg(
            F.lit(key).alias("key"), F.count(F.lit(1)).cast("int").alias("ranges"), F.sum("n").alias("rows"),
            F.min("n").alias("least"), F.max("n").alias("most"),
        ).select("key", "ranges", "rows", ((F.col("least") > share * 0.7) & (F.col("most") < share * 1.3)).alias("even")))
    return reduce(DataFrame.unionByName, parts)


@query("source_count", "select count(*) as n_rows from events where ts > timestamp '2024-01-15'")
def source_count(spark, sf_dir):
    return scans.source_count(table(spark, sf_dir, "events"), "ts", MARK)


@query("watermark_max", """
  select 'events' as collection, strftime(max(ts), '%Y-%m-%dT%H:%M:%S.%f') as mark_max from events
  union all
  select 'orders', max(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.000000000') from orders
""")
def watermark_max(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text_mark = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(".000000000"))
    orders = table(spark, sf_dir, "orders").select(text_mark.alias("mark"))
    by_time = scans.mark_max(events, "ts").select(
        F.lit("events").alias("collection"),
        mark_text(F.col("mark_max"), events.schema["ts"].dataType).alias("mark_max"),
    )
    return by_time.unionByName(scans.mark_max(orders, "mark").withColumn("collection", F.lit("orders")))


@query("watermark_range", """
  select min(ts) as mark_min, max(ts) as mark_max, count(*) filter (where ts is null) as without_mark
  from (select case when value >= 5 then ts end as ts from events)
""")
def watermark_range(spark, sf_dir):
    marked = table(spark, sf_dir, "events").select(F.when(F.col("value") >= 5, F.col("ts")).alias("ts"))
    return scans.mark_range(marked, "ts")


@query("bounded_sample", """
  select c_custkey, c_name, c_nationkey, c_mktsegment from customer order by c_custkey limit 80
""")
def bounded_sample(spark, sf_dir):
    return scans.bounded_sample(table(spark, sf_dir, "customer"), 80, "c_custkey", ["c_acctbal"])


@query("doc_body_frame", f"select cast(_id as varchar) as _id, body from ({EVENT_BODY_SQL})")
def doc_body_frame(spark, sf_dir):
    return scans.document_frame(event_docs(spark, sf_dir), "_id")


@query("projection_exclude", """
  select c_custkey, to_json({c_custkey: c_custkey, c_name: c_name, c_nationkey: c_nationkey,
    c_mktsegment: c_mktsegment})::varchar as body from customer
""")
def projection_exclude(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    docs = customer.select("c_custkey", F.to_json(F.struct(*customer.columns)).alias("body"))
    return docs.select("c_custkey", body_without(F.col("body"), ["c_acctbal", "c_custkey"], "c_custkey").alias("body"))


@query("projection_exact", """
  select l_orderkey, l_linenumber, '{ "line": "' || l_orderkey || '-' || l_linenumber || '","price": '
    || cast(l_extendedprice as decimal(18, 2)) || '000000000000000000000001e5 , "say": "a \\" } , b"}' as body
  from lineitem
""")
def projection_exact(spark, sf_dir):
    """Numbers beyond any number type, escapes and blanks come out as they were written."""
    line = table(spark, sf_dir, "lineitem")
    inner = F.concat(F.lit(',"secret": {"a": [1, "}", {"price": "x\\\\"}]}, "'), F.lit('\\u0073hh'), F.lit('":"'), F.col("l_returnflag"), F.lit('"}'))
    head = F.concat(F.lit('{ "line": "'), "l_orderkey", F.lit("-"), "l_linenumber", F.lit('",'))
    price = F.concat(
        F.lit('"price": '), F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
        F.lit('000000000000000000000001e5 , "say": "a \\" } , b"'),
    )
    docs = line.select(
        "l_orderkey", "l_linenumber", F.concat(head, price, inner).alias("body")
    )
    return docs.select("l_orderkey", "l_linenumber", body_without(F.col("body"), ["secret", "shh"]).alias("body"))


@query("projection_exclude_wide", "select vec_id, label from embeddings")
def projection_exclude_wide(spark, sf_dir):
    return scans.exclude(table(spark, sf_dir, "embeddings"), ["embedding"], "vec_id")


@query("table_counts", " union all ".join(
    f"select '{t}' as collection, count(*) as n_rows from {t}" for t in TABLES
))
def count_tables(spark, sf_dir):
    return table_counts({t: table(spark, sf_dir, t) for t in TABLES})


@query("csv_roundtrip", "select * from customer")
def csv_roundtrip(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = work_dir(spark, "csv")
    customer.write.option("header", True).csv(path)
    return read_csv(spark, path, customer.schema)


@query("csv_inferred", """
  select cast(c_custkey as integer) as c_custkey, c_name, cast(c_nationkey as integer) as c_nationkey,
    c_acctbal, c_mktsegment from customer
""")
def csv_inferred(spark, sf_dir):
    path = work_dir(spark, "csv")
    table(spark, sf_dir, "customer").write.option("header", True).option("sep", ";").csv(path)
    return read_csv(spark, path, sep=";")


@query("landing_roundtrip", "select event_id, ts, user_id, event_type, value, props from events")
def landing_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = work_dir(spark, "landing")
    write_landing(events, path)
    fields = [
        FieldPath("event_id", "event_id", "bigint"), FieldPath("ts", "ts", "timestamp_ntz"),
        FieldPath("user_id", "user_id", "bigint"), FieldPath("event_type", "event_type"),
        FieldPath("value", "value", "double"), FieldPath("props", "props"),
    ]
    return flatten(read_lines(spark, path), fields, body="value")


@query("snapshot_export", """
  select o_orderkey, o_custkey, o_totalprice, 'run-1' as _run_id, 'shop.orders' as _source_table,
    '2024-02-01T12:00:00+00:00' as _ingested_at, cast(date_trunc('month', o_orderdate) as date) as dt
  from orders
""")
def snapshot_export(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    path = work_dir(spark, "snapshot")
    export_by_day(with_audit(orders, "run-1", "shop.orders", RUN_AT), path, F.trunc("o_orderdate", "month"))
    return spark.read.parquet(path).drop("o_orderdate")


@query("date_range_scan", """
  select event_id, user_id, value, cast(ts as date) as dt from events
  where cast(ts as date) between date '2024-01-05' and date '2024-01-12'
""")
def date_range_scan(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts")
    path = work_dir(spark, "days")
    export_by_day(events, path, F.to_date("ts"))
    return read_days(spark, path, "2024-01-05", "2024-01-12").drop("ts")
