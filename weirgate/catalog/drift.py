"""Landings whose documents change while a stream reads them."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirgate.catalog.registry import RUN_AT, query, table
from weirgate.operators.rescue import expand_known
from weirgate.plans import bronze
from weirgate.plans.run import RunContext, documents
from weirgate.session import work_dir
from weirgate.spec import DatasetSpec, Layout
from weirgate.streaming.landing_stream import consume_landing
from weirgate.streaming.schema_store import newest, rescued_counts

DROPS = DatasetSpec("events", load_type="incremental", mark_field="ts", mark_kind="string")

# Events by thirds of the month: the first has the plain fields; the second adds an object and writes the value of
# errors as text; the third adds a flag to views and makes the value of clicks a list.
_DROP = "case when ts < timestamp '2024-01-11' then 1 when ts < timestamp '2024-01-21' then 2 else 3 end"
_RESCUED_SQL = f"""
  select event_id, user_id, event_type, value, props, {_DROP} as n,
    case when {_DROP} = 2 and event_type = 'error' then '{{"props":' || replace(props, ' ', '') || ',"value":"' || value || '"}}'
         when {_DROP} = 2 then '{{"props":' || replace(props, ' ', '') || '}}'
         when {_DROP} = 3 and event_type = 'view' then '{{"flag":true}}'
         when {_DROP} = 3 and event_type = 'click' then '{{"value":[' || user_id || ']}}' end as rescued
  from events
"""


def _drops(events):
    """The lines of the three drops."""
    value = F.col("value").cast("string")
    plain = F.format_string('"_id":%d,"user_id":%d,"event_type":"%s"', "event_id", "user_id", "event_type")
    first = F.concat(F.lit("{"), plain, F.lit(',"value":'), value, F.lit("}"))
    text = F.when(F.col("event_type") == "error", F.concat(F.lit('"'), value, F.lit('"'))).otherwise(value)
    second = F.concat(F.lit("{"), plain, F.lit(',"props":'), "props", F.lit(',"value":'), text, F.lit("}"))
    listed = F.when(F.col("event_type") == "click", F.format_string("[%d]", "user_id")).otherwise(value)
    flag = F.when(F.col("event_type") == "view", ',"flag":true').otherwise("")
    third = F.concat(F.lit("{"), plain, F.lit(',"value":'), listed, flag, F.lit("}"))
    parts = [F.col("ts") < "2024-01-11", (F.col("ts") >= "2024-01-11") & (F.col("ts") < "2024-01-21"), F.col("ts") >= "2024-01-21"]
    return [events.where(part).select(line.alias("value")) for part, line in zip(parts, (first, second, third))]


def _streamed(spark, sf_dir, mode):
    """Each drop is read by a stream of its own, so the second and the third find the schema that the first kept."""
    layout = Layout(work_dir(spark, "root"))
    folder = f"{layout.landing('events')}/drop"
    ctx = RunContext(spark, layout, at=RUN_AT)
    for lines in _drops(table(spark, sf_dir, "events")):
        lines.write.mode("append").text(folder)
        consume_landing(ctx, DROPS, folder, schema_mode=mode)
    return ctx


@query("stream_schema_rescue", f"""
  select event_id as _id, user_id, event_type,
    case when rescued like '%"value"%' then null else value end as value, rescued as _rescued_data
  from ({_RESCUED_SQL})
""")
def stream_schema_rescue(spark, sf_dir):
    ctx = _streamed(spark, sf_dir, "rescue")
    return expand_known(documents(ctx, DROPS), ["_rescued_data"], newest(spark, ctx.layout.schemas("events")))


@query("stream_schema_add", f"""
  select event_id as _id, user_id, event_type, case when n = 2 then cast(json_extract(props, '$.k') as bigint) end as k,
    case when n = 3 and event_type = 'view' then true end as flag,
    case when rescued like '%"value"%' then null else value end as value,
    case when n = 2 and event_type = 'error' then '{{"value":"' || value || '"}}'
         when rescued like '%"value":[%' then rescued end as _rescued_data
  from ({_RESCUED_SQL})
""")
def stream_schema_add(spark, sf_dir):
    """The same drops where new fields become columns; values of other types are still rescued."""
    ctx = _streamed(spark, sf_dir, "add")
    known = expand_known(documents(ctx, DROPS), ["_rescued_data"], newest(spark, ctx.layout.schemas("events")))
    return known.select("_id", "user_id", "event_type", F.col("props.k").alias("k"), "flag", "value", "_rescued_data")


@query("rescued_fields", f"""
  select field, count(*) as "rows" from (
    select unnest(json_keys(rescued)) as field from ({_RESCUED_SQL}) where rescued is not null) group by field
""")
def rescued_fields(spark, sf_dir):
    ctx = _streamed(spark, sf_dir, "rescue")
    counts = rescued_counts(bronze.read_bronze(spark, ctx.layout.bronze("events")))
    return counts.groupBy("field").agg(F.sum("rows").alias("rows"))
