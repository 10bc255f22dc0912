"""Fixed schemas: what fits, what is rescued, what a stream keeps."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.operators.rescue import inferred, rescued, typed, with_added
from weirgate.plans import bronze
from weirgate.plans.run import RunContext, documents
from weirgate.session import remove, small_frame
from weirgate.spec import DatasetSpec
from weirgate.streaming.landing_stream import consume_landing
from weirgate.streaming.schema_store import evolve, history, newest, rescued_counts

SPEC = DatasetSpec("drop", load_type="incremental", mark_field="ts")
DDL = (
    "a bigint, d double, s string, b boolean, big decimal(38,0), l array<bigint>, o struct<x: bigint, y: struct<z: string>>, "
    "m array<struct<k: bigint>>"
)


@pytest.fixture
def schema(spark):
    return T.StructType.fromDDL(DDL)


def lines(spark, *texts):
    return small_frame(spark, [(t,) for t in texts], "value string")


@pytest.mark.parametrize(("text", "outside"), [
    ('{"a":1,"d":1.5,"s":"x","b":true,"l":[1,2],"o":{"x":1,"y":{"z":"q"}},"m":[{"k":1},{}]}', None),
    ('{"a":null,"s":null,"l":null,"o":null,"m":[null]}', None),
    ('{"d":7,"big":12345678901234567890123,"l":[]}', None),
    ('{"d":1e300,"big":5}', None),
    ("{}", None),
    ('{"a":"1"}', {"a": "1"}),
    ('{"a":1.5,"s":5}', {"a": 1.5, "s": 5}),
    ('{"a":12345678901234567890123}', {"a": 12345678901234567890123}),
    ('{"l":[1,"2"],"b":"true"}', {"l": [1, "2"], "b": "true"}),
    ('{"l":{"0":1}}', {"l": {"0": 1}}),
    ('{"o":{"x":1,"new":2},"a":3}', {"o": {"x": 1, "new": 2}}),
    ('{"o":{"y":{"z":1}}}', {"o": {"y": {"z": 1}}}),
    ('{"m":[{"k":1},{"k":"2"}]}', {"m": [{"k": 1}, {"k": "2"}]}),
    ('{"A":1,"extra":null,"a b.c":[{}]}', {"A": 1, "extra": None, "a b.c": [{}]}),
])
def test_what_fits_and_what_is_rescued(spark, schema, text, outside):
    row = lines(spark, text).select(
        rescued(F.col("value"), schema).alias("r"), F.to_json(typed(F.col("value"), schema), {"ignoreNullFields": "true"}).alias("t")
    ).first()
    assert (None if row["r"] is None else json.loads(row["r"])) == outside
    kept = {k: v for k, v in json.loads(text).items() if v is not None and k not in (outside or {})}
    assert set(json.loads(row["t"])) == set(kept)


def test_texts_that_are_no_plain_objects(spark, schema):
    texts = lines(spark, "[1]", "5", "", "{bad", '{"a":1,"a":2}', None)
    assert [r[0] for r in texts.select(rescued(F.col("value"), schema)).collect()] == [None, None, None, "{bad", '{"a":1,"a":2}', None]


def test_inference_over_mixed_texts(spark):
    found = inferred(lines(spark, '{"a":1,"n":null,"o":{"x":1}}', '{"a":2.5,"o":{"y":[1]}}', "[1]", "bad", None, '{"c":1,"e":12345678901234567890123}'), "value")
    types = {f.name: f.dataType for f in found}
    assert types["a"] == T.DoubleType() and types["n"] == T.StringType() and types["e"] == T.DecimalType(38, 0)
    assert types["o"] == T.StructType.fromDDL("x bigint, y array<bigint>") and types["c"] == T.LongType()
    assert inferred(lines(spark, "[1]", "bad"), "value") is None


def test_fold_adds_fields_and_never_changes_types(spark):
    known = T.StructType.fromDDL("a bigint, o struct<x: bigint>, l array<struct<k: string>>")
    seen = T.StructType.fromDDL("a string, o struct<y: double, x: double>, l array<struct<k: bigint, v: bigint>>, z boolean")
    want = T.StructType.fromDDL("a bigint, o struct<x: bigint, y: double>, l array<struct<k: string, v: bigint>>, z boolean")
    assert with_added(known, seen) == want and with_added(want, seen) == want


def put(spark, layout, *texts):
    lines(spark, *texts).coalesce(1).write.mode("append").text(layout.landing("drop"))


def rows(ctx):
    found = documents(ctx, SPEC).select("_source_id", "_rescued_data", "body_json").collect()
    return {r["_source_id"]: (r["_rescued_data"], r["body_json"]) for r in found}


def test_a_restarted_stream_keeps_its_schema(spark, layout):
    ctx = RunContext(spark, layout)
    put(spark, layout, "{bad", "[1]")
    consume_landing(ctx, SPEC, schema_mode="rescue")
    assert newest(spark, layout.schemas("drop")) is None  # nothing to learn from yet
    put(spark, layout, '{"_id":1,"v":1}')
    consume_landing(ctx, SPEC, schema_mode="rescue")
    put(spark, layout, '{"_id":2,"v":"x","w":1}', '{"no":"key"}')
    consume_landing(RunContext(spark, layout), SPEC, schema_mode="rescue")
    assert newest(spark, layout.schemas("drop")) == T.StructType.fromDDL("_id bigint, v bigint")
    assert history(spark, layout.schemas("drop")).count() == 1
    assert rows(ctx) == {"1": (None, '{"_id":1,"v":1}'), "2": ('{"v":"x","w":1}', '{"_id":2,"v":"x","w":1}')}
    quarantined = bronze.read_quarantine(spark, layout.bronze("drop")).select("body_json", "_reason").collect()
    assert {tuple(r) for r in quarantined} == {
        ("{bad", "not a JSON object"), ("[1]", "not a JSON object"), ('{"no":"key"}', "no key")
    }
    counts = rescued_counts(bronze.read_bronze(spark, layout.bronze("drop"))).select("field", "rows").collect()
    assert {tuple(r) for r in counts} == {("v", 1), ("w", 1)}


def test_added_fields_make_a_version_and_replays_make_none(spark, layout):
    ctx = RunContext(spark, layout)
    put(spark, layout, '{"_id":1,"v":1}')
    consume_landing(ctx, SPEC, schema_mode="add")
    put(spark, layout, '{"_id":2,"v":"x","w":{"q":1}}')
    consume_landing(ctx, SPEC, schema_mode="add")
    assert newest(spark, layout.schemas("drop")) == T.StructType.fromDDL("_id bigint, v bigint, w struct<q: bigint>")
    for name in ("1", ".1.crc"):
        remove(spark, f"{layout.checkpoint('drop')}/commits/{name}")
    assert consume_landing(ctx, SPEC, schema_mode="add") == 1
    assert sorted(r["version"] for r in history(spark, layout.schemas("drop")).collect()) == [1, 2]
    assert rows(ctx)["2"][0] == '{"v":"x"}'


def test_a_version_that_broke_off_is_passed_over(spark, layout):
    path = layout.schemas("drop")
    evolve(lines(spark, '{"a":1}'), path, "load-1")
    small_frame(spark, [], "version int, schema string, load_id string").write.parquet(f"{path}/v000002")
    assert newest(spark, path) == T.StructType.fromDDL("a bigint")
    with pytest.raises(ValueError, match="schema mode"):
        evolve(lines(spark, '{"a":1}'), path, "load-2", "other")
