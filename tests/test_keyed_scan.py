"""Key ranges, marks and resuming."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from weirgate.plans.bronze import write_landing
from weirgate.plans.run import RunContext, documents, run
from weirgate.session import small_frame
from weirgate.sources.files import read_lines
from weirgate.sources.keyed_scan import finished, land_in_ranges, plan_ranges, predicates, stored_plan
from weirgate.spec import DatasetSpec


def covered(df, key, ranges):
    """How many ranges each row is in, and the sizes of the ranges."""
    dtype = df.schema[key].dataType
    flags = [r.contains(key, dtype).cast("int") for r in ranges]
    sizes = df.agg(*[F.sum(f) for f in flags]).first()
    once = df.select(sum(flags, F.lit(0)).alias("n")).where("n <> 1").count()
    return once, list(sizes)


@pytest.mark.parametrize(("key", "null"), [
    ("id", False), ("id * id * id", False), ("cast(id as double) / 7", True), ("date_add(date'2020-01-01', cast(id % 900 as int))", False),
    ("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)", True), ("timestamp'2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)", False),
    ("concat('65a1f0', lower(hex(id * 7919)), 'é')", True), ("concat('k', id)", False),
])
def test_ranges_are_even_and_hold_each_row_once(spark, key, null):
    expression = f"case when id % 10 = 3 then null else {key} end" if null else key
    df = spark.range(4000).select(F.expr(expression).alias("a key"))
    ranges = plan_ranges(df, "a key", 8)
    wrong, sizes = covered(df, "a key", ranges)
    keyed = [s for r, s in zip(ranges, sizes) if not r.nulls]
    assert wrong == 0 and len(keyed) == 8 and max(keyed) < 1.3 * sum(keyed) / 8


def test_a_hot_key_has_one_range_and_odd_tables_work(spark):
    hot = spark.range(3000).select(F.when(F.col("id") < 2000, F.lit(7)).otherwise(F.col("id")).alias("k"))
    wrong, sizes = covered(hot, "k", plan_ranges(hot, "k", 6))
    assert wrong == 0 and sum(sizes) == 3000 and 2000 <= max(sizes) <= 2600  # the key and the share behind it
    for empty in (hot.limit(0), small_frame(spark, [], "k string"), small_frame(spark, [(None,)] * 3, "k bigint")):
        ranges = plan_ranges(empty, "k", 4)
        assert covered(empty, "k", ranges)[0] == 0
    with pytest.raises(ValueError, match="cannot plan"):
        plan_ranges(spark.range(1).select(F.array("id").alias("k")), "k", 2)


def test_conditions_as_text(spark):
    df = spark.range(1000).select(F.concat(F.lit("o'"), F.col("id")).alias("k"))
    ranges = plan_ranges(df.select(F.when(F.lit(True), F.col("k")).alias("k")), "k", 4)
    assert sum(df.where(p).count() for p in predicates(ranges, "k")) == 1000
    assert predicates(plan_ranges(df.limit(0), "k", 1), "k")[0] == "k IS NOT NULL"


def test_a_stopped_scan_reads_only_what_is_missing(spark, folder):
    read = []
    df = spark.range(900).withColumn("v", F.lit(1))

    def write(rows, path, *measures):
        read.append(path)
        return write_landing(rows, path, *measures)

    first = land_in_ranges(df, "id", f"{folder}/l", f"{folder}/s", 6, write, F.max("id").cast("string"), most=2)
    assert not first["complete"] and first["rows"] < 900 and len(read) == 2
    planned = stored_plan(spark, f"{folder}/s")
    second = land_in_ranges(df, "id", f"{folder}/l", f"{folder}/s", 99, write, F.max("id").cast("string"))
    assert second["complete"] and second["rows"] == 900 and len(read) == len(set(read)) == len(planned)
    assert stored_plan(spark, f"{folder}/s") == planned  # the ranges are those of the first time
    ids = sorted(int(r[0]) for r in read_lines(spark, f"{folder}/l").select(F.get_json_object("value", "$.id")).collect())
    assert ids == list(range(900))


def test_a_run_resumes_after_a_failure(spark, layout):
    spec = DatasetSpec("items", key="k", load_type="incremental", mark_field="ts", scan_ranges=5)
    rows = spark.range(500).select(F.col("id").alias("k"), F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("ts"))
    broken = rows.withColumn("v", F.when(F.col("k") == 420, F.raise_error(F.lit("source broke"))).otherwise(F.lit("x")))
    ctx = RunContext(spark, layout, run_id="r1", at=dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    assert run(ctx, {"items": broken}, [spec]).first()["status"] == "FAILED"
    marked = finished(spark, layout.scan_state("items", "r1")).count()
    assert 0 < marked < 5
    row = run(ctx, {"items": rows.withColumn("v", F.lit("x"))}, [spec]).first()
    assert (row["status"], row["qtd_lida_origem"], row["watermark_final"]) == ("SUCCESS", 500, "1970-01-01T00:08:19")
    assert documents(ctx, spec).count() == 500
