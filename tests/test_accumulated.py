"""The accumulated check of a run: sketches first, a recount where they disagree."""

import datetime as dt

from pyspark.sql import functions as F

from weirgate.plans import accumulated, bronze
from weirgate.plans.run import RunContext, check_accumulated, run
from weirgate.session import remove, small_frame
from weirgate.spec import DatasetSpec

APPENDED = DatasetSpec("items", load_type="incremental", mark_field="seq", mark_kind="string")
UPSERTED = DatasetSpec("things")


def go(spark, layout, n, spec, rows):
    ctx = RunContext(spark, layout, run_id=f"r{n}", at=dt.datetime(2024, 2, n, tzinfo=dt.timezone.utc), accumulate=True)
    frame = small_frame(spark, [(i, f"{n:03d}") for i in rows], "_id bigint, seq string")
    run(ctx, {spec.name: frame}, [spec])
    found = accumulated.checks(spark, layout).where(f"_ingestion_id = 'r{n}' and collection = '{spec.name}'").first()
    return found["soma_control_log"], found["linhas_bronze"], found["recounted"], found["accumulated_ok"], found["estimated_keys"]


def test_an_appended_dataset(spark, layout):
    assert go(spark, layout, 1, APPENDED, range(50))[:4] == (50, 50, False, True)
    assert go(spark, layout, 2, APPENDED, range(30, 80)) == (100, 100, False, True, 80)
    go(spark, layout, 3, APPENDED, [None, 5])  # failed, counts for nothing
    remove(spark, f"{layout.bronze('items')}/_load=r1")
    lost = check_accumulated(RunContext(spark, layout, run_id="later", accumulate=True), APPENDED)
    assert (lost["delta"], lost["recounted"], lost["accumulated_ok"]) == (-50, True, False)


def test_an_upserted_dataset_is_counted_again_only_when_its_sketch_disagrees(spark, layout):
    assert go(spark, layout, 1, UPSERTED, range(500))[:4] == (500, 500, False, True)
    total, held, recounted, ok, keys = go(spark, layout, 2, UPSERTED, range(400, 700))
    assert (total, held, recounted, ok) == (800, 700, False, True) and abs(keys - 700) <= 700 * accumulated.TOLERANCE
    remove(spark, layout.control(accumulated.LOAD_KEYS))  # without sketches the keys are unknown
    again = check_accumulated(RunContext(spark, layout, run_id="later"), UPSERTED)
    assert (again["recounted"], again["accumulated_ok"]) == (True, True)


def test_sketches_stay_within_their_tolerance(spark):
    rows = spark.range(300_000).select((F.col("id") % 90_000).cast("string").alias("_source_id"), (F.col("id") % 7).alias("load"))
    sketches = rows.groupBy("load").agg(*accumulated.measures())
    merged = sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("_keys")).alias("keys"), F.sum("_good_rows").alias("n")).first()
    assert merged["n"] == 300_000 and abs(merged["keys"] - 90_000) <= 90_000 * accumulated.TOLERANCE


def test_measures_of_an_empty_load(spark, folder, noon):
    none = bronze.shape(bronze.parse_lines(small_frame(spark, [], "value string, _source_file string")), "r1", noon, "t", "full")
    seen = bronze.append_load(none, folder, "r1", None, *accumulated.measures())
    assert seen["_good_rows"] == 0
