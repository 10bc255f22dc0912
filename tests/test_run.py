"""Whole runs: marks, failures, verdicts, reprocessing."""

import pytest
from pyspark.sql import functions as F

from weirgate.operators.refine import FieldPath
from weirgate.plans import bronze, control
from weirgate.plans.refine_job import assert_unique, build_silver
from weirgate.plans.run import RunContext, documents, reprocess, require_ok, run
from weirgate.session import folder_names, remove, small_frame
from weirgate.spec import Contract, DatasetSpec, FieldRule, Limits

DDL = "_id bigint, ts timestamp_ntz, name string, tags array<string>"
SPEC = DatasetSpec("items", load_type="incremental", mark_field="ts")


def items(spark, first, last, name="n"):
    ids = spark.range(first, last)
    moment = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).cast("timestamp_ntz")
    return ids.select(
        F.col("id").alias("_id"), moment.alias("ts"), F.lit(name).alias("name"),
        F.array(F.lit("a"), F.lit(None), F.lit("b"), F.lit("a")).alias("tags"),
    )


def status(spark, layout):
    rows = control.run_log(spark, layout).orderBy("_ingestion_id").collect()
    return [(r["_ingestion_id"], r["status"], r["qtd_lida_origem"], r["qtd_gravada_destino"]) for r in rows]


def test_incremental_runs(spark, layout):
    for run_id, last in (("r1", 10), ("r2", 10), ("r3", 13), ("r4", 13)):
        run(RunContext(spark, layout, run_id=run_id), {"items": items(spark, 0, last)}, [SPEC])
    assert status(spark, layout) == [
        ("r1", "SUCCESS", 10, 10), ("r2", "SUCCESS", 0, 0), ("r3", "SUCCESS", 3, 3), ("r4", "SUCCESS", 0, 0),
    ]
    current = documents(RunContext(spark, layout), SPEC)
    assert current.count() == 13
    assert_unique(current)


def test_a_crash_after_the_log_does_not_read_the_window_twice(spark, layout):
    run(RunContext(spark, layout, run_id="r1"), {"items": items(spark, 0, 10)}, [SPEC])
    remove(spark, layout.control(control.WATERMARKS))
    run(RunContext(spark, layout, run_id="r2"), {"items": items(spark, 0, 12)}, [SPEC])
    assert status(spark, layout)[-1] == ("r2", "SUCCESS", 2, 2)


def test_a_crash_before_the_log_leaves_no_visible_rows(spark, layout):
    ctx = RunContext(spark, layout, run_id="r1")
    run(ctx, {"items": items(spark, 0, 10)}, [SPEC])
    remove(spark, layout.control(control.RUN_LOG))
    remove(spark, layout.control(control.WATERMARKS))
    assert documents(ctx, SPEC).count() == 0
    run(RunContext(spark, layout, run_id="r2"), {"items": items(spark, 0, 10)}, [SPEC])
    assert documents(ctx, SPEC).count() == 10
    assert bronze.published(bronze.read_bronze(spark, layout.bronze("items")), control.run_log(spark, layout), "items").count() == 10


def test_a_failed_load_is_invisible_and_holds_the_mark(spark, layout):
    broken = items(spark, 0, 10).withColumn("_id", F.when(F.col("_id") < 9, F.col("_id")))
    done = run(RunContext(spark, layout, run_id="r1"), {"items": broken}, [SPEC])
    row = done.first()
    assert (row["status"], row["qtd_quarentena"]) == ("FAILED", 1)
    with pytest.raises(RuntimeError, match="items"):
        require_ok(done)
    assert documents(RunContext(spark, layout), SPEC).count() == 0
    run(RunContext(spark, layout, run_id="r2"), {"items": items(spark, 0, 10)}, [SPEC])
    assert status(spark, layout)[-1] == ("r2", "SUCCESS", 10, 10)
    assert documents(RunContext(spark, layout), SPEC).count() == 10


def test_one_dataset_that_raises_does_not_stop_the_others(spark, layout):
    other = DatasetSpec("other")
    done = run(RunContext(spark, layout, run_id="r1"), {"items": items(spark, 0, 5)}, [other, SPEC])
    found = {r["collection"]: (r["status"], r["mensagem_erro"]) for r in done.collect()}
    assert found["items"] == ("SUCCESS", None)
    assert found["other"][0] == "FAILED" and "KeyError" in found["other"][1]


def test_full_load_upserts_and_counts_duplicates_before_they_go(spark, layout):
    spec = DatasetSpec("items", threshold_pct=50.0)
    twice = items(spark, 0, 10).unionByName(items(spark, 0, 1, "again"))
    first = run(RunContext(spark, layout, run_id="r1", limits=Limits(hard_fail_pct=50.0)), {"items": twice}, [spec]).first()
    assert (first["status"], first["qtd_lida_origem"], first["qtd_gravada_destino"]) == ("PARTIAL", 11, 10)
    assert "1 duplicated keys" in first["mensagem_erro"]
    run(RunContext(spark, layout, run_id="r2"), {"items": items(spark, 5, 12, "new")}, [spec])
    current = documents(RunContext(spark, layout), spec)
    assert current.count() == 12
    assert current.where(F.get_json_object("body_json", "$.name") == "new").count() == 7


def test_a_failed_full_load_leaves_the_table(spark, layout):
    spec = DatasetSpec("items")
    run(RunContext(spark, layout, run_id="r1"), {"items": items(spark, 0, 10)}, [spec])
    broken = items(spark, 0, 10, "bad").withColumn("_id", F.when(F.col("_id") < 9, F.col("_id")))
    run(RunContext(spark, layout, run_id="r2"), {"items": broken}, [spec])
    current = documents(RunContext(spark, layout), spec)
    assert {r["_ingestion_id"] for r in current.select("_ingestion_id").distinct().collect()} == {"r1"}


def test_forced_full_on_an_incremental_dataset_does_not_double(spark, layout):
    run(RunContext(spark, layout, run_id="r1"), {"items": items(spark, 0, 10)}, [SPEC])
    run(RunContext(spark, layout, run_id="r2", force_full=True), {"items": items(spark, 0, 10, "x")}, [SPEC])
    current = documents(RunContext(spark, layout), SPEC)
    assert current.count() == 10 and current.where("_ingestion_id = 'r2'").count() == 10
    assert status(spark, layout)[-1] == ("r2", "SUCCESS", 10, 10)
    run(RunContext(spark, layout, run_id="r3"), {"items": items(spark, 0, 11)}, [SPEC])
    assert status(spark, layout)[-1] == ("r3", "SUCCESS", 1, 1)


def test_inclusive_mark_rereads_equal_marks_without_doubling(spark, layout):
    spec = DatasetSpec("items", load_type="incremental", mark_field="ts", inclusive_mark=True)
    start = items(spark, 0, 5)
    run(RunContext(spark, layout, run_id="r1"), {"items": start}, [spec])
    late = start.where("_id = 4").withColumn("_id", F.lit(99).cast("bigint"))
    run(RunContext(spark, layout, run_id="r2"), {"items": start.unionByName(late)}, [spec])
    assert documents(RunContext(spark, layout), spec).count() == 6


def test_rows_without_a_mark_can_be_followed(spark, layout):
    spec = DatasetSpec("items", load_type="incremental", mark_field="ts", include_null_mark=True)
    run(RunContext(spark, layout, run_id="r1"), {"items": items(spark, 0, 5)}, [spec])
    unmarked = items(spark, 7, 8).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    run(RunContext(spark, layout, run_id="r2"), {"items": items(spark, 0, 5).unionByName(unmarked)}, [spec])
    assert documents(RunContext(spark, layout), spec).count() == 6


def test_contract_and_minimum_make_a_run_partial(spark, layout):
    contract = Contract("items", (FieldRule("name", "int", required=True),), forbidden=("tags",))
    spec = DatasetSpec("items", expected_min=100)
    ctx = RunContext(spark, layout, run_id="r1", contracts={"items": contract})
    row = run(ctx, {"items": items(spark, 0, 10)}, [spec]).first()
    assert (row["status"], row["mensagem_erro"]) == ("PARTIAL", "data contract broken")
    kinds = {(r["field"], r["kind"]) for r in control.violations(spark, layout).collect()}
    assert kinds == {("name", "type"), ("tags", "forbidden"), ("*", "volume")}
    assert control.run_log(spark, layout).first()["contrato_ok"] is False


def test_excluded_fields_never_land(spark, layout):
    spec = DatasetSpec("items", exclude=("tags", "_id"))
    run(RunContext(spark, layout, run_id="r1"), {"items": items(spark, 0, 3)}, [spec])
    body = documents(RunContext(spark, layout), spec).first()["body_json"]
    assert "tags" not in body and '"_id"' in body


def test_reprocess_is_a_rebuild(spark, layout):
    for run_id, last in (("r1", 6), ("r2", 9)):
        run(RunContext(spark, layout, run_id=run_id), {"items": items(spark, 0, last)}, [SPEC])
    before = {(r["_source_id"], r["_source_hash"]) for r in documents(RunContext(spark, layout), SPEC).collect()}
    remove(spark, layout.bronze("items"))
    reprocess(RunContext(spark, layout), SPEC)
    after = {(r["_source_id"], r["_source_hash"]) for r in documents(RunContext(spark, layout), SPEC).collect()}
    assert before == after and len(after) == 9
    run(RunContext(spark, layout, run_id="r3"), {"items": items(spark, 0, 9)}, [SPEC])
    assert status(spark, layout)[-1] == ("r3", "SUCCESS", 0, 0)


def test_silver_tables(spark, layout):
    run(RunContext(spark, layout, run_id="r1"), {"items": items(spark, 0, 4)}, [SPEC])
    fields = [FieldPath("name", "name"), FieldPath("ts", "ts", "timestamp"), FieldPath("deep.er", "none", "int")]
    names = build_silver(documents(RunContext(spark, layout), SPEC), layout, "items", fields, ["tags"])
    assert names == ["items", "items_tags"]
    tags = spark.read.parquet(layout.silver("items_tags"))
    assert {(r["position"], r["value"]) for r in tags.where("_source_id = '2'").collect()} == {(0, "a"), (2, "b")}
    flat = spark.read.parquet(layout.silver("items"))
    assert flat.count() == 4 and flat.where("none is null").count() == 4
    assert_unique(flat)
    with pytest.raises(AssertionError):
        assert_unique(flat.unionByName(flat.limit(1)))


def test_views_carry_the_usual_names(spark, layout):
    run(RunContext(spark, layout, run_id="r1"), {"items": items(spark, 0, 4)}, [SPEC])
    control.register_views(spark, layout)
    row = spark.sql("""
        select collection, sum(qtd_gravada_destino) n, round(100.0 * sum(case when status = 'FAILED' then 1 else 0 end) / count(*), 2) bad
        from control_ingestion_log group by 1""").first()
    assert (row["collection"], row["n"], float(row["bad"])) == ("items", 4, 0.0)
    assert spark.sql("select watermark_field from ingestion_watermark").first()[0] == "ts"


def test_specs_are_checked():
    with pytest.raises(ValueError):
        DatasetSpec("x", load_type="weekly")
    with pytest.raises(ValueError):
        DatasetSpec("x", load_type="incremental")


def test_long_messages_are_cut(spark):
    row = (
        "r", "c", "full", "x" * 5000, "FAILED",
    )
    df = small_frame(spark, [row], "_ingestion_id string, collection string, load_type string, mensagem_erro string, status string")
    timed = df.selectExpr("*", "timestamp'2024-01-01 00:00:00' start_time", "timestamp'2024-01-01 00:00:01.2345' end_time")
    got = control.build_run_log(timed).first()
    assert len(got["mensagem_erro"]) == 4000 and got["duracao_seg"] in (1.234, 1.235)


def test_datasets_in_parallel(spark, layout):
    specs = [DatasetSpec(f"d{n}", load_type="incremental", mark_field="ts") for n in range(4)]
    sources = {s.name: items(spark, 0, 5) for s in specs}
    for run_id in ("r1", "r2"):
        run(RunContext(spark, layout, run_id=run_id), sources, specs, parallel=4)
    assert [n for _, _, n, _ in status(spark, layout)] == [5] * 4 + [0] * 4
    assert control.watermarks(spark, layout).count() == 4


def test_names_must_suit_folders(spark, layout):
    with pytest.raises(ValueError):
        DatasetSpec("a/b")
    with pytest.raises(ValueError):
        RunContext(spark, layout, run_id="../x")


@pytest.mark.parametrize("kind, expression, final", [
    ("timestamp", "timestamp_seconds(1700000000 + _id)", "2023-11-14T22:13:29+00:00"),
    ("date", "date_add(date'2024-01-01', cast(_id as int))", "2024-01-10"),
    ("number", "_id * 10", "90"),
    ("string", "format_string('2015-08-26 00:03:%02d.133000000', _id)", "2015-08-26 00:03:09.133000000"),
])
def test_marks_of_every_type(spark, layout, kind, expression, final):
    spec = DatasetSpec("items", load_type="incremental", mark_field="mark", mark_kind="string" if kind == "string" else "timestamp")
    source = items(spark, 0, 11).selectExpr("_id", f"{expression} mark")
    first = run(RunContext(spark, layout, run_id="r1"), {"items": source.where("_id < 10")}, [spec]).first()
    assert first["watermark_final"] == final
    run(RunContext(spark, layout, run_id="r2"), {"items": source}, [spec])
    assert status(spark, layout)[-1] == ("r2", "SUCCESS", 1, 1)


@pytest.mark.parametrize("spec", [SPEC, DatasetSpec("items")])
def test_reprocess_keeps_the_newest_version(spark, layout, spec):
    run(RunContext(spark, layout, run_id="r1"), {"items": items(spark, 0, 5, "z-first")}, [spec])
    later = items(spark, 0, 5, "a-second").withColumn("ts", F.col("ts") + F.expr("interval 1 day"))
    run(RunContext(spark, layout, run_id="r2"), {"items": later}, [spec])
    reprocess(RunContext(spark, layout), spec)
    current = documents(RunContext(spark, layout), spec)
    assert current.count() == 5
    assert current.where(F.get_json_object("body_json", "$.name") == "a-second").count() == 5


def test_a_run_repeated_under_its_id_changes_nothing(spark, layout):
    ctx = RunContext(spark, layout, run_id="r1")
    first = run(ctx, {"items": items(spark, 0, 10)}, [SPEC]).first()
    again = run(ctx, {"items": items(spark, 0, 12)}, [SPEC]).first()
    assert first["qtd_gravada_destino"] == again["qtd_gravada_destino"] == 10
    assert status(spark, layout) == [("r1", "SUCCESS", 10, 10)]


def test_a_failed_run_can_be_repeated_under_its_id(spark, layout):
    ctx = RunContext(spark, layout, run_id="r1")
    assert run(ctx, {}, [SPEC]).first()["status"] == "FAILED"
    assert run(ctx, {"items": items(spark, 0, 10)}, [SPEC]).first()["status"] == "SUCCESS"
    assert status(spark, layout) == [("r1", "SUCCESS", 10, 10)]
    assert documents(ctx, SPEC).count() == 10


def test_an_empty_full_load_is_judged(spark, layout):
    none = items(spark, 0, 0)
    contract = Contract("strict", (FieldRule("name", "string", required=True),))
    specs = [DatasetSpec("free", allow_empty=True), DatasetSpec("strict"), DatasetSpec("many", allow_empty=True, expected_min=5), SPEC]
    ctx = RunContext(spark, layout, run_id="r1", contracts={"strict": contract, "items": contract})
    done = {r["collection"]: r for r in run(ctx, {s.name: none for s in specs}, specs).collect()}
    assert {k: r["status"] for k, r in done.items()} == {"free": "SUCCESS", "strict": "PARTIAL", "many": "PARTIAL", "items": "SUCCESS"}
    found = {(r["collection"], r["kind"]) for r in control.violations(spark, layout).collect()}
    assert found == {("strict", "missing"), ("many", "volume")}


def test_silver_with_repeated_keys_replaces_nothing(spark, layout):
    run(RunContext(spark, layout, run_id="r1"), {"items": items(spark, 0, 4)}, [SPEC])
    current = documents(RunContext(spark, layout), SPEC)
    build_silver(current, layout, "items", [FieldPath("name", "name")])
    with pytest.raises(AssertionError):
        build_silver(current.unionByName(current.limit(1)), layout, "items", [FieldPath("name", "other")], ["tags"])
    kept = spark.read.parquet(layout.silver("items"))
    assert "name" in kept.columns and kept.count() == 4
    build_silver(current, layout, "items", [FieldPath("name", "other")], ["tags"])
    assert "other" in spark.read.parquet(layout.silver("items")).columns
    assert sorted(folder_names(spark, f"{layout.root}/silver")) == ["items", "items_tags"]
