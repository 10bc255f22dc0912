"""The table of current records, loads that are pruned, and reprocessing in one pass."""

import datetime as dt
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_upsert import break_files
from weirgate.operators.latest import latest_bronze
from weirgate.plans import bronze, control, current
from weirgate.plans.run import RunContext, documents, keep_up, reprocess, run
from weirgate.session import folder_names, remove, small_frame
from weirgate.spec import Contract, DatasetSpec, FieldRule

SPEC = DatasetSpec("items", load_type="incremental", mark_field="seq", mark_kind="string", keep_current=True)
NOON = dt.datetime(2024, 2, 1, 12, tzinfo=dt.timezone.utc)


def load(spark, layout, n, rows, spec=SPEC, at=None):
    ctx = RunContext(spark, layout, run_id=f"r{n:02d}", at=at or NOON + dt.timedelta(hours=n))
    frame = small_frame(spark, [(i, v, f"{n:03d}") for i, v in rows], "_id bigint, v string, seq string")
    return run(ctx, {"items": frame}, [spec]).first()


def found(spark, layout, spec=SPEC):
    rows = documents(RunContext(spark, layout), spec).select("_source_id", F.get_json_object("body_json", "$.v").alias("v")).collect()
    assert len(rows) == len({r[0] for r in rows})
    return {r[0]: r[1] for r in rows}


def window(spark, layout):
    loads = bronze.published_loads(control.run_log(spark, layout), "items")
    rows = latest_bronze(bronze.read_published(spark, layout.bronze("items"), loads))
    return {r[0]: r[1] for r in rows.select("_source_id", F.get_json_object("body_json", "$.v")).collect()}


def test_folded_loads_equal_the_whole_window(spark, layout):
    load(spark, layout, 1, [(i, "a") for i in range(40)])
    load(spark, layout, 2, [(i, "b") for i in range(0, 40, 9)] + [(100, "b")])
    load(spark, layout, 3, [(1, "c"), (100, "c"), (101, "c")])
    assert current.folded_loads(spark, layout, "items").count() == 3
    assert found(spark, layout) == window(spark, layout)
    assert (found(spark, layout)["0"], found(spark, layout)["1"], found(spark, layout)["100"]) == ("b", "c", "c")


def test_a_fold_and_a_read_open_new_loads_only(spark, layout):
    load(spark, layout, 1, [(1, "a"), (2, "a")])
    break_files(f"{layout.bronze('items')}/_load=r01")  # folded: nothing opens it again
    load(spark, layout, 2, [(2, "b")])
    assert found(spark, layout) == {"1": "a", "2": "b"}
    load(spark, layout, 3, [(3, "c"), (1, "c")], replace(SPEC, keep_current=False))  # not folded yet
    assert found(spark, layout) == {"1": "c", "2": "b", "3": "c"}
    assert current.fold_current(spark, layout, SPEC, control.run_log(spark, layout)) == 1
    assert found(spark, layout) == {"1": "c", "2": "b", "3": "c"}


def test_time_decides_not_the_order_of_folding(spark, layout):
    load(spark, layout, 1, [(1, "late")], at=NOON + dt.timedelta(days=9))
    load(spark, layout, 2, [(1, "early"), (2, "early")], at=NOON)
    assert found(spark, layout) == {"1": "late", "2": "early"} == window(spark, layout)


def test_a_fold_repeated_after_a_crash_changes_nothing(spark, layout):
    load(spark, layout, 1, [(1, "a"), (2, "a")])
    load(spark, layout, 2, [(2, "b")])
    remove(spark, f"{layout.current('items')}/folded")  # the process died before it was noted
    keep_up(RunContext(spark, layout), SPEC)
    assert found(spark, layout) == {"1": "a", "2": "b"}


def test_failed_loads_are_neither_folded_nor_opened(spark, layout):
    load(spark, layout, 1, [(1, "a")])
    row = load(spark, layout, 2, [(None, "x"), (9, "x")])
    assert row["status"] == "FAILED"
    break_files(f"{layout.bronze('items')}/_load=r02")
    assert found(spark, layout) == {"1": "a"}
    remove(spark, layout.current("items"))  # without the table the history is read, pruned by load as well
    assert found(spark, layout) == {"1": "a"}
    plan = documents(RunContext(spark, layout), SPEC)._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_load#\d+ = r01", plan)


def jobs_of(spark, work):
    group = f"count-{dt.datetime.now().timestamp()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), result


@pytest.mark.parametrize("spec", [SPEC, DatasetSpec("items")], ids=["appended", "upserted"])
def test_reprocess_takes_as_many_jobs_whatever_the_runs(spark, folder, spec):
    counts = []
    for runs in (3, 12):
        layout = replace_root(folder, runs)
        spread = small_frame(spark, [(f"run-{n:02d}", f'{{"_id":{i},"v":"{n}"}}') for n in range(runs) for i in range(n, n + 4)], "run_id string, value string")
        spread.write.partitionBy("run_id").text(layout.landing("items"))
        ctx = RunContext(spark, layout, run_id="again", at=NOON)
        number, rows = jobs_of(spark, lambda: reprocess(ctx, spec))  # noqa: B023
        counts.append(number)
        assert [(r["_ingestion_id"], r["status"], r["qtd_lida_origem"], r["qtd_gravada_destino"]) for r in rows] == [
            (f"run-{n:02d}", "SUCCESS", 4, 4) for n in range(runs)
        ]
        assert found(spark, layout, spec) == {str(i): str(min(i, runs - 1)) for i in range(runs + 3)}
    assert abs(counts[0] - counts[1]) <= 3 and counts[1] < 80


def replace_root(folder, n):
    from weirgate.spec import Layout

    return Layout(f"{folder}/{n}")


def test_reprocess_judges_each_run(spark, layout):
    lines = [("a", '{"_id":1}'), ("a", '{"_id":1}'), ("b", "{bad"), ("b", '{"_id":2}'), ("c", '{"_id":"x","need":1}'), ("d", "  ")]
    small_frame(spark, lines, "run_id string, value string").write.partitionBy("run_id").text(layout.landing("items"))
    contract = Contract("items", (FieldRule("need", "int", required=True),))
    ctx = RunContext(spark, layout, run_id="again", at=NOON, contracts={"items": contract})
    rows = {r["_ingestion_id"]: r for r in reprocess(ctx, SPEC)}
    assert {k: (r["status"], r["qtd_quarentena"], r["qtd_duplicada_lote"], r["contrato_ok"]) for k, r in rows.items()} == {
        "a": ("PARTIAL", 0, 1, False), "b": ("FAILED", 1, 0, False), "c": ("SUCCESS", 0, 0, True), "d": ("SUCCESS", 0, 0, True)
    }
    assert found(spark, layout) == {"1": None, "x": None}
    assert {r["_ingestion_id"] for r in control.violations(spark, layout).collect()} == {"a", "b"}
    again = RunContext(spark, layout, run_id="later", at=NOON + dt.timedelta(days=3), contracts={"items": contract})
    reprocess(again, SPEC)  # known runs keep their time, so no second copy appears under another day
    assert bronze.read_bronze(spark, layout.bronze("items")).count() == 4
    assert len([n for n in folder_names(spark, f"{layout.bronze('items')}/_load=a/_quarantined=false") if n[0] == "_"]) == 1
