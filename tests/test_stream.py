"""The streaming consumer: each file once, restarts, replays."""

from weirgate.plans import bronze, control
from weirgate.plans.run import RunContext, documents
from weirgate.session import remove, small_frame
from weirgate.spec import DatasetSpec
from weirgate.streaming.landing_stream import consume_landing, files_loaded

SPEC = DatasetSpec("drop", load_type="incremental", mark_field="ts")


def put(spark, layout, *lines):
    frame = small_frame(spark, [(line,) for line in lines], "value string").coalesce(1)
    frame.write.mode("append").text(layout.landing("drop"))


def keys(ctx, spec=SPEC):
    return sorted(r["_source_id"] for r in documents(ctx, spec).select("_source_id").collect())


def test_each_file_once(spark, layout):
    ctx = RunContext(spark, layout)
    put(spark, layout, '{"_id":1}', "{bad")
    assert consume_landing(ctx, SPEC) == 1
    assert consume_landing(ctx, SPEC) == 0
    put(spark, layout, '{"_id":2}')
    assert consume_landing(ctx, SPEC) == 1
    assert keys(ctx) == ["1", "2"]
    assert bronze.read_quarantine(spark, layout.bronze("drop")).count() == 1
    assert files_loaded(bronze.read_bronze(spark, layout.bronze("drop"))).count() == 2
    log = control.run_log(spark, layout)
    assert {(r["ingest_mode"], r["qtd_lida_origem"]) for r in log.collect()} == {("stream", 2), ("stream", 1)}


def test_file_limit_makes_batches(spark, layout):
    ctx = RunContext(spark, layout)
    for n in range(5):
        put(spark, layout, f'{{"_id":{n}}}')
    assert consume_landing(ctx, SPEC, max_files=2) == 3
    assert keys(ctx) == ["0", "1", "2", "3", "4"]


def test_a_batch_replayed_after_a_crash_does_not_double(spark, layout):
    ctx = RunContext(spark, layout)
    put(spark, layout, '{"_id":1}')
    consume_landing(ctx, SPEC)
    put(spark, layout, '{"_id":2}')
    consume_landing(ctx, SPEC)
    # The process died after the batch was written and logged, before it was committed.
    for name in ("1", ".1.crc"):
        remove(spark, f"{layout.checkpoint('drop')}/commits/{name}")
    assert consume_landing(ctx, SPEC) == 1
    assert keys(ctx) == ["1", "2"]
    assert bronze.read_bronze(spark, layout.bronze("drop")).count() == 2
    assert control.run_log(spark, layout).count() == 2


def test_upserting_stream(spark, layout):
    spec = DatasetSpec("drop")
    ctx = RunContext(spark, layout)
    put(spark, layout, '{"_id":1,"v":1}', '{"_id":2,"v":1}')
    consume_landing(ctx, spec)
    put(spark, layout, '{"_id":1,"v":2}', '{"v":3}')
    consume_landing(ctx, spec)
    rows = {r["_source_id"]: r["body_json"] for r in documents(ctx, spec).collect()}
    assert rows == {"1": '{"_id":1,"v":2}', "2": '{"_id":2,"v":1}'}
    assert bronze.read_quarantine(spark, layout.bronze("drop")).count() == 1


def test_bad_lines_never_hide_good_ones(spark, layout):
    ctx = RunContext(spark, layout)
    put(spark, layout, '{"_id":1}', "{bad", "worse", '{"no":"key"}')
    consume_landing(ctx, SPEC)
    assert keys(ctx) == ["1"]
    row = control.run_log(spark, layout).first()
    assert (row["status"], row["qtd_lida_origem"], row["qtd_gravada_destino"], row["qtd_quarentena"]) == ("PARTIAL", 4, 1, 3)
