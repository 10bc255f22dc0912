"""Operators against brute force, under skew, and the plans they give."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from weirgate.functions.columns import canonical_text
from weirgate.operators.latest import dedup_report, deduplicate, latest_bronze, latest_record, total_order
from weirgate.operators.profile import schema_drift
from weirgate.operators.quality import batch_metrics, reconcile
from weirgate.operators.references import enrich, hot_keys, orphan_keys
from weirgate.operators.refine import FieldPath, expand, explode_array, flatten, infer_schema
from weirgate.plans.snapshots import append_manifest, consolidate, export_by_day, export_documents, read_manifest, snapshot_tables
from weirgate.session import small_frame
from weirgate.sources.files import BY_YEAR_MONTH_DAY, day_folders, read_day_folders, read_days
from weirgate.sources.scans import read_external, scan_incremental
from weirgate.spec import DatasetSpec


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))


def skewed(spark, rows=3000):
    """A third of all rows share one key, a tenth have none."""
    rng = random.Random(7)
    values = []
    for n in range(rows):
        roll = rng.random()
        key = 1 if roll < 0.34 else None if roll < 0.44 else rng.randrange(200)
        values.append((n, key, rng.randrange(5)))
    return values, small_frame(spark, values, "n bigint, k bigint, v bigint").repartition(6)


def test_latest_record_is_the_greatest_and_ignores_file_order(spark):
    values, df = skewed(spark)
    expected = {}
    for n, k, v in values:
        expected[k] = max(expected.get(k, (-1, -1)), (v, n))
    for shuffled in (df, df.orderBy(F.rand(3))):
        got = latest_record(shuffled, ["k"], [F.col("v").desc(), F.col("n").desc()])
        assert {r["k"]: (r["v"], r["n"]) for r in got.collect()} == expected


def test_latest_record_prunes_before_the_shuffle(spark):
    _, df = skewed(spark)
    text = plan(latest_record(df, ["k"], [F.col("n").desc()]))
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning(k") < text.rindex("WindowGroupLimit")


def test_latest_bronze_takes_time_then_hash(spark):
    rows = [("a", 1, "h1", "f"), ("a", 2, "h0", "f"), ("a", 2, "h9", "f"), ("b", 1, "h", "f2")]
    df = small_frame(spark, rows, "_source_id string, _ingestion_timestamp int, _source_hash string, _source_file string")
    assert {(r[0], r[2]) for r in latest_bronze(df).collect()} == {("a", "h9"), ("b", "h")}


def test_deduplicate_without_a_key_uses_business_columns(spark):
    df = small_frame(spark, [(1, "x", "1"), (1, "x", "2"), (2, "x", "1")], "a int, b string, _ingested_at string")
    assert {tuple(r) for r in deduplicate(df).collect()} == {(1, "x", "2"), (2, "x", "1")}
    assert deduplicate(df.select("a", "b")).count() == 2


def test_total_order_settles_ties(spark):
    df = small_frame(spark, [(1, 1, 1), (1, 1, 2)], "k int, t int, z int")
    assert latest_record(df, ["k"], total_order(df, ["k"], ["t"])).first()["z"] == 2


def test_dedup_report(spark):
    values, df = skewed(spark)
    row = dedup_report(df, ["k"]).first()
    keys = {k for _, k, _ in values}
    assert tuple(row) == (len(values), len(keys), len(values) - len(keys))


def test_batch_metrics_under_skew(spark):
    values, df = skewed(spark)
    counts = {}
    for _, k, _ in values:
        counts[k] = counts.get(k, 0) + 1
    row = batch_metrics(df, ["k"]).first()
    nulls = counts.pop(None)
    assert (row["rows"], row["null_keys"], row["duplicate_keys"]) == (len(values), nulls, sum(c > 1 for c in counts.values()))
    assert row["null_key_pct"] == pytest.approx(100.0 * nulls / len(values))
    empty = batch_metrics(df.where("n < 0"), ["k"]).first()
    assert (empty["rows"], empty["null_keys"], empty["duplicate_keys"], empty["null_key_pct"]) == (0, 0, 0, 0.0)


def test_reconcile_without_groups(spark):
    source = spark.range(100)
    row = reconcile(source, source.where("id < 98"), ["id"]).first()
    assert (row["source_count"], row["written_count"], row["status"]) == (100, 98, "PARTIAL")


@pytest.mark.parametrize("fan_out", [1, 5, 64])
def test_enrich_equals_a_left_join_under_skew(spark, fan_out):
    values, df = skewed(spark)
    parent = small_frame(spark, [(k, f"p{k}") for k in range(0, 200, 3)] + [(1, "hot")], "id bigint, name string")
    names = {r["id"]: r["name"] for r in parent.collect()}
    got = enrich(df, "k", parent, "id", fan_out).select("n", "k", "name").collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == [(n, k, names.get(k)) for n, k, _ in values]


def test_identical_copies_are_spread_too(spark):
    copies = spark.range(0, 1000, 1, 8).select(F.lit(5).cast("bigint").alias("k"), F.lit("same").alias("t"))
    parent = small_frame(spark, [(5, "p")], "id bigint, name string")
    assert enrich(copies, "k", parent, "id", 4).where("name = 'p'").count() == 1000


def test_hot_keys_are_few(spark):
    _, df = skewed(spark)
    assert [r["k"] for r in hot_keys(df, "k", 0.1).collect()] == [1]


def test_orphans(spark):
    values, df = skewed(spark)
    parent = small_frame(spark, [(k,) for k in range(100)] * 2, "id bigint")
    expected = {}
    for _, k, _ in values:
        if k is not None and k >= 100:
            expected[k] = expected.get(k, 0) + 1
    assert {r["k"]: r["child_rows"] for r in orphan_keys(df, "k", parent, "id").collect()} == expected


def test_explode_both_ways_agree(spark):
    rng = random.Random(3)
    rows = [(n, [rng.choice(["a", "b", "c", None, ""]) for _ in range(rng.randrange(7))] or None) for n in range(200)]
    df = small_frame(spark, rows, "k int, tags array<string>")
    in_row = explode_array(df, ["k"], F.col("tags"))
    across = explode_array(df, ["k"], F.col("tags"), one_row_per_key=False)
    expected = set()
    for k, tags in rows:
        for value in set(tags or []) - {None}:
            expected.add((k, tags.index(value), value))
    assert {tuple(r) for r in in_row.collect()} == {tuple(r) for r in across.collect()} == expected
    assert "Exchange" not in plan(in_row)


def test_flatten_survives_dirt(spark):
    fields = [
        FieldPath("year", "year", "int"), FieldPath("imdb.rating", "rating", "double"), FieldPath("imdb", "imdb"),
        FieldPath("tags[0]", "first_tag"), FieldPath("on", "on_date", "timestamp"),
    ]
    bodies = [
        '{"year":"1981è","imdb":{"rating":"7.5*"},"tags":["x"],"on":"2012-03-26"}', '{"imdb":"n/a","year":null}', "{bad", "{}",
    ]
    df = small_frame(spark, [(n, b) for n, b in enumerate(bodies)], "n int, body_json string")
    rows = {r["n"]: r for r in flatten(df, fields, keep=["n"]).collect()}
    assert (rows[0]["year"], rows[0]["rating"], rows[0]["first_tag"]) == (1981, 7.5, "x")
    assert rows[0]["imdb"] == '{"rating":"7.5*"}' and rows[0]["on_date"] == dt.datetime(2012, 3, 26)
    assert rows[1]["rating"] is None and rows[1]["imdb"] == "n/a"
    assert all(v is None for n in (2, 3) for k, v in rows[n].asDict().items() if k != "n")


def test_inference_sees_all_rows(spark):
    df = small_frame(spark, [(1, '{"a":1}'), (2, '{"a":2.5,"b":{"c":[1]}}'), (3, "{bad")], "n int, body string")
    assert infer_schema(df).first()[0].startswith("OBJECT<a: DECIMAL")
    wide = expand(df, ["n"])
    assert wide.columns == ["n", "a", "b"]
    assert float(wide.where("n = 2").first()["a"]) == 2.5


def test_drift_counts_documents_not_keys(spark):
    df = small_frame(spark, [('{"a":1,"a":2}',), ('{"a":1,"b":2}',), ("{bad",), ("{}",)], "body string")
    assert {r["field"]: (r["occurrences"], r["pct_docs"]) for r in schema_drift(df).collect()} == {
        "a": (2, 50.0), "b": (1, 25.0),
    }


def test_scan_reaches_the_source(spark, folder):
    spark.range(10).selectExpr("id", "timestamp_ntz'2024-01-01' + make_dt_interval(id) ts", "'x' wide").write.parquet(folder)
    spec = DatasetSpec("d", key="id", load_type="incremental", mark_field="ts", exclude=("wide",))
    df = scan_incremental(read_external(spark, "parquet", {"path": folder}), spec, "2024-01-05T00:00:00Z")
    text = plan(df)
    assert "PushedFilters: [GreaterThan(ts,2024-01-05T00:00), IsNotNull(ts)]" in text
    assert "wide" not in text and df.count() == 5


def test_day_partitions(spark, folder):
    df = spark.range(40).selectExpr("id", "date'2024-01-01' + cast(id div 4 as int) day")
    export_by_day(df, folder, F.col("day"))
    ranged = read_days(spark, folder, "2024-01-03", "2024-01-04")
    assert ranged.count() == 8 and "PartitionFilters: [isnotnull(dt" in plan(ranged)
    export_by_day(df.where("id < 4"), f"{folder}-one", F.col("day"), single_file_rows=100)
    assert len(spark.read.parquet(f"{folder}-one").inputFiles()) == 1


def test_day_folders_of_the_older_layout(spark, folder):
    spark.range(3).write.parquet(f"{folder}/2024/2024-01/2024-01-31")
    spark.range(4).withColumn("extra", F.lit(1)).write.parquet(f"{folder}/2024/2024-02/2024-02-02")
    found = day_folders(spark, folder, dt.date(2024, 1, 30), dt.date(2024, 2, 3), BY_YEAR_MONTH_DAY)
    df = read_day_folders(spark, folder, found)
    assert len(found) == 2 and df.count() == 7 and df.columns == ["id", "extra"]
    assert day_folders(spark, folder, dt.date(2023, 1, 1), dt.date(2023, 1, 2), BY_YEAR_MONTH_DAY) == []


def test_consolidation_of_the_nested_layout(spark, folder):
    spark.sql("select * from values (1, 'a', '1'), (2, 'b', '1') t(`the id`, v, _ingested_at)").write.parquet(f"{folder}/t/2024/2024-01/2024-01-31")
    spark.sql("select * from values (1, 'c', '2') t(`the id`, v, _ingested_at)").write.parquet(f"{folder}/t/2024/2024-02/2024-02-01")
    done = consolidate(
        spark, {"t": f"{folder}/t", "none": f"{folder}/none"}, dt.date(2024, 1, 31), dt.date(2024, 2, 1),
        f"{folder}/out", {"t": ["the_id"]}, BY_YEAR_MONTH_DAY,
    )
    rows = {r["table_name"]: (r["status"], r["linhas_lidas"], r["linhas_bronze"]) for r in done.collect()}
    assert rows == {"t": ("OK", 3, 2), "none": ("SKIP", 0, 0)}
    assert {(r["the_id"], r["v"]) for r in spark.read.parquet(f"{folder}/out/t").collect()} == {(1, "c"), (2, "b")}


def test_snapshot_manifest_keeps_errors(spark, folder, noon):
    broken = spark.range(3).select(F.raise_error(F.lit("no access")).cast("int").alias("x"))
    manifest = snapshot_tables(spark, {"bad": broken, "good": spark.range(5)}, f"{folder}/t", "r1", noon)
    append_manifest(manifest, f"{folder}/m")
    append_manifest(manifest.withColumn("note", F.lit("later")), f"{folder}/m")
    rows = read_manifest(spark, f"{folder}/m")
    assert "note" in rows.columns and rows.count() == 4
    found = {r["source_table"]: (r["status"], r["row_count"]) for r in rows.where("note is null").collect()}
    assert found == {"good": ("OK", 5), "bad": ("ERRO", None)}


def test_documents_as_files(spark, folder):
    export_documents(spark.range(50), folder, 5)
    files = spark.read.json(folder)
    assert files.count() == 5 and len(files.inputFiles()) == 5


def test_nested_text_keeps_microseconds(spark):
    df = spark.sql("select named_struct('t', timestamp_ntz'2024-01-01 00:00:00.000001', 'n', cast(null as int)) s")
    assert canonical_text(df).first()[0] == '{"t":"2024-01-01T00:00:00.000001","n":null}'


def test_expand_copes_with_bodies_that_are_no_objects(spark):
    df = small_frame(spark, [(1, '{"a":1,"VOIDED_AT":"now","n":null}'), (2, "[1]"), (3, "{"), (4, None), (5, '[{"a":7}]')], "n_row int, body string")
    found = {r["n_row"]: r for r in expand(df, ["n_row"], rest="aside").collect()}
    assert (found[1]["a"], found[1]["VOIDED_AT"], found[1]["n"], found[1]["aside"]) == (1, "now", None, None)
    assert [(found[n]["a"], found[n]["aside"]) for n in (2, 3, 4, 5)] == [(None, "[1]"), (None, "{"), (None, None), (None, '[{"a":7}]')]


def test_reconcile_takes_null_as_a_group(spark):
    source = small_frame(spark, [(1, None), (2, None), (3, "b")], "id int, month string")
    found = {r["month"]: (r["source_count"], r["written_count"], r["status"]) for r in reconcile(source, source, ["id"], ["month"]).collect()}
    assert found == {None: (2, 2, "SUCCESS"), "b": (1, 1, "SUCCESS")}
