"""Keyed tables: replace, insert, crash, growth."""

import re
from pathlib import Path

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from weirgate.operators import upsert as module
from weirgate.operators.upsert import drop_stale, merge_into, publish, read_keyed, stage_upsert, upsert
from weirgate.session import path_exists, small_frame

DDL = "k string, v bigint, t bigint"


def newest():
    return [F.col("t").desc(), F.col("v").desc()]


def rows(spark, path):
    return {r["k"]: r["v"] for r in read_keyed(spark, path, DDL).collect()}


def frame(spark, *values):
    return small_frame(spark, values, DDL)


def test_replace_insert_keep(spark, folder):
    upsert(frame(spark, ("a", 1, 1), ("b", 2, 1)), folder, "k", newest())
    upsert(frame(spark, ("b", 3, 2), ("c", 4, 2)), folder, "k", newest())
    assert rows(spark, folder) == {"a": 1, "b": 3, "c": 4}


def test_incoming_wins_over_stored_whatever_its_time(spark, folder):
    upsert(frame(spark, ("a", 1, 9)), folder, "k", newest())
    upsert(frame(spark, ("a", 2, 1)), folder, "k", newest())
    assert rows(spark, folder) == {"a": 2}


def test_newest_of_the_batch_wins(spark, folder):
    upsert(frame(spark, ("a", 1, 1), ("a", 2, 3), ("a", 3, 2), ("a", 9, 3)), folder, "k", newest())
    assert rows(spark, folder) == {"a": 9}


def test_empty_batches(spark, folder):
    upsert(frame(spark), folder, "k", newest())
    assert rows(spark, folder) == {}
    upsert(frame(spark, ("a", 1, 1)), folder, "k", newest())
    upsert(frame(spark), folder, "k", newest())
    assert rows(spark, folder) == {"a": 1}


def test_repeating_an_upsert_changes_nothing(spark, folder):
    batch = frame(spark, ("a", 1, 1), ("b", 2, 1))
    upsert(batch, folder, "k", newest())
    upsert(batch, folder, "k", newest())
    assert rows(spark, folder) == {"a": 1, "b": 2}


def test_an_unpublished_generation_is_invisible_and_replaceable(spark, folder):
    upsert(frame(spark, ("a", 1, 1), ("b", 2, 1)), folder, "k", newest())
    stage_upsert(frame(spark, ("a", 7, 2), ("z", 7, 2)), folder, "k", newest())
    assert rows(spark, folder) == {"a": 1, "b": 2}
    publish(stage_upsert(frame(spark, ("a", 8, 2)), folder, "k", newest()), folder)
    assert rows(spark, folder) == {"a": 8, "b": 2}


def test_buckets_grow_with_the_table(spark, folder):
    base = spark.range(400).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"), F.lit(1).cast("bigint").alias("t"))
    upsert(base.where("v < 100"), folder, "k", newest(), rows_per_bucket=4)
    upsert(base.where("v >= 100"), folder, "k", newest(), rows_per_bucket=4)
    heads = stage_upsert(base.where("v = 7").withColumn("v", F.lit(-7).cast("bigint")), folder, "k", newest(), rows_per_bucket=4)
    assert {r["buckets"] for r in heads.collect()} == {128}
    publish(heads, folder)
    found = rows(spark, folder)
    assert len(found) == 400 and found["7"] == -7 and found["399"] == 399


def test_stale_generations_go(spark, folder):
    upsert(frame(spark, ("a", 1, 1), ("b", 1, 1)), folder, "k", newest())
    upsert(frame(spark, ("a", 2, 2)), folder, "k", newest())
    assert drop_stale(spark, folder) == []
    upsert(frame(spark, ("a", 3, 3), ("b", 3, 3)), folder, "k", newest())
    stage_upsert(frame(spark, ("a", 4, 4)), folder, "k", newest())
    assert drop_stale(spark, folder) == [1, 2]
    assert rows(spark, folder) == {"a": 3, "b": 3}
    assert path_exists(spark, f"{folder}/data/_generation=4")


def test_merge_needs_a_format_that_has_it(spark, folder):
    frame(spark, ("a", 1, 1)).write.format("parquet").option("path", folder).saveAsTable("plain_target")
    try:
        with pytest.raises(UnsupportedOperationException) as refused:
            merge_into(frame(spark, ("a", 2, 2)), "plain_target", "k", newest(), ["k", "v", "t"])
        assert refused.value.getCondition() == "UNSUPPORTED_FEATURE.TABLE_OPERATION"
        assert spark.table("plain_target").first()["v"] == 1
    finally:
        spark.sql("drop table plain_target")


def test_stored_rows_are_shuffled_once(spark, folder, monkeypatch):
    upsert(frame(spark, ("a", 1, 1), ("b", 2, 1)), folder, "k", newest())
    plans = []
    real = module.latest_record

    def spy(df, keys, order):
        result = real(df, keys, order)
        if "_bucket" in keys:
            mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
            plans.append(result._jdf.queryExecution().explainString(mode))
        return result

    monkeypatch.setattr(module, "latest_record", spy)
    upsert(frame(spark, ("b", 3, 2)), folder, "k", newest())
    (text,) = plans
    assert text.count("Exchange hashpartitioning(_bucket") == 1
    after_union = text[: text.index("Union")]
    assert after_union.count("Exchange") == 1


def test_columns_that_a_batch_lacks_stay(spark, folder):
    wide = small_frame(spark, [("a", 1, 1, "x"), ("b", 2, 1, "y")], DDL + ", extra string")
    upsert(wide, folder, "k", newest())
    for at in (2, 3):
        upsert(frame(spark, ("b", at, at), ("c", at, at)), folder, "k", newest())
    found = {r["k"]: (r["v"], r["extra"]) for r in read_keyed(spark, folder, DDL + ", extra string").collect()}
    assert found == {"a": (1, "x"), "b": (3, "y"), "c": (3, None)}


def test_a_row_without_a_key_is_refused(spark, folder):
    upsert(frame(spark, ("a", 1, 1)), folder, "k", newest())
    with pytest.raises(Exception, match="without a key"):
        upsert(frame(spark, ("b", 2, 2), (None, 3, 2)), folder, "k", newest())
    assert rows(spark, folder) == {"a": 1}


def table_of(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"), F.lit(1).cast("bigint").alias("t"))


def test_small_batches_write_in_proportion(spark, folder):
    upsert(table_of(spark, 2000), folder, "k", newest())
    expected = {str(i): i for i in range(2000)}
    written = 0
    for n in range(6):
        batch = table_of(spark, 2000).where(f"v % 97 = {n}").withColumn("v", F.col("v") * 10 + n)
        heads = stage_upsert(batch, folder, "k", newest())
        assert not any(r["whole"] for r in heads.collect())
        written += sum(r["stored_rows"] for r in heads.collect())
        publish(heads, folder)
        expected |= {r["k"]: r["v"] for r in batch.collect()}
        assert rows(spark, folder) == expected
    assert written == sum(1 for i in range(2000) if i % 97 < 6)


def test_a_bucket_is_written_whole_when_its_changes_pass_their_share(spark, folder, monkeypatch):
    upsert(table_of(spark, 400), folder, "k", newest())
    kinds = []
    for n in range(5):
        heads = stage_upsert(table_of(spark, 400).where(f"v % 10 = {n}").withColumn("v", F.lit(n).cast("bigint")), folder, "k", newest())
        kinds.append({r["whole"] for r in heads.collect()})
        publish(heads, folder)
    assert kinds[0] == {False} and True in kinds[2] | kinds[3]
    assert rows(spark, folder) == {str(i): i % 10 if i % 10 < 5 else i for i in range(400)}
    monkeypatch.setattr(module, "MAX_CHANGES", 0)
    heads = stage_upsert(table_of(spark, 1), folder, "k", newest())
    assert {r["whole"] for r in heads.collect()} == {True}


def test_changes_keep_columns_and_refuse_keyless_rows(spark, folder):
    wide = table_of(spark, 400).withColumn("extra", F.concat(F.lit("x"), "k"))
    upsert(wide, folder, "k", newest())
    upsert(wide.where("v = 7").withColumn("extra", F.lit("changed")), folder, "k", newest())
    upsert(table_of(spark, 400).where("v in (7, 8)").withColumn("v", F.lit(-1).cast("bigint")), folder, "k", newest())
    found = {r["k"]: (r["v"], r["extra"]) for r in read_keyed(spark, folder, DDL + ", extra string").collect()}
    assert len(found) == 400 and found["7"] == (-1, "changed") and found["8"] == (-1, "x8") and found["9"] == (9, "x9")
    with pytest.raises(Exception, match="without a key"):
        upsert(frame(spark, (None, 3, 2)), folder, "k", newest())


def test_an_order_decides_between_stored_and_incoming(spark, folder):
    order = [F.col("t").desc(), F.col("v").desc()]
    upsert(table_of(spark, 400).withColumn("t", F.lit(5).cast("bigint")), folder, "k", newest(), order=order)
    upsert(frame(spark, ("1", 100, 4), ("2", 200, 6), ("3", 1, 5), ("4", 9, 5)), folder, "k", newest(), order=order)
    found = {r["k"]: r["v"] for r in read_keyed(spark, folder, DDL, order).collect()}
    assert (found["1"], found["2"], found["3"], found["4"]) == (1, 200, 3, 9)
    upsert(table_of(spark, 400).withColumn("t", F.lit(1).cast("bigint")), folder, "k", newest(), order=order)  # whole again
    assert {r["k"]: r["v"] for r in read_keyed(spark, folder, DDL, order).collect()} == found


def test_reads_open_live_generations_only(spark, folder):
    upsert(table_of(spark, 400), folder, "k", newest())
    upsert(table_of(spark, 400), folder, "k", newest())
    plan = read_keyed(spark, folder, DDL)._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_generation#\d+L = 2", plan)
    break_files(f"{folder}/data/_generation=1")  # nothing opens them
    assert len(rows(spark, folder)) == 400


def break_files(path):
    for file in Path(path.removeprefix("file:")).rglob("*.parquet"):
        file.write_bytes(b"broken")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
