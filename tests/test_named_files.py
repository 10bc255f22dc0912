"""Single files and files per document under given names."""

import pytest
from pyspark.sql import functions as F

from weirgate.plans.snapshots import export_named_documents, write_named_file
from weirgate.session import folder_names, small_frame


def names(spark, folder):
    return sorted(n for n in folder_names(spark, folder) if not n.startswith("."))


def test_one_file_by_name_replaces_itself(spark, folder):
    for n in (3, 5):
        write_named_file(spark.range(n), f"{folder}/out/data.parquet")
        assert spark.read.parquet(f"{folder}/out/data.parquet").count() == n
    write_named_file(spark.range(0), f"{folder}/out/none.json", "json")
    assert names(spark, f"{folder}/out") == ["data.parquet", "none.json"]


def test_a_failed_task_leaves_no_file(spark, folder):
    write_named_file(spark.range(2), f"{folder}/keep.parquet")
    broken = spark.range(9).withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("broke"))).otherwise(F.lit("x")))
    with pytest.raises(Exception, match="broke"):
        write_named_file(broken, f"{folder}/new.parquet")
    with pytest.raises(Exception, match="broke"):
        export_named_documents(broken, f"{folder}/docs", "id", 9)
    assert "new.parquet" not in names(spark, folder) and names(spark, f"{folder}/docs") == []
    assert spark.read.parquet(f"{folder}/keep.parquet").count() == 2


def test_documents_by_key(spark, folder):
    docs = small_frame(spark, [("b", 2), ("a", 1), (None, 3), ("c", None), ("d", 4)], "k string, v bigint")
    assert export_named_documents(docs, folder, "k", 3) == ["a.json", "b.json", "c.json"]
    assert [r[0] for r in spark.read.text(f"{folder}/c.json").collect()] == ['{"k":"c","v":null}']
    assert names(spark, folder) == ["a.json", "b.json", "c.json"]
    with pytest.raises(ValueError, match="between"):
        export_named_documents(docs, folder, "k", 0)
