"""Steps of the linking operators: their settings, what they compare, and what they leave behind."""

import pytest
from pyspark.sql import functions as F

from weirgate.llm import lines, linking, near
from weirgate.session import path_exists, stepwise


def frame(spark):
    texts = ["some words of a text that comes twice\nand one more line of it", "another text with quite other words in it"] * 2
    return spark.createDataFrame([*enumerate(texts), (4, None), (None, "no id here")], "doc_id long, text string").repartition(2)


KEYS = [
    "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled",
]


@pytest.mark.parametrize("judge", [lines.judged_lines, near.near_duplicates])
def test_steps_broadcast_by_measured_size_and_drop_their_shuffles(spark, monkeypatch, judge):
    seen, write = [], linking.Scratch.kept

    def kept(self, rows, name):
        seen.append([spark.conf.get(k, None) for k in KEYS])
        return write(self, rows, name)

    monkeypatch.setattr(linking.Scratch, "kept", kept)
    before, limit = [spark.conf.get(k, None) for k in KEYS], spark.conf.get(KEYS[0])
    judge(frame(spark)).collect()
    assert seen and all(s == ["-1", limit, "true"] for s in seen)
    assert [spark.conf.get(k, None) for k in KEYS] == before


def test_settings_are_put_back_after_an_error(spark):
    before = [spark.conf.get(k, None) for k in KEYS]
    with pytest.raises(ZeroDivisionError), stepwise(spark):
        1 / 0
    assert [spark.conf.get(k, None) for k in KEYS] == before


def test_exploded_rows_are_not_broadcast(spark):
    """Twenty million bytes, which Spark puts at some hundreds before it has seen them."""
    many = spark.range(10).select(F.explode(F.sequence(F.lit(1), F.lit(100_000))).alias("k"), F.lit("x" * 20).alias("v")).distinct()
    wide = spark.range(200_000).select(F.col("id").alias("k"), F.lit("y" * 80).alias("w"))

    def joined():
        rows = wide.join(many.groupBy("k").agg(F.max("v").alias("v")), "k")
        return rows._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in joined()
    with stepwise(spark):
        assert "BroadcastHashJoin" not in joined()


def test_final_joins_are_not_planned_by_estimates(spark):
    for judged in (lines.judged_lines(frame(spark)), near.near_duplicates(frame(spark))):
        plan = judged._jdf.queryExecution().optimizedPlan().toString()
        assert "strategy=merge" in plan


@pytest.mark.parametrize(
    "judge, read", [(lines.judged_lines, ["components", "lines"]), (near.near_duplicates, ["components", "names", "rows"])]
)
def test_only_what_results_read_is_left(spark, monkeypatch, judge, read):
    written, write = [], linking.Scratch.kept

    def kept(self, rows, name):
        out = write(self, rows, name)
        written.append(self.paths[-1])
        return out

    monkeypatch.setattr(linking.Scratch, "kept", kept)
    found = judge(frame(spark))
    left = sorted((name, path) for name, path in written if path_exists(spark, path))
    assert [name for name, _ in left] == read
    for _, path in left:
        assert not {"bands", "tokens", "sketch", "s1"} & set(spark.read.parquet(path).columns)
    assert found.count() == (7 if judge is lines.judged_lines else 6)


def met(spark, groups):
    """The pairs of ``cross_pairs`` over sets that are all alike, each in a component of its own."""
    members = spark.createDataFrame([(g, i) for i, held in groups.items() for g in held], "grp long, id long")
    sketch = lines.sketched(["the same words in every line"])[0]
    rows = [(i, *map(int, sketch)) for i in groups]
    sketches = spark.createDataFrame(rows, f"id long, {lines._PARTS_DDL}").select("id", linking.sketch_of(lines.ODD))
    level = linking.mixed_groups(members.withColumn("component", F.col("id")))
    return level, lambda some: {tuple(r) for r in linking.cross_pairs(linking.with_homes(some), sketches, lines.PERCENT, lines.NEAR_BITS).collect()}


def test_few_homes_lose_no_pair(spark):
    many = 3 * linking.HOMES
    groups = {1: [*range(many), 1000], 2: [*range(many, 2 * many), 1000], 3: range(many)}
    level, pairs = met(spark, groups)
    assert max(len(r["homes"]) for r in linking.with_homes(level).collect()) <= linking.HOMES
    assert pairs(level) == {(2, 1), (3, 1)}


def test_pivots_are_not_compared_again(spark):
    level, pairs = met(spark, {i: [7, 8] if i < 2 else [7] for i in range(5)})
    pivot = {r["grp"]: r["id"] for r in level.where(F.xxhash64("grp", "id") == F.col("by")).collect()}
    assert set(pivot) == {7, 8}
    rest = set(range(5)) - {pivot[7]}
    assert pairs(linking.not_met(level)) == {(a, b) for a in rest for b in rest if a > b}
