"""Groups of near copies: what is compared, sifted and moved."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from weirgate.llm import lines, linking, near
from weirgate.llm import text as tx


def sketches_of(spark, shapes):
    rows = [(i, *map(int, parts)) for i, parts in enumerate(lines.sketched(shapes))]
    return spark.createDataFrame(rows, f"id long, {lines._PARTS_DDL}").select("id", linking.sketch_of(lines.ODD))


def test_distinct_and_windows():
    rng = np.random.default_rng(5)
    for size in (0, 1, 2, 7, 300):
        values = rng.integers(0, 2**64, size, np.uint64)
        few = values % np.uint64(5)
        assert np.array_equal(tx.distinct(few), np.unique(few))
        for width in (1, 3, 5, 10, 13):
            wanted = []
            for at in range(size - width + 1):
                total = 0
                for value in values[at : at + width].tolist():
                    total = (total * int(tx.FACTOR) + value) % 2**64
                wanted.append(total)
            assert np.array_equal(tx.window_hashes(values, width), tx.mix(np.array(wanted, np.uint64)))


def test_lines_that_share_a_passage_are_told_apart(spark):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(250))
    shapes = [lines.form(passage + "".join(rng.choice("abcdefgh ") for _ in range(200))) for _ in range(60)]
    sketches = sketches_of(spark, shapes)
    left = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("lsketch"))
    right = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("rsketch"))
    pairs = left.join(right, F.col("a") > F.col("b"))
    likely = linking.likely(sketches, "l", "r", lines.PERCENT, lines.NEAR_BITS)
    assert pairs.count() == 60 * 59 // 2 and pairs.where(likely).count() < 100


def test_members_of_a_large_group_meet_a_few_pivots(spark):
    shapes = ["the same words in every line of this group"] * 100
    members = spark.range(100).select(F.lit(1).cast("long").alias("grp"), "id", F.expr("if(id < 60, 0, id)").alias("component"))
    level = linking.mixed_groups(members)
    assert {r["outside"] for r in level.select("outside").collect()} == {40}
    pairs = linking.more_star_pairs(level, sketches_of(spark, shapes), lines.PERCENT, lines.NEAR_BITS).collect()
    assert {r["a"] for r in pairs} == set(range(60, 100)) and all(r["b"] < 60 for r in pairs)
    assert len(pairs) == len(set(pairs)) <= 40 * linking.PIVOTS and len({r["b"] for r in pairs}) > 1


def test_only_sets_of_pairs_are_moved(spark):
    sets = tx.word_shingles(pa.array([f"one two three four five six seven eight n{i // 2}" for i in range(200)]), near.WIDTH)
    payloads = spark.createDataFrame([(i, s.tobytes()) for i, s in enumerate(sets)] + [(None, b"")], "id long, payload binary")
    pairs = spark.createDataFrame([(2 * i + 1, 2 * i) for i in range(5)] + [(3, 0)], "a long, b long")
    kept = payloads.where("id IS NOT NULL").mapInArrow(linking.through(linking.sieve(linking.ends_of(pairs), "id")), payloads.schema)
    assert kept.count() == 10
    found = linking.verified(pairs, payloads, near.shingle_set, 75).collect()
    assert {tuple(r) for r in found} == {(2 * i + 1, 2 * i) for i in range(5)}


def test_sketches_are_of_distinct_lines(spark):
    texts = ["one line of some words\nanother line of words"] * 4 + ["one line of some words", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    names = [lines.name(s) for s in ("one line of some words", "another line of words")]
    found = lines.payloads(docs, spark.createDataFrame([(n,) for n in names], "id long")).collect()
    assert sorted(r["id"] for r in found) == sorted(names)
    for row in found:
        assert row["n"] == len(lines.shingle_set(bytes(row["payload"])))
        assert [row[p] for p in lines.PARTS] == lines.sketched([bytes(row["payload"]).decode()])[0].tolist()
