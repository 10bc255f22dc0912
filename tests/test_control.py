"""Control tables: folding many appends into snapshots."""

import pytest

from weirgate.plans import control
from weirgate.session import finished_folders, folder_names, small_frame

DDL = "k string, v bigint"


def put(spark, layout, name, *values, table="t"):
    control.append(small_frame(spark, [(name, v) for v in values], DDL), layout, table, name)


def rows(spark, layout):
    return sorted((r["k"], r["v"]) for r in control.read(spark, layout, "t", DDL).collect())


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(control, "FOLD_AFTER", 4)


def test_a_read_opens_a_bounded_number_of_files(spark, layout, few):
    expected = []
    for n in range(17):
        put(spark, layout, f"r{n}", n)
        expected.append((f"r{n}", n))
    assert rows(spark, layout) == sorted(expected)
    assert len(control.read(spark, layout, "t", DDL).inputFiles()) <= 2 * 4 + 2
    assert len(folder_names(spark, layout.control("folded/t"))) <= 3
    assert len(finished_folders(spark, layout.control("t"))) <= 2 * 4 + 2


def test_repeated_appends_replace_folded_ones(spark, layout, few):
    for n in range(6):
        put(spark, layout, f"r{n}", n)
    put(spark, layout, "r1", 100, 101)
    put(spark, layout, "r5", 500)
    want = [("r0", 0), ("r1", 100), ("r1", 101), ("r2", 2), ("r3", 3), ("r4", 4), ("r5", 500)]
    assert rows(spark, layout) == want
    control.fold(spark, layout, "t", DDL)
    control.fold(spark, layout, "t", DDL)
    assert rows(spark, layout) == want


def test_appends_between_the_reads_of_a_fold_are_kept(spark, layout, monkeypatch):
    for n in range(3):
        put(spark, layout, f"r{n}", n)
    real = control._named_rows

    def meanwhile(*args):
        put(spark, layout, "late", 9)
        return real(*args)

    monkeypatch.setattr(control, "_named_rows", meanwhile)
    control.fold(spark, layout, "t", DDL)
    monkeypatch.setattr(control, "_named_rows", real)
    assert rows(spark, layout) == [("late", 9), ("r0", 0), ("r1", 1), ("r2", 2)]
    control.fold(spark, layout, "t", DDL)
    assert rows(spark, layout) == [("late", 9), ("r0", 0), ("r1", 1), ("r2", 2)]


def test_a_snapshot_that_broke_off_is_passed_over(spark, layout):
    put(spark, layout, "a", 1)
    control.fold(spark, layout, "t", DDL)
    small_frame(spark, [("a", 0)], "name string, at bigint").write.parquet(layout.control("folded/t/00000002/names"))
    put(spark, layout, "b", 2)
    assert rows(spark, layout) == [("a", 1), ("b", 2)]
    control.fold(spark, layout, "t", DDL)
    assert rows(spark, layout) == [("a", 1), ("b", 2)]
