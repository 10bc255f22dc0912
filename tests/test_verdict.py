"""Divergence and status rules, as tables."""

import pytest
from pyspark.sql import functions as F

from weirgate.functions.verdict import divergence_pct, judge
from weirgate.session import small_frame
from weirgate.spec import Limits

DDL = (
    "source_count bigint, written_count bigint, null_key_pct double, duplicate_keys bigint, "
    "contract_ok boolean, threshold_pct double"
)


def verdict(spark, limits=Limits(), **given):
    row = dict(
        source_count=1000, written_count=1000, null_key_pct=0.0, duplicate_keys=0, contract_ok=True, threshold_pct=None
    ) | given
    return judge(small_frame(spark, [tuple(row.values())], DDL), limits).first()


@pytest.mark.parametrize("source, written, expected", [
    (1, 1, 0.0), (1, 0, 100.0), (1, 3, 200.0), (8, 7, 12.5), (7, 8, 100 / 7), (3_000_000_000, 2_999_999_999, 100 / 3e9),
    (4, 0, 100.0), (0, 1, 100.0), (-1, 0, 0.0),
])
def test_divergence(spark, source, written, expected):
    row = spark.range(1).select(divergence_pct(F.lit(source), F.lit(written)).alias("d")).first()
    assert row["d"] == pytest.approx(expected)


@pytest.mark.parametrize("given, status, may_advance", [
    # just within, at and just past the limit of 1 % and the hard limit of 5 %, short and over
    ({"source_count": 10_000, "written_count": 9_901}, "SUCCESS", True),
    ({"source_count": 10_000, "written_count": 9_900}, "SUCCESS", True),
    ({"source_count": 10_000, "written_count": 9_899}, "PARTIAL", False),
    ({"source_count": 10_000, "written_count": 9_500}, "PARTIAL", False),
    ({"source_count": 10_000, "written_count": 9_499}, "FAILED", False),
    ({"source_count": 10_000, "written_count": 10_100}, "SUCCESS", True),
    ({"source_count": 10_000, "written_count": 10_101}, "PARTIAL", True),
    ({"source_count": 10_000, "written_count": 90_000}, "PARTIAL", True),
    # one row, and very many
    ({"source_count": 1, "written_count": 1}, "SUCCESS", True),
    ({"source_count": 1, "written_count": 0}, "FAILED", False),
    ({"source_count": 1, "written_count": 2}, "PARTIAL", True),
    ({"source_count": 7_000_000_000, "written_count": 6_930_000_001}, "SUCCESS", True),
    ({"source_count": 7_000_000_000, "written_count": 6_929_999_999}, "PARTIAL", False),
    # the dataset's own limit, fractions included
    ({"source_count": 800, "written_count": 799, "threshold_pct": 0.125}, "SUCCESS", True),
    ({"source_count": 800, "written_count": 799, "threshold_pct": 0.12}, "PARTIAL", False),
    ({"source_count": 800, "written_count": 768, "threshold_pct": 4.5}, "SUCCESS", True),
    ({"source_count": 800, "written_count": 720, "threshold_pct": 50.0}, "FAILED", False),
    # nothing expected
    ({"source_count": 0, "written_count": 0, "threshold_pct": 0.0}, "SUCCESS", True),
    ({"source_count": 0, "written_count": 1}, "PARTIAL", True),
    # quality
    ({"null_key_pct": 1e-9}, "FAILED", False),
    ({"null_key_pct": None, "duplicate_keys": None, "contract_ok": None}, "SUCCESS", True),
    ({"duplicate_keys": 1}, "PARTIAL", True),
    ({"duplicate_keys": 1, "source_count": 400, "written_count": 399}, "PARTIAL", False),
    ({"contract_ok": False, "source_count": 300, "written_count": 301}, "PARTIAL", True),
])
def test_status(spark, given, status, may_advance):
    row = verdict(spark, **given)
    assert (row["status"], row["may_advance"]) == (status, may_advance)


def test_null_keys_need_not_be_fatal(spark):
    row = verdict(spark, Limits(null_key_is_fatal=False), null_key_pct=0.25)
    assert row["status"] == "PARTIAL" and "null key in 0.25%" in row["message"]


def test_reasons_are_joined(spark):
    row = verdict(spark, written_count=970, duplicate_keys=2, contract_ok=False)
    assert row["message"].split("; ") == [
        "divergence 3.00% > limit 1.00%", "2 duplicated keys in the batch", "data contract broken"
    ]
    assert row["divergencia_pct"] == 3.0


def test_loss_hides_lesser_reasons(spark):
    row = verdict(spark, written_count=800, duplicate_keys=2, null_key_pct=1.0)
    assert row["message"].startswith("null key in 1.00% of the batch; lost rows: wrote 800 of 1000")
    assert "duplicated" not in row["message"]
