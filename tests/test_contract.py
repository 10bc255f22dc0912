"""Contracts on small batches."""

import pytest

from weirgate.operators.contract import contract_metrics, contract_summary, contract_violations
from weirgate.session import small_frame
from weirgate.spec import Contract, FieldRule

COMMENTS = Contract("comments", (
    FieldRule("_id", "objectid", required=True), FieldRule("email", "string", required=True),
    FieldRule("text", "string", nullable=True), FieldRule("date", "datetime", required=True),
))
GOOD = '{"_id":"5a9427648b0beebeb69579cc","email":"a@b.c","text":"t","date":"2012-03-26T23:20:16+00:00"}'


def found(spark, bodies, contract=COMMENTS):
    df = small_frame(spark, [(b,) for b in bodies], "body_json string")
    rows = contract_violations(contract_metrics(df, contract), contract).collect()
    return {(r["field"], r["kind"]): (r["hits"], round(r["violation_pct"], 2)) for r in rows}


def test_good_batch(spark):
    assert found(spark, [GOOD] * 20) == {}


def test_missing_required(spark):
    bad = GOOD.replace('"email":"a@b.c",', "")
    assert found(spark, [GOOD] * 18 + [bad] * 2) == {("email", "missing"): (2, 10.0)}


def test_rare_and_optional_gaps_are_tolerated(spark):
    assert found(spark, [GOOD] * 99 + [GOOD.replace('"text":"t",', "")]) == {}
    assert found(spark, [GOOD] * 99 + [GOOD.replace('"email":"a@b.c",', "")]) == {}
    assert found(spark, [GOOD.replace('"text":"t",', "")] * 9) == {}


def test_null_is_not_missing(spark):
    bad = GOOD.replace('"a@b.c"', "null")
    assert found(spark, [bad] * 3) == {("email", "null"): (3, 100.0)}
    assert found(spark, [GOOD.replace('"t"', "null")] * 3) == {}


def test_wrong_type(spark):
    assert found(spark, [GOOD.replace("2012-03-26T23:20:16+00:00", "soon")] * 3) == {("date", "type"): (3, 100.0)}
    assert found(spark, [GOOD.replace("2012-03-26T23:20:16+00:00", "2012-03-26")] * 3) == {}


def test_forbidden_in_one_document(spark):
    rules = Contract("users", (FieldRule("_id", "objectid", required=True),), forbidden=("password",))
    clean, leak = '{"_id":"59b99db4cfa9a34dcd7885b6"}', '{"_id":"59b99db4cfa9a34dcd7885b6","password":null}'
    assert found(spark, [clean] * 999 + [leak], rules) == {("password", "forbidden"): (1, 0.1)}


def test_empty_batch(spark):
    assert found(spark, []) == {("*", "missing"): (0, 0.0)}
    assert found(spark, [], Contract("s", (FieldRule("_id", required=True),), allow_empty=True)) == {}


def test_broken_documents_lack_everything(spark):
    rules = Contract("c", (FieldRule("_id", required=True),))
    assert found(spark, ["{bad", "[1]", '"s"'], rules) == {("_id", "missing"): (3, 100.0)}


@pytest.mark.parametrize("kind, good, bad", [
    ("string", ['"x"', '""'], ["1", "true", "[]", "{}"]),
    ("int", ["1", "-3", "12345678901234567890"], ["1.5", "5.0", "true", '"1"']),
    ("double", ["1.5", "5.0", "1e5"], ["1", '"1.5"', "false"]),
    ("number", ["1", "1.5", "1e5"], ["true", '"1"']),
    ("bool", ["true", "false"], ["0", '"true"']),
    ("datetime", ['"2012-03-26"', '"2012-03-26T23:20:16Z"'], ['"x"', "20120326"]),
    ("objectid", ['"5a9427648b0beebeb69579cc"', '{"$oid":"zz"}'], ['"5a94"', '"5a9427648b0beebeb69579cg"', "{}", "24"]),
    ("array", ["[]", "[1,2]"], ["{}", '"[]"']),
    ("object", ["{}", '{"a":1}'], ["[]", '"{}"']),
])
def test_types(spark, kind, good, bad):
    rules = Contract("c", (FieldRule("f", kind),), max_violation_pct=0.0)
    assert found(spark, [f'{{"f":{v}}}' for v in good], rules) == {}
    assert found(spark, [f'{{"f":{v}}}' for v in bad], rules) == {("f", "type"): (len(bad), 100.0)}


def test_summary(spark):
    df = small_frame(spark, [(GOOD,), (GOOD,)], "body_json string")
    metrics = contract_metrics(df, COMMENTS)
    row = contract_summary(contract_violations(metrics, COMMENTS), metrics).first()
    assert row["contract_ok"] and row["summary"] == "contract ok (2 documents)"


def test_unknown_type_is_refused():
    with pytest.raises(ValueError):
        FieldRule("f", "decimal")
