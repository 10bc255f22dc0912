"""Column functions on literal inputs."""

import datetime as dt
import json
import random
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate.functions.columns import canonical_text, clean_names, is_blank_list
from weirgate.functions.json_cut import cut_members
from weirgate.functions.json_values import (
    body_without, dirty_number, document, path_text, source_key, text_array, tolerant_timestamp,
)
from weirgate.functions.marks import later, mark_text, newer_than, parse_mark
from weirgate.session import small_frame


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, kind, expected", [
    ("1981è", "int", 1981), (" 42 ", "int", 42), ("x", "int", None), ("a-5.b", "int", -5), ("1,234", "int", 1),
    ("1e5", "int", 1), ("12.5", "int", 12), ("9999999999", "int", None), ("9999999999", "bigint", 9999999999),
    ("12.5", "double", 12.5), ("a-5.b", "double", -5.0), ("", "double", None), ("8.", "double", 8.0),
])
def test_dirty_number(spark, text, kind, expected):
    assert one(spark, dirty_number(F.lit(text), kind)) == expected


@pytest.mark.parametrize("text, ok", [
    ("2012-03-26T23:20:16+00:00", True), ("2012-03-26", True), ("2015-08-26 00:03:50.133000000", True), ("x", False),
])
def test_tolerant_timestamp(spark, text, ok):
    assert (one(spark, tolerant_timestamp(F.lit(text))) is not None) == ok


@pytest.mark.parametrize("text, expected", [
    ('["a",null,"a"]', ["a", None, "a"]), ('"s"', None), ('[1,{"q":2}]', ["1", '{"q":2}']), ("[]", []),
])
def test_text_array(spark, text, expected):
    assert one(spark, text_array(F.lit(text))) == expected


@pytest.mark.parametrize("body, expected", [
    ('{"_id":"573a1390f"}', "573a1390f"), ('{"_id":{"$oid":"573a1390f"}}', "573a1390f"), ('{"nome":"x"}', None),
    ('{"_id":7}', "7"), ('{"_id":null}', None), ('{"_id":{"a":1}}', '{"a":1}'), ('{"_id":{"$oid":null}}', None),
])
def test_source_key(spark, body, expected):
    assert one(spark, source_key(F.lit(body))) == expected


def test_body_without_keeps_the_key_and_the_rest(spark):
    body = F.lit('{"_id":1,"secret":{"x":[1]},"n":null,"t":"a"}')
    assert one(spark, body_without(body, ["secret", "_id", "gone"])) == '{"_id":1,"n":null,"t":"a"}'


@pytest.mark.parametrize("body, expected", [
    ('{"a":1.50,"b":1e5}', '{"b":1e5}'), ('{"b":1e5, "a":2}', '{"b":1e5}'), ('{ "a" : 1 , "b" : 00.5e1 }', None),
    ('{"a":1}', "{}"), ("{}", "{}"), ("{ }", "{ }"), ('{"a":{"b":"}"},"c":[{"a":1},"a"]}', '{"c":[{"a":1},"a"]}'),
    ('{"x":"\\\\","a":"\\"","y":"a,\\"a\\":1"}', '{"x":"\\\\","y":"a,\\"a\\":1"}'),
    ('{"\\u0061":1,"b":123456789012345678901234567890.10}', '{"b":123456789012345678901234567890.10}'),
    ('{"a":1,"b":2,"a":3}', '{"b":2}'), ('{"b":1}{"a"', None), ('{"é":"ü","a":"日本"}', '{"é":"ü"}'), ("[1]", None), ("{", None), ("", None), (None, None),
])
def test_members_are_cut_without_rewriting_the_rest(spark, body, expected):
    assert one(spark, body_without(F.lit(body).cast("string"), ["a"])) == expected


def test_cut_members_reads_each_escaped_name_once(monkeypatch):
    from weirgate.functions import json_cut

    read, loads = [], json_cut.json.loads
    monkeypatch.setattr(json_cut.json, "loads", lambda text, **options: read.append(text) or loads(text, **options))
    bodies = [f'{{"a": {i}, "\\u0062": 1, "c\\\\": "x\\\\"}}' for i in range(50)]
    assert list(cut_members(pd.Series(bodies), ("b", "d"))) == [f'{{"a": {i}, "c\\\\": "x\\\\"}}' for i in range(50)]
    assert len(read) == 2


def test_cut_members_against_a_parser(spark):
    rng = random.Random(5)

    def value(deep):
        kind = rng.randrange(6 if deep else 4)
        if kind == 0:
            return rng.choice(["1e5", "-0.10", "12345678901234567890.5", "null", "true"])
        if kind < 4:
            return json.dumps("".join(rng.choice('a"\\{}[],: é\n') for _ in range(rng.randrange(6))), ensure_ascii=rng.random() < 0.5)
        inner = [value(deep - 1) for _ in range(rng.randrange(3))]
        return "[" + ", ".join(inner) + "]" if kind == 4 else "{" + ",".join(f'"a{i}" : {v}' for i, v in enumerate(inner)) + "}"

    names, bodies, expected = ["a", "b", 'q"', "d\\", "é"], [], []
    for _ in range(400):
        picked = rng.sample(names, rng.randrange(len(names) + 1))
        members = [(name, f"{json.dumps(name)}: {value(2)}") for name in picked]
        bodies.append("{" + ",".join(m for _, m in members) + "}")
        expected.append("{" + ",".join(m for name, m in members if name not in ('q"', "b")) + "}")
    assert list(cut_members(pd.Series([None, *bodies]), ('q"', "b"))) == [None, *expected]


def test_document_keeps_nulls_and_microseconds(spark):
    df = spark.sql("select 1 a, cast(null as string) b, timestamp_ntz'2024-01-01 00:00:00.000123' t, x'0aff' r")
    text = df.select(document(df)).first()[0]
    assert text == '{"a":1,"b":null,"t":"2024-01-01T00:00:00.000123","r":"0aff"}'


def test_path_text_of_absent_path(spark):
    assert one(spark, path_text(F.lit('{"a":{"b":1}}'), "a.c.d")) is None


def test_clean_names():
    assert clean_names(["a b", "a_b", "(a b)", "==", "ok"]) == ["a_b", "a_b_2", "a_b_3", "col", "ok"]
    assert clean_names(["a_2", "a", "a,"]) == ["a_2", "a", "a_3"]


def test_canonical_text(spark):
    schema = T.StructType([
        T.StructField("t", T.TimestampType()), T.StructField("d", T.DateType()), T.StructField("b", T.BinaryType()),
        T.StructField("n", T.DecimalType(10, 3)), T.StructField("i", T.DayTimeIntervalType()),
        T.StructField("s", T.StructType([T.StructField("x", T.IntegerType())])), T.StructField("f", T.BooleanType()),
    ])
    moment = dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)
    row = (moment, dt.date(2024, 1, 2), b"\x0a\xff", Decimal("1.500"), dt.timedelta(seconds=90, microseconds=5), (1,), True)
    got = canonical_text(spark.createDataFrame([row], schema)).first()
    assert tuple(got) == ("2024-01-02T03:04:05+00:00", "2024-01-02", "0aff", "1.500", "90.000005", '{"x":1}', "true")


def test_blank_lists(spark):
    df = spark.sql("select * from values (array()), (array('a')), (cast(null as array<string>)) t(v)")
    assert [r[0] for r in df.select(is_blank_list(F.col("v"))).collect()] == [True, False, True]


@pytest.mark.parametrize("value", [None, ""])
def test_no_mark_means_everything(spark, value):
    df = spark.range(3)
    assert df.where(newer_than(df, "id", value)).count() == 3
    assert df.where(newer_than(df, None, 1)).count() == 3


def test_marks_by_type(spark):
    df = spark.sql(
        "select * from values (timestamp_ntz'2016-01-01 00:00:00', timestamp'2016-01-01 00:00:00Z', '2015-08-26 00:03:50'),"
        "(timestamp_ntz'2016-01-01 00:00:01', timestamp'2016-01-01 00:00:01Z', '2015-08-27'), (null, null, null) t(n, z, s)"
    )
    for field, mark in (("n", "2016-01-01T00:00:00Z"), ("z", "2016-01-01T01:00:00+01:00"), ("s", "2015-08-26 00:03:50"),
                        ("z", dt.datetime(2016, 1, 1)), ("n", dt.date(2016, 1, 1))):
        assert df.where(newer_than(df, field, mark)).count() == 1
        assert df.where(newer_than(df, field, mark, inclusive=True)).count() == 2
        assert df.where(newer_than(df, field, mark, include_null_mark=True)).count() == 2


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_mark_round_trip_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("select timestamp'2016-03-26T23:20:16.000001Z' t")
        text = df.select(mark_text(F.max("t"), df.schema["t"].dataType)).first()[0]
        assert text == "2016-03-26T23:20:16.000001+00:00"
        assert df.where(newer_than(df, "t", text)).count() == 0
        assert df.where(newer_than(df, "t", "2016-03-26T23:20:16Z")).count() == 1
        parsed = one(spark, parse_mark(F.lit("2016-03-26T20:20:16-03:00"), F.lit("timestamp")))
        naive = one(spark, parse_mark(F.lit("2016-03-26T23:20:16"), F.lit("timestamp")))
        assert parsed == naive == "2016-03-26T23:20:16.000000+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_later_gives_way_to_null(spark):
    df = small_frame(spark, [(None, 5), (5, None), (3, 7), (7, 3)], "a int, b int")
    assert [r[0] for r in df.select(later(F.col("a"), F.col("b"))).collect()] == [5, 5, 7, 7]
