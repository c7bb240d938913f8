import pytest
from pyspark.sql import functions as F

from tidemark.functions import json_values as J
from tidemark.operators.flatten import Field, flatten
from tidemark.plans.tournaments import LEVELS

AT = "2024-01-01 00:00:00"


def raw(spark, *texts):
    df = spark.createDataFrame([(t, f"f{i}") for i, t in enumerate(texts)], "data string, meta_file_name string")
    return df.withColumn("meta_file_modified", F.lit(AT).cast("timestamp_ntz"))


def one(spark, text, column):
    df = spark.createDataFrame([(text,)], "x string")
    return df.select(column(F.parse_json("x")).alias("r")).first()["r"]


@pytest.mark.parametrize("text, expected", [
    ('{"w": null}', None), ("{}", None), ('{"w": []}', ""), ('{"w": ["A", "B"]}', "A, B"),
    ('{"w": ["A", null]}', "A"), ('{"w": "A"}', "A"), ('{"w": "[x"}', "[x"), ('{"w": 1.50}', "1.5"),
])
def test_joined_text(spark, text, expected):
    assert one(spark, text, lambda v: J.joined_text(J.json_value(v, "$.w"))) == expected


@pytest.mark.parametrize("text, expected", [
    ("32", 32), ('"32"', 32), ("32.5", 32), ("33.5", 34), ("-2.5", -2), ("true", 1), ("null", None),
])
def test_json_to_int(spark, text, expected):
    assert one(spark, text, J.json_to_int) == expected


@pytest.mark.parametrize("text", ['""', '"abc"', '"32.5"', "3e9", "[1]"])
def test_json_to_int_unreadable(spark, text):
    assert one(spark, text, lambda v: J.json_to_int(v, strict=False)) is None
    with pytest.raises(Exception, match="not a valid int"):
        one(spark, text, J.json_to_int)


@pytest.mark.parametrize("text, expected", [
    ("2024", 2024), ("2024.5", 2025), ("-2.5", -3), ("1e3", 1000), (" 7 ", 7), (None, None),
])
def test_text_to_int(spark, text, expected):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(J.text_to_int(F.col("x"))).first()[0] == expected


@pytest.mark.parametrize("text, expected", [
    ("true", True), ('"true"', True), ("false", False), ("1", True), ("null", None),
])
def test_json_to_boolean(spark, text, expected):
    assert one(spark, text, J.json_to_boolean) == expected


@pytest.mark.parametrize("text, expected", [
    ("{}", "MISSING"), ('{"v": null}', "NULL"), ('{"v": [1]}', "ARRAY"), ('{"v": {}}', "OBJECT"),
    ('{"v": "x"}', "VARCHAR"), ('{"v": 1}', "BIGINT"), ('{"v": 1.5}', "DOUBLE"), ('{"v": true}', "BOOLEAN"),
])
def test_json_kind(spark, text, expected):
    assert one(spark, text, lambda v: J.json_kind(J.json_value(v, "$.v"))) == expected


def test_utc_timestamp_moves_offsets(spark):
    df = spark.createDataFrame([("2024-02-05T23:56:47.5+02:00",), ("2024-02-05T23:56:47+00:00",)], "x string")
    got = [str(r[0]) for r in df.select(J.utc_timestamp(F.col("x"))).collect()]
    assert got == ["2024-02-05 21:56:47.500000", "2024-02-05 23:56:47"]


FIELDS = (Field("a", "a"), Field("n", "n", "int"))


def test_flatten_gives_no_row_without_an_array(spark):
    docs = raw(spark, '{"data": null}', "{}", '{"data": []}', '{"data": [{"a": 1, "n": "2"}, null, 5]}')
    got = [tuple(r) for r in flatten(docs, FIELDS).select("a", "n", "meta_file_name").collect()]
    assert got == [("1", 2, "f3"), (None, None, "f3"), (None, None, "f3")]


def test_flatten_fails_on_an_object_only_if_strict(spark):
    docs = raw(spark, '{"data": {"a": 1}}')
    assert flatten(docs, FIELDS, strict=False).count() == 0
    with pytest.raises(Exception, match="no array at data"):
        flatten(docs, FIELDS).collect()


def test_flatten_two_levels(spark, rows):
    docs = raw(
        spark,
        '{"data": {"TournamentDates": [{"Tournaments": [{"a": "x"}, {"a": "y"}]}, {"Tournaments": []},'
        ' {"Tournaments": null}, {}, {"Tournaments": [{"a": "z"}]}]}}',
        '{"data": {"TournamentDates": null}}', '{"data": null}',
    )
    assert rows(flatten(docs, FIELDS[:1], LEVELS), "a") == [("x",), ("y",), ("z",)]
    broken = raw(spark, '{"data": {"TournamentDates": [{"Tournaments": {"a": 1}}]}}')
    assert flatten(broken, FIELDS[:1], LEVELS, strict=False).count() == 0
    with pytest.raises(Exception, match="no array at Tournaments"):
        flatten(broken, FIELDS[:1], LEVELS).collect()
