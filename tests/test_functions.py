from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strandline.functions import jsons, names, versions
from strandline.functions.schema_check import violations


def one(spark, expression, **columns):
    frame = spark.createDataFrame([tuple(columns.values()) or ("x",)], list(columns) or ["x"])
    return frame.select(expression.alias("v")).first().v


def column(spark, texts, make):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [row.v for row in frame.select("i", make(F.col("t")).alias("v")).orderBy("i").collect()]


def test_versions(spark):
    texts = ["2021-09-30T15:14:32.123456Z", "2021-09-30T15:14:32.5Z", "2021-09-30T15:14:32Z", "2021-09-30T15:14:32.123",
             "2021-09-30T15:14:32+01:00", "20210930", None, "2021-13-30T15:14:32Z"]
    assert column(spark, texts, versions.parse_version) == [
        datetime(2021, 9, 30, 15, 14, 32, 123456), datetime(2021, 9, 30, 15, 14, 32, 500000), datetime(2021, 9, 30, 15, 14, 32),
        None, None, None, None, None]
    with pytest.raises(Exception, match="does not match format"):
        column(spark, ["2021-09-30T15:14:32.123"], versions.require_version)
    stamp = versions.date_stamp(F.lit("2021-09-30").cast("date"))
    assert one(spark, stamp) == "20210930"
    assert one(spark, versions.leading_date(F.lit("2021-09-30T15"))) == "2021-09-30"


def test_project_ids_in_paths(spark):
    single = "shelf//x/0b1c2d3e-4f50-4a6b-9c7d-00112233aabb/end"
    texts = [single, single + "/9f8e7d6c-5b4a-4392-8170-ffeeddccbbaa", "example", single.upper(), single.replace("-", "")]
    assert column(spark, texts, names.project_id_in) == [
        "0b1c2d3e-4f50-4a6b-9c7d-00112233aabb", None, None, "0B1C2D3E-4F50-4A6B-9C7D-00112233AABB", "0b1c2d3e4f504a6b9c7d00112233aabb"]
    with pytest.raises(Exception, match="exactly one project UUID"):
        column(spark, ["example"], names.require_project_id_in)


def test_paths(spark):
    assert column(spark, ["a/b.json", "b", "a/"], names.base_name) == ["b.json", "b", ""]
    assert column(spark, ["a/b/c.json", "c"], names.parent) == ["a/b", ""]
    assert column(spark, [" /gs://x/y// ", "x"], names.clean_path) == ["gs://x/y", "x"]
    assert column(spark, ["gs://a/b//", " gs://a/b ", "gs://a/b/ "], names.clean_area_line) == ["gs://a/b", "gs://a/b", "gs://a/b/"]


def test_compact_keeps_order_and_characters(spark):
    texts = ['{ "b" : [1, 2.50, 1e2],\n "a": "bräîn \\u00e9 \\/" }', "{oops", None, "[]", '{"a":1,"b":2,"a":3}']
    assert column(spark, texts, jsons.compact) == [
        '{"b":[1,2.5,100.0],"a":"bräîn é /"}', None, None, "[]", '{"a":3,"b":2}']


def test_scalars(spark):
    doc = '{"s":"x","n":2.50,"t":true,"z":null,"o":{"a":1},"l":[1],"looks":"[1]","in":{"k":"v"}}'
    found = {p: one(spark, jsons.scalar(F.col("d"), f"$.{p}"), d=doc) for p in ("s", "n", "t", "z", "o", "l", "looks", "in.k", "absent")}
    assert found == {"s": "x", "n": "2.5", "t": "true", "z": None, "o": None, "l": None, "looks": "[1]", "in.k": "v", "absent": None}


def test_string_properties_and_keys(spark):
    texts = ['{"p":"x"}', '{"p":1}', '{"p":null}', '{"q":{"p":"x"}}', "{", None, '{"p":""}', '{"p":"a","p":"b"}']
    assert column(spark, texts, lambda t: jsons.is_string_property(t, "p")) == [True, False, False, False, False, False, True, True]
    assert column(spark, texts[:4], lambda t: jsons.has_key(t, "p")) == [True, True, True, False]


def test_json_equality(spark):
    pairs = [('{"a":1,"b":2}', '{"b": 2, "a": 1.0}', True), ('{"a":1}', '{"a":"1"}', False), ("[1,2]", "[2,1]", False), ("no", "no", True)]
    frame = spark.createDataFrame(pairs, "l string, r string, same boolean")
    assert all(row.same == row.got for row in frame.withColumn("got", jsons.same_json(F.col("l"), F.col("r"))).collect())


SCHEMA = {
    "type": "object", "required": ["id"], "additionalProperties": False,
    "properties": {
        "id": {"type": "string", "pattern": "^[a-z]+$"}, "n": {"type": ["integer", "null"]}, "list": {"type": "array", "items": {"type": "number"}},
        "kind": {"enum": ["a", 1]}, "in": {"type": "object", "required": ["x"]},
    },
}


@pytest.mark.parametrize("document,expected", [
    ({"id": "abc", "n": None, "list": [1, 2.5], "kind": 1}, []),
    ({}, ["#: required key [id] not found"]),
    ({"id": 5}, ["#/id: expected type: String, found: Integer"]),
    ({"id": "A1"}, ["#/id: string [A1] does not match pattern ^[a-z]+$"]),
    ({"id": "a", "list": [1, "x"]}, ["#/list/1: expected type: Number, found: String"]),
    ({"id": "a", "kind": True}, ["#/kind: True is not a valid enum value"]),
    ({"id": "a", "more": 1}, ["#: extraneous key [more] is not permitted"]),
    ({"id": "a", "in": {}}, ["#/in: required key [x] not found"]),
    ([], ["#: expected type: JSONObject, found: JSONArray"]),
])
def test_schema_keywords(document, expected):
    assert list(violations(document, SCHEMA)) == expected


def test_names_of_datasets(spark):
    import re

    dataset = names.dataset_name_pattern("atlas")
    assert re.search(dataset, "atlas_dev_0b1c2d3e4f504a6b9c7d00112233aabb__20190305")
    assert not re.search(dataset, "fake_dataset_name")
    earlier, current = names.snapshot_name_patterns(["atlas", "lung"])
    assert re.search(current, "lung_prod_0b1c2d3e4f504a6b9c7d00112233aabb__20190305_20210101_r1")
    assert re.search(earlier, "atlas_prod_20190305_q_0b1c2d3e-4f50-4a6b-9c7d-00112233aabb__20210101")
    assert not any(re.search(p, "atlas_dev_20201120_r2__20210701_r7") for p in (earlier, current))
    lit = F.lit
    moment = lit("2021-02-03").cast("date")
    made = names.project_snapshot_name(lit("atlas"), lit("prod"), lit("a-b"), lit("atlas_prod_ab__20200101_dq"), moment, lit("dq"), lit("r1"))
    assert one(spark, made) == "atlas_prod_ab__20200101_dq_20210203_r1"
    plain = names.project_snapshot_name(lit("atlas"), lit("prod"), lit("a-b"), lit("atlas_prod_ab__20200101_dq"), moment, lit(None).cast("string"), lit(""))
    assert one(spark, plain) == "atlas_prod_ab__20200101_20210203"
    assert one(spark, names.full_view_name(lit("d"), moment, lit("tuesday"))) == "d___20210203_tuesday"
