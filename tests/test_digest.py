"""Digests of documents: equal up to key order and number spelling, of any size, stored with the rows."""

import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.functions.jsons import content_digest, digest_of, text_digest
from strandline.operators import release as R
from strandline.plans.store import Store
from tests.conftest import values

DOCUMENTS = st.recursive(
    st.none() | st.booleans() | st.integers(-10**20, 10**20) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=5),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.text(max_size=3), inner, max_size=4), max_leaves=12)


def plain(value):
    """Sorted, with whole floats as integers."""
    if isinstance(value, dict):
        return {k: plain(v) for k, v in sorted(value.items())}
    if isinstance(value, list):
        return [plain(v) for v in value]
    return int(value) if isinstance(value, float) and value.is_integer() else value


@given(DOCUMENTS, DOCUMENTS)
def test_digests_are_equal_where_canonical_forms_are(a, b):
    assert (digest_of(a) == digest_of(b)) == (json.dumps(plain(a), sort_keys=True) == json.dumps(plain(b), sort_keys=True))
    assert text_digest(json.dumps(a, indent=3)) == digest_of(a)


@pytest.mark.parametrize(("one", "other", "same"), [
    ('{"a":1,"b":[1.0,2]}', '{ "b" : [1, 2.0e0], "a": 1 }', True), ('{"a":1}', '{"a":"1"}', False), ("not json", "not json", True),
    ("not json", '"not json"', False), ('{"a":1,"a":2}', '{"a":2}', True), ("[]", "{}", False), ('{"a":NaN}', '{"a":null}', False), (None, "null", False),
])
def test_texts(spark, one, other, same):
    frame = spark.createDataFrame([(one, other)], "one string, other string")
    assert [row.same for row in frame.select(content_digest(F.col("one")).eqNullSafe(content_digest(F.col("other"))).alias("same")).collect()] == [same]


def test_a_document_beyond_the_parser_compares(spark):
    """130 MB, spelled with its keys in another order."""
    body = F.concat(F.lit('"big":"'), F.repeat(F.lit("x" * 100), 1_300_000), F.lit('"'))
    rows = spark.range(1).select(F.concat(F.lit('{"a":1,'), body, F.lit("}")).alias("one"), F.concat(F.lit("{"), body, F.lit(',"a":1.0}')).alias("other"))
    found = rows.select(content_digest(F.col("one")).alias("one"), content_digest(F.col("other")).alias("other")).first()
    assert found.one == found.other


def test_stored_rows_are_compared_without_their_content(spark, folder):
    store = Store(spark, folder)
    rows = spark.createDataFrame([("project", "p", '{"a":1,"b":2}'), ("project", "q", "{}")], "entity_type string, entity_id string, content string")
    store.append(rows.withColumn("version", F.lit("2021-01-01").cast("timestamp")))
    staged = spark.createDataFrame([("x", "project", "p", "2021-01-01T00:00:00.000000Z", text_digest('{"b":2,"a":1.0}')),
                                    ("x", "project", "q", "2021-01-01T00:00:00.000000Z", text_digest("[]"))],
                                   "area string, entity_type string, entity_id string, version string, content_digest string")
    stored = R.latest_stored(store.live())
    assert "content:string" not in stored._jdf.queryExecution().executedPlan().toString()
    assert values(R.compare_entities(R.latest_staged(staged), stored), "entity_id", "status") == [("p", "ok"), ("q", "content_differs")]
