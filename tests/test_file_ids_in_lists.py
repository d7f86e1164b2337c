"""File ids come from lists of loads; rows move to them once."""

import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from strandline.operators import files as X
from strandline.operators import skew
from strandline.plans.store import Store
from strandline.session import LANDED
from tests.conftest import values

HISTORY = "state string, target_path string, checksum_crc32c string, file_id string"


@pytest.mark.parametrize("most", [1000, 2])
def test_any_number_of_loads_gives_a_row_per_load(spark, folder, monkeypatch, most):
    monkeypatch.setattr(skew, "LIST_ROWS", most)
    monkeypatch.setattr(skew, "MIN_SLICE_ROWS", 4)
    rng = random.Random(5)
    rows = [("sequence_file", f"r{i}", json.dumps({"file_id": f"i{i % 7}", "crc32c": "c", "file_name": "n"}), "{}") for i in range(40)]
    rows += [("sequence_file", "none", None, "{}"), ("sequence_file", "odd", "not json", "{}"), ("sequence_file", "r0", rows[0][2], "{}")]
    loads = [(rng.choice(["succeeded", "succeeded", "failed"]), rng.choice([f"/v1/i{k}/c/n" for k in range(5)] + [None]), rng.choice(["c", "c", "x", None]), rng.choice(["f1", "f2", "f3", "f4", None])) for _ in range(60)]
    loads += [("succeeded", "/v1/i6/c/n", "c", None)]
    want = []
    for kind, name, descriptor, content in rows:
        fields = json.loads(descriptor) if descriptor and descriptor[0] == "{" else {}
        path = f"/v1/{fields['file_id']}/c/n" if fields else None
        found = [load[3] for load in loads if path and load[:3] == ("succeeded", path, "c")]
        want += [(kind, name, descriptor, content, file_id) for file_id in found or [None]]
    spark.createDataFrame(rows, "entity_type string, entity_id string, descriptor string, content string").repartition(2).write.parquet(f"{folder}/rows")
    n_landed = len(LANDED)
    found = X.with_file_ids(spark.read.parquet(f"{folder}/rows").withColumn("file_id", F.lit("old")), spark.createDataFrame(loads, HISTORY))
    order = lambda rows: sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))
    assert found.columns == ["entity_type", "entity_id", "descriptor", "content", "file_id"]
    assert order([tuple(row) for row in found.collect()]) == order(want)
    assert [spark.read.parquet(path).columns for path in LANDED[n_landed:]] == [["__path"]]  # addresses were stored too


def test_lists_hold_each_value_once_with_its_number(spark, monkeypatch):
    monkeypatch.setattr(skew, "LIST_ROWS", 3)
    rows = [("one", "a")] * 2 + [("many", f"v{i % 9}") for i in range(30)] + [(None, "z")]
    found = skew.listed(spark.createDataFrame(rows, "k string, v string"), ["k"], "v")
    assert values(found.filter("k = 'one'").selectExpr("k", "explode(v) as e").select("k", "e.v", "e.n")) == [("one", "a", 2)]
    assert values(found.filter("k = 'many'").selectExpr("explode(v) as e").select("e.v", "e.n")) == [(f"v{i}", 4 if i < 3 else 3) for i in range(9)]
    assert found.filter("k = 'many'").count() > 1 and found.filter("k is null").count() == 0


def test_row_ids_are_counted_up(spark, folder):
    """Random ids were 60 of 100 bytes that a narrow row takes."""
    store = Store(spark, folder)
    rows = spark.range(3000).select(F.lit("project").alias("entity_type"), F.col("id").cast("string").alias("entity_id"),
                                    F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 3 as int))").alias("version"), F.lit("{}").alias("content"))
    store.append(rows)
    store.append(rows)
    ids = [uuid.UUID(row.row_id) for row in store.raw().select("row_id").collect()]
    assert len(set(ids)) == 6000 and all((u.version, u.variant) == (8, uuid.RFC_4122) for u in ids)
    assert len({str(u)[:18] for u in ids}) == 2 and len({u.int >> 32 for u in ids}) < 100
