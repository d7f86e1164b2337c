"""The keep rules against plain Python on random rows with ties, nulls and one heavy id."""

import random
from collections import defaultdict

import pytest

from conftest import values
from strandline.operators import latest as L
from strandline.operators import skew


def sample(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        heavy = rng.random() < 0.4
        entity = "heavy" if heavy else f"e{rng.randrange(60)}"
        version = None if rng.random() < 0.05 else rng.randrange(12 if heavy else 3)
        rows.append((rng.choice("ab"), entity, version, f"r{i:04d}", rng.choice([None, "f1", "f2"])))
    rows += [("a", "all-null", None, "r9998", None), ("a", "all-null", None, "r9999", "f")]
    return rows


@pytest.fixture(params=[None, 10], ids=["whole keys", "sliced keys"])
def slices(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(skew, "MIN_SLICE_ROWS", request.param)


def frame(spark, rows):
    return spark.createDataFrame(rows, "entity_type string, entity_id string, version int, row_id string, file_id string").repartition(3)


def groups(rows):
    found = defaultdict(list)
    for row in rows:
        found[row[:2]].append(row)
    return found.values()


def ids(rows):
    return sorted((row[3],) for row in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_keep_rules(spark, slices, seed):
    rows = sample(seed)
    data = frame(spark, rows)
    outdated, duplicates, beyond, file_beyond = [], [], [], []
    for group in groups(rows):
        versions = [r[2] for r in group if r[2] is not None]
        newest = max(versions, default=None)
        outdated += [r for r in group if r[2] is not None and r[2] < newest]
        if len(group) > 1:
            kept = max((r[3] for r in group if newest is not None and r[2] == newest), default=None)
            duplicates += [r for r in group if r[3] != kept]
        by_version = lambda r: -(r[2] if r[2] is not None else -1)
        beyond += sorted(group, key=lambda r: (by_version(r), r[3]))[1:]
        file_beyond += sorted(group, key=lambda r: (by_version(r), r[4] is None, r[4] or "", r[3]))[1:]
    assert values(L.outdated_rows(data), "row_id") == ids(outdated)
    assert values(L.duplicate_rows(data), "row_id") == ids(duplicates)
    assert values(L.rows_beyond_first(data), "row_id") == ids(beyond)
    assert values(L.file_rows_beyond_first(data), "row_id") == ids(file_beyond)


def test_null_ids_are_never_duplicates(spark):
    data = spark.createDataFrame([("t", None, 1, "r1", None), ("t", None, 2, "r2", None)],
                                 "entity_type string, entity_id string, version int, row_id string, file_id string")
    assert L.duplicate_rows(data).count() == 0
    assert L.outdated_rows(data).count() == 0


def test_aggregates(spark):
    data = frame(spark, [("t", "a", 1, "r1", None), ("t", "a", 2, "r2", None), ("t", "a", 2, "r3", None), ("t", "b", 5, "r4", None)])
    assert values(L.latest_versions(data)) == [("t", "a", 2), ("t", "b", 5)]
    assert values(L.duplicate_ids(data)) == [("t", "a", 2, 3)]
    assert values(L.latest_row_ids(data)) == [("t", "a", "r3"), ("t", "b", "r4")]


def test_outdated_files_compare_versions_as_text(spark):
    files = [("p/e_1.json", "p", "e", "1.json"), ("p/e_2.json", "p", "e", "2.json"), ("q/e_1.json", "q", "e", "1.json"),
             ("p/f_9.json", "p", "f", "9.json"), ("p/f_10.json", "p", "f", "10.json")]
    data = spark.createDataFrame(files, "blob string, path string, entity string, version string")
    assert values(L.outdated_files(data), "blob") == [("p/e_1.json",), ("p/f_10.json",)]


def test_hot_keys_are_found_and_bounded(spark):
    data = spark.range(2000).selectExpr("if(id % 2 = 0, 'hot', cast(id as string)) as k", "id")
    hot = skew.hot_keys(data, ["k"], min_slice_rows=100).collect()
    assert [row["__copies"] for row in hot] == [10]


def test_a_key_of_a_small_share_is_cut_by_an_absolute_bound(spark):
    """1/2000 of the rows, in a list of many keys whose entries are mostly shared."""
    data = spark.range(400_000).selectExpr("case when id < 200 then 'some' when id < 221 then 'few' else cast(id div 2 as string) end as k", "id")
    assert [row["__copies"] for row in skew.hot_keys(data, ["k"], min_slice_rows=21).collect()] == [10]
    assert skew.hot_keys(data, ["k"], min_slice_rows=200).count() == 0
    assert sorted(row["__copies"] for row in skew.hot_keys(data, ["k"], min_slice_rows=20).collect()) == [2, 10]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    left = spark.range(3000).selectExpr("case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else cast(id % 50 as string) end as k", "id")
    right = spark.range(40).selectExpr("if(id = 0, 'hot', cast(id as string)) as k", "id as other")
    plain = left.join(right, "k", how)
    spread = skew.spread_join(left, right, ["k"], how, ["id"], min_slice_rows=50)
    assert spread.columns == plain.columns
    assert values(spread) == values(plain)


def test_heavy_key_is_really_split(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(4000).selectExpr("'hot' as k", "id")
        right = spark.createDataFrame([("hot", 1)], "k string, other int")
        joined = skew.spread_join(left, right, ["k"], "inner", ["id"], min_slice_rows=100)
        sizes = [n for n in joined.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 4000 and len(sizes) > 1


def test_joins_with_heavy_keys_on_both_sides(spark):
    left = spark.range(400).selectExpr("case when id % 4 = 0 then 'hot' when id % 9 = 0 then null else cast(id % 30 as string) end as k", "id")
    right = spark.range(300).selectExpr("case when id % 3 = 0 then 'hot' when id % 11 = 0 then null else cast(id % 40 as string) end as k",
                                        "if(id % 5 = 0, null, cast(id as string)) as other", "id % 7 as more")
    want = values(left.join(right, "k", "left"))
    for least in (None, 20):
        assert values(skew.left_join(left, right, ["k"], ["id"], ["other", "more"], min_slice_rows=least)) == want
    inner = values(left.join(right, "k"))
    assert values(skew.grid_join(left, right, ["k"], ["id"], ["other", "more"], min_slice_rows=20)) == inner
    single = right.dropDuplicates(["k"])
    assert values(skew.left_join(left, single, ["k"], ["id"], ["other"], min_slice_rows=20)) == values(left.join(single, "k", "left"))
