"""Registered queries: complete, and equal to their SQL at the smallest scale."""

import os
import re

import pytest

import __spark_entry__ as entry
import compare

SMALLEST = "/root/testdata/sf0.001"
IDS = (
    [f"s{i}" for i in range(1, 13)] + [f"k{i}" for i in range(1, 11)] + [f"p{i}" for i in (*range(1, 18), 19)]
    + [f"j{i}" for i in range(1, 18)] + [f"a{i}" for i in range(1, 14)] + ["w1", "w2", "w3", "r1", "r2"]
    + [f"u{i}" for i in range(1, 6)] + [f"f{i}" for i in range(1, 12)] + [f"v{i}" for i in range(1, 12)]
    + [f"d{i}" for i in range(1, 10)]
)


def test_every_operator_has_a_query_with_sql():
    names = entry.registry.QUERIES
    covered = {re.match(r"[a-z]\d+", name).group() for name in names}
    assert covered == set(IDS)
    assert set(entry.registry.ORACLES) == set(names)


@pytest.mark.skipif(not os.path.isdir(SMALLEST), reason="given tables not present")
@pytest.mark.parametrize("name", [
    "d2_outdated_rows", "d1_duplicate_rows", "w1_rows_beyond_first", "j3_staged_existing_diff", "j6_inject_file_ids",
    "j11_file_report", "j12_staged_against_stored", "a9_problem_counts", "k7_error_log", "k9_manifests", "v6_missing_entities_by_project",
    "d5_upsert_load", "s1_match_files",
])
def test_query_equals_sql(spark, name):
    [(_, status, _, n_rows)] = compare.compare(spark, SMALLEST, [name])
    assert status == "ok" and n_rows > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["entity_type", "entity_id", "row_id"]
