import os

import duckdb
import pytest
from tests.llm import cases

import corpus_pipeline
from strandline.llm import registry

SMALLEST = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_awkward_documents(spark, folder):
    cases.documents(spark).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, cases.prose(9, 93))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, left = docs.columns, []
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{at}")
        docs = spark.read.parquet(f"{folder}/{at}")
        left.append(docs.count())
        assert docs.columns == columns or at == len(corpus_pipeline.STAGES) - 1, name
    ids = {r.doc_id for r in docs.collect()}
    assert left == sorted(left, reverse=True) and not ids & {2, 3, 4, 5, 9, 20, 25} and {0, 1, 6, 12, 19} < ids
    run = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in run.collect()} == ids


def test_stages_take_an_empty_table(spark, folder):
    cases.empty(spark).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "some words")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


@pytest.mark.skipif(not os.path.isdir(SMALLEST), reason="given tables not present")
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALLEST}/{table}.parquet')")
    cursor = db.execute(registry.ORACLES[name])
    names = [c[0] for c in cursor.description]
    want = sorted(cursor.fetchall(), key=str)
    frame = registry.QUERIES[name](spark, SMALLEST)
    assert set(names) == set(frame.columns)
    assert sorted((tuple(r) for r in frame.select(*names).collect()), key=str) == want


@pytest.mark.skipif(not os.path.isdir(SMALLEST), reason="given tables not present")
@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_returns_a_row_for_each_row(spark, name):
    frame = registry.QUERIES[name](spark, SMALLEST)
    assert frame.count() == (spark.read.parquet(f"{SMALLEST}/documents.parquet").count() if name != "op2_hnsw" else 50)
