import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm import cases
from tokenizers import Tokenizer

from strandline.llm import planes


@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.sampled_from(sorted(planes.PLANES)))
@settings(max_examples=60, deadline=None)
def test_planes_round_trip(ids, kind):
    block = np.array(ids, np.uint32)
    assert planes.from_planes(planes.to_planes(block, kind), len(ids), kind).tolist() == ids


@given(st.lists(st.binary(max_size=40), max_size=6))
@settings(max_examples=60, deadline=None)
def test_join_crc32(parts):
    assert planes.join_crc32([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def encoder():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(public_tokenizers.path(planes.VOCABULARY))


def brute(rows):
    """doc_id, start, n_tokens, crc of rows in order, by the library on whole texts."""
    coder, start, found, every = encoder(), 0, [], []
    for doc_id, text in rows:
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, planes.END]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        every += ids
    return found, every


@pytest.mark.parametrize("kind", sorted(planes.PLANES))
@pytest.mark.parametrize("chunk", [7, 1000])
def test_stored_documents(spark, folder, kind, chunk):
    docs = cases.documents(spark).repartition(3)
    texts = cases.texts()
    docs = docs.withColumn("text", F.when(F.col("doc_id") == 6, "<|endoftext|> and a<|endoftext|>").when(F.col("doc_id") == 12, F.substring("text", 1, 9000)).otherwise(F.col("text")))
    texts[6], texts[12] = "<|endoftext|> and a<|endoftext|>", texts[12][:9000]
    planes.write_ids(docs, f"{folder}/ids", kind, chunk)
    rows = [(None, texts[0])] + [(i, t) for i, t in enumerate(texts) for _ in range(3 if i == 7 else 1)]
    want, every = brute(rows)
    got = sorted((tuple(r) for r in planes.read_documents(spark, f"{folder}/ids").collect()), key=lambda r: r[1])
    assert got == want
    spans = sorted((r.start, r.ids) for r in planes.read_span(spark, f"{folder}/ids", 900, 5000).collect())
    assert spans[0][0] == 900 and [i for _, ids in spans for i in ids] == every[900:5900]
    index = planes.chunk_index(spark, f"{folder}/ids").collect()
    assert sum(r.n_ids for r in index) == len(every) and max(r.n_ids for r in index) <= chunk


def test_copies_of_one_id_may_span_shards(spark, folder):
    docs = spark.createDataFrame([(5, f"text {i}") for i in range(400)] + [(1, "one"), (9, None)], "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        planes.write_ids(docs, f"{folder}/ids", chunk=64)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sorted((tuple(r) for r in planes.read_documents(spark, f"{folder}/ids").collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [1] + [5] * 400 + [9]
    assert [r[1] for r in got] == [sum(x[2] for x in got[:k]) for k in range(len(got))] and got[-1][2:] == (1, zlib.crc32(b"\2\0\0\0"))
    assert planes.chunk_index(spark, f"{folder}/ids").select("shard").distinct().count() > 1


def test_empty_table_and_unknown_kind(spark, folder):
    planes.write_ids(cases.empty(spark), f"{folder}/ids")
    assert planes.read_documents(spark, f"{folder}/ids").collect() == []
    with pytest.raises(ValueError, match="kind must be"):
        planes.write_ids(cases.empty(spark), f"{folder}/other", "nibble")


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="given tables not present")
def test_query_equals_the_library(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted((tuple(r) for r in planes.op11_planes(spark, "/root/testdata/sf0.001").collect()), key=lambda r: r[1])
    assert got == brute(map(tuple, rows))[0]
