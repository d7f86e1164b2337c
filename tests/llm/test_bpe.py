import hashlib
import struct

import public_tokenizers
import tiktoken
from tests.llm import cases

from strandline.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path(bpe.VOCABULARY))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_ids_equal_the_library_and_decode_to_the_text(spark):
    docs = cases.documents(spark)
    back = bpe.decode(bpe.encode(docs, keep=("doc_id", "text", "_row")), keep=("doc_id", "text", "ids", "_row"))
    rows = back.collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row.ids == LIBRARY.encode_ordinary(row.text or "")
        assert bytes(row.decoded) == (row.text or "").encode()


def test_digests(spark):
    for row in bpe.digests(cases.documents(spark), keep=("doc_id", "text")).collect():
        ids = LIBRARY.encode_ordinary(row.text or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()


def test_round_trip(spark):
    for row in bpe.round_trip(cases.documents(spark), keep=("doc_id", "text", "ids")).toDF("doc_id", "text", "clash", "ids", "digest").collect():
        assert row.ids == LIBRARY.encode_ordinary(row.text or "") and row.digest == hashlib.sha256((row.text or "").encode()).hexdigest()


def test_long_runs_and_odd_spaces():
    coder = bpe.Coder(RANKS, public_tokenizers.PATTERN)
    for text in ("a" * 3000, " " * 5000 + "x", "é" * 777, "　  x  \n\n y", "0123456789" * 90, "日本語" * 100, "!?" * 400, "don't I'LL 'S"):
        assert coder.encode(text) == LIBRARY.encode_ordinary(text)


def test_empty_table(spark):
    assert bpe.digests(cases.empty(spark), keep=("doc_id",)).collect() == []
