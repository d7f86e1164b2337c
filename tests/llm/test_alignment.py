import hashlib
import os
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tests.llm import cases
from tokenizers import Tokenizer

from strandline.llm import alignment

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(rows):
    """By whole texts, byte by byte, with every link in memory."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    spelled_a, spelled_b = alignment.byte_lengths_first(public_tokenizers.path("byte_bpe_50k.json")), alignment.byte_lengths_second(public_tokenizers.path("piece_bpe_32k.model"))
    found, counts = [], Counter()
    for doc_id, text in rows:
        raw = (" " + text).encode() if text else b""
        a, b = (first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)) if text else ([], [])
        if any(b"".join(s[i] for i in ids) != raw for ids, s in ((a, spelled_a), (b, spelled_b))):
            a, b = [], []
        of_a, of_b = ([k for k, i in enumerate(ids) for _ in s[i]] for ids, s in ((a, spelled_a), (b, spelled_b)))
        links = sorted(set(zip(of_a, of_b)))
        groups, at = [], (0, 0)
        for p in range(len(of_a)):
            last = p + 1 == len(of_a)
            if last or of_a[p] != of_a[p + 1] and of_b[p] != of_b[p + 1]:
                after = of_a[p] + 1, of_b[p] + 1
                groups.append(",".join(map(str, a[at[0] : after[0]])) + "|" + ",".join(map(str, b[at[1] : after[1]])))
                at = after
        pairs = [(b[j], a[i]) for i, j in links]
        counts.update(pairs)
        found.append((doc_id, len(a), len(b), groups, pairs))
    highest = Counter()
    for (b, _), n in counts.items():
        highest[b] = max(highest[b], n)
    return sorted(
        ((d, n_a, n_b, len(groups), len(pairs), sum(counts[p] == highest[p[0]] for p in pairs), sum(counts[p] for p in pairs),
          hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "") for d, n_a, n_b, groups, pairs in found), key=str)


def got(frame):
    assert frame.columns == COLUMNS
    return sorted(map(tuple, frame.collect()), key=str)


def test_pack_round_trip():
    for values in ([], [0], [255, 0], [256], [70_000, 3], [2**40, 1]):
        assert alignment.unpack(alignment.pack(np.array(values, np.int64))).tolist() == values


TEXTS = ["<|endoftext|> and <s>a</s>", "a▁b", " ", "\n", "  two  blanks \n\n and\tа tab ", "字字 é́ 🙂🙂", "<0x41> \x00 nul", "x" * 500, "one two three " * 40]


@pytest.mark.parametrize(("radix", "fan", "run_links"), [(32, 64, 1 << 22), (3, 2, 300)])
def test_equals_brute_force(spark, radix, fan, run_links):
    texts = [t[:6000] if t else t for t in cases.texts()] + TEXTS
    docs = cases.documents(spark, texts).repartition(3)
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0])] + [(7, texts[7])] * 2
    assert got(alignment.align_documents(docs, radix=radix, fan=fan, run_links=run_links)) == brute(rows)


def test_long_document_is_counted_up_part_by_part(spark, monkeypatch):
    text = cases.prose(4, 3000)
    whole = alignment.Aligner(public_tokenizers.path(alignment.FIRST), public_tokenizers.path(alignment.SECOND)).document(text)
    monkeypatch.setattr(alignment, "TEXT_PART", 500)
    monkeypatch.setattr(alignment, "LONG_DOC", 300)
    parts = alignment.Aligner(public_tokenizers.path(alignment.FIRST), public_tokenizers.path(alignment.SECOND), held=50).document(text)
    assert parts[:5] == whole[:5]
    assert all(map(np.array_equal, alignment._counted([parts[5]], [parts[6]]), alignment._counted([whole[5]], [whole[6]])))


def test_empty_tables(spark):
    assert got(alignment.align_documents(cases.empty(spark))) == []
    nothing = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    assert got(alignment.align_documents(nothing)) == sorted([(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")], key=str)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="given tables not present")
def test_query_equals_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert got(alignment.op12_alignment(spark, "/root/testdata/sf0.001")) == brute(map(tuple, rows))
