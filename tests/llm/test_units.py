import os

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from strandline.llm import units

os.environ["TOKENIZERS_PARALLELISM"] = "false"
TEXTS = st.text(alphabet="ab1'st é\n\t <|endoftext|>.　\xa0\x1c\x85\r字", max_size=120)
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
PIECES = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def ids(coder, text):
    return [int(i) for part in coder.ids(text) for i in part]


@given(TEXTS, st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_pieces_make_the_text(text, size):
    assert "".join(units.text_pieces(text, size)) == text == "".join(units.cut_units(text))


@pytest.mark.parametrize("plain", [False, True])
def test_units_have_the_tokens_of_the_whole_text(plain):
    coder = units.UnitCoder(units.byte_level(public_tokenizers.path("byte_bpe_50k.json"), plain), held=40)

    @given(TEXTS)
    @settings(max_examples=500, deadline=None)
    def equal(text):
        LIBRARY.encode_special_tokens = plain
        assert ids(coder, text) == LIBRARY.encode(text, add_special_tokens=False).ids

    equal()


def test_units_have_the_pieces_of_the_whole_text():
    coder = units.UnitCoder(units.piece_level(public_tokenizers.path("piece_bpe_32k.model")), held=40)

    @given(TEXTS)
    @settings(max_examples=500, deadline=None)
    def equal(text):
        assert ids(coder, " " + text) == (PIECES.encode(text) if text else [PIECES.piece_to_id("▁")])

    equal()


@pytest.mark.parametrize("part", [15, 1 << 20])
def test_batches_have_the_tokens_of_the_whole_texts(monkeypatch, part):
    monkeypatch.setattr(units, "TEXT_PART", part)
    coder = units.UnitCoder(units.byte_level(public_tokenizers.path("byte_bpe_50k.json")), held=40)
    plain = st.text(alphabet="ab1'sé\n .字", max_size=60)

    @given(st.lists(st.one_of(TEXTS, plain, st.lists(st.text("abé.'", min_size=1, max_size=4), max_size=9).map(" ".join)), max_size=6))
    @settings(max_examples=400, deadline=None)
    def equal(texts):
        LIBRARY.encode_special_tokens = False
        found = [[int(i) for part in parts for i in part] for parts in coder.ids_of_batch(pa.array(texts, pa.large_string()))]
        assert found == [LIBRARY.encode(text, add_special_tokens=False).ids for text in texts]

    equal()


def test_a_part_longer_than_the_memory(monkeypatch):
    monkeypatch.setattr(units, "TEXT_PART", 50)
    coder = units.UnitCoder(units.byte_level(public_tokenizers.path("byte_bpe_50k.json")), held=3)
    text = " ".join(f"word{i % 70} " + "x" * (i % 90) for i in range(300))
    LIBRARY.encode_special_tokens = False
    assert ids(coder, text) == LIBRARY.encode(text, add_special_tokens=False).ids
