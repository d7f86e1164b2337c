"""Texts cut into units that tokenizers treat alone, and a memory of the tokens of distinct units.

A unit is a run of blanks and line feeds with the run of other characters after it. Neither byte-level BPE, whose
pattern begins a piece wherever white space follows a word, nor piece BPE without pieces that have a blank after
another character joins tokens across units, so a text's tokens are those of its units.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

UNITS_HELD = 300_000  # distinct units that a worker remembers, or those of one batch
UNIT_CHARS = 64  # longer units are not remembered
BATCH_BYTES = 16 << 20  # of texts whose distinct units are found at once
TEXT_PART = 1 << 20  # characters of a text that are cut into units at once

_UNIT = re.compile("[ \n]*[^ \n]+|[ \n]+")
# White space of other kinds may belong to one piece with the blanks beside it.
_OTHER_SPACE = re.compile(r"[^\S \n]")
_CUT = re.compile("[!-~](?=[ \n])")
# White space that a piece of a byte-level pattern may span: other than blanks and line feeds, three of these, or two at the end.
_MARK = "\x01"
_PUNCTUATED = r"([0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{17f}])([.,;:!?])"
_UNPLAIN = r"[\x01\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n]{3}|[ \n]{2}\z"


def text_pieces(text: str, size: int) -> Iterator[str]:
    """The text in pieces whose tokens, one after the other, are those of the whole; longer ones where nothing can be cut."""
    at = 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size - 1)):
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:]


def cut_units(piece: str) -> list[str]:
    """The units of a text; one without blanks, or with other white space, is cut only where that is safe."""
    return list(text_pieces(piece, 1)) if _OTHER_SPACE.search(piece) else _UNIT.findall(piece)


class UnitCoder:
    """Token ids of texts by any function from distinct units to their ids; units met lately are remembered."""

    def __init__(self, encode: Callable[[list[str]], Iterable[list[int]]], held: int = UNITS_HELD):
        self.encode, self.held = encode, held
        self.known: dict[str, bytes] = {}

    def each(self, units: list[str]) -> list[bytes]:
        """The ids of each unit as unsigned numbers of 32 bits."""
        found = list(map(self.known.get, units))
        if None in found:
            new = list(dict.fromkeys([unit for unit, ids in zip(units, found, strict=True) if ids is None]))
            fresh = dict(zip(new, (array("I", ids).tobytes() for ids in self.encode(new)), strict=True))
            found = [fresh[unit] if ids is None else ids for unit, ids in zip(units, found, strict=True)]
            if len(self.known) + len(fresh) > self.held:  # those of these texts alone are kept
                self.known = {unit: ids for unit, ids in zip(units, found, strict=True) if len(unit) <= UNIT_CHARS}
            else:
                self.known.update({unit: ids for unit, ids in fresh.items() if len(unit) <= UNIT_CHARS})
        return found

    def ids(self, text: str) -> Iterator[np.ndarray]:
        """The ids of a text, part by part."""
        for part in text_pieces(text, TEXT_PART):
            if part:
                yield np.frombuffer(b"".join(self.each(cut_units(part))), np.uint32)

    def ids_of_batch(self, texts: pa.Array) -> Iterator[Iterator[np.ndarray]]:
        """The ids of each text of a batch, part by part, for byte-level encoders."""
        cut = BatchUnits(texts)
        spelled = self.each(cut.units)
        sizes = np.array([len(ids) // 4 for ids in spelled], np.int64)
        every, at = np.frombuffer(b"".join(spelled), np.uint32), np.cumsum(sizes) - sizes
        k = 0
        for place, is_alone in enumerate(cut.alone):
            if is_alone:
                yield self.ids(texts[place].as_py())
            else:
                yield iter([every[gathered(at, sizes, cut.which[cut.starts[k] : cut.starts[k + 1]])]])
                k += 1


def gathered(at: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places of the runs `which`, one after the other, where run k has sizes[k] places from at[k]."""
    own = sizes[which]
    ends = np.cumsum(own)
    return np.repeat(at[which] - ends + own, own) + np.arange(ends[-1] if len(ends) else 0)


class BatchUnits:
    """The distinct units of a batch of texts, found by Arrow, and which of them each plain text has.

    Texts are cut before blanks and line feeds, and unless `spaced`, which is for piece tokenizers too, between a
    letter or digit and punctuation. `alone` marks those that must be cut by `cut_units` instead: with
    other white space, with runs of white space that tokenizers may take as one piece, or longer than a part; with
    `spaced`, each text has a blank put before it, and runs of blanks are such for piece tokenizers too.
    """

    def __init__(self, texts: pa.Array, spaced: bool = False):
        alone = pc.or_(pc.match_substring_regex(texts, _UNPLAIN + "|^ |  " if spaced else _UNPLAIN), pc.greater(pc.binary_length(texts), TEXT_PART))
        self.alone = alone.to_pylist()
        # a blank is put before each line feed, and one with a mark before punctuation after a word; they are left out
        # again when units are spelled
        plain = pc.replace_substring(texts.filter(pc.invert(alone)), "\n", " \n")
        if not spaced:
            plain = pc.replace_substring_regex(plain, _PUNCTUATED, "\\1 " + _MARK + "\\2")
        pieces = pc.split_pattern(plain, " ")
        ends = pieces.offsets.to_numpy()
        coded = pieces.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        self.starts = ends - ends[0]
        found = coded.dictionary
        blank, nothing = (pa.scalar(text, found.type) for text in (" ", ""))
        unmarked = pc.if_else(pc.starts_with(found, _MARK), pc.utf8_slice_codeunits(found, 1), pc.binary_join_element_wise(blank, found, nothing))
        self.units = pc.if_else(pc.starts_with(found, "\n"), found, unmarked).to_pylist()
        self.which = coded.indices.to_numpy().astype(np.int64)
        if not spaced:  # the first piece of a text has no blank before it
            first = self.starts[:-1]
            # and is no marked one, as a mark follows a word
            heads = coded.dictionary.take(pa.array(self.which[first])).to_pylist()
            self.which[first] = len(self.units) + np.arange(len(heads))
            self.units += heads


def larger_batches(batches: Iterator[pa.RecordBatch], size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about so many bytes, as the share of distinct units falls with the size."""
    held, n_bytes = [], 0
    for batch in batches:
        held.append(batch)
        n_bytes += batch.nbytes
        if n_bytes >= size:
            whole, held, n_bytes = pa.concat_batches(held), [], 0
            yield whole
    if held:
        yield pa.concat_batches(held)


def byte_level(path: str, plain: bool = False) -> Callable[[list[str]], Iterable[list[int]]]:
    """The tokenizers library's encoder of a file, without added special tokens; with `plain`, their strings are text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = plain
    return lambda units: (found.ids for found in library.encode_batch_fast(units, add_special_tokens=False))


def piece_level(path: str) -> Callable[[list[str]], Iterable[list[int]]]:
    """The sentencepiece library's encoder of a model, for units of a blank and a text.

    The model's own blank stands for a unit's first one; before a line feed it is taken away again.
    """
    library = SentencePieceProcessor(model_file=path)
    if any(_JOINED.search(library.id_to_piece(i)) for i in range(library.vocab_size())) or "".join(library.encode(_PROBE, out_type=str)) != _PROBED:
        raise ValueError(f"{path} has pieces that cross blanks, or changes white space; its texts cannot be cut into units")
    blank = library.piece_to_id("\u2581")

    def encode(units: list[str]) -> list[list[int]]:
        found = library.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        return [ids[u[0] != " " :] if u != " " else [blank] for u, ids in zip(units, found, strict=True)]

    return encode


_JOINED = re.compile("[^\u2581]\u2581|\n")
_PROBE, _PROBED = "a  b\n c ", "\u2581a\u2581\u2581b<0x0A>\u2581c\u2581"
