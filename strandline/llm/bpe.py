"""Byte-level BPE: ranked merges folded over the bytes of distinct words, and decoding by concatenation.

The merges are folded in the workers, over the distinct words of each task, not by Spark's higher-order
functions: see the README for the figures that ruled those out.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import pickle
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import frugal, ready, table

VOCABULARY = "byte_bpe_50k.tiktoken"
WORDS_HELD = 200_000  # distinct words whose ids a worker remembers before it starts anew
WORD_BYTES = 200  # longer words are not remembered


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of byte strings, from lines of a base64 string and a number."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word: neighbours whose joined bytes have the least rank merge first, the leftmost of equals."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > 64:
        return _merge_long(word, ranks)
    pieces = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, _NONE) for a, b in zip(pieces, pieces[1:])]
    while pairs:
        least = min(pairs)
        if least == _NONE:
            break
        at = pairs.index(least)
        pieces[at : at + 2] = [pieces[at] + pieces[at + 1]]
        del pairs[at]
        if at:
            pairs[at - 1] = ranks.get(pieces[at - 1] + pieces[at], _NONE)
        if at < len(pairs):
            pairs[at] = ranks.get(pieces[at] + pieces[at + 1], _NONE)
    return [ranks[piece] for piece in pieces]


_NONE = 1 << 60


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of pairs, so that a long run costs its length times a logarithm."""
    n = len(word)
    ends, before, heap = [*range(1, n + 1)], [*range(-1, n - 1)], []
    alive = [True] * n

    def push(at: int) -> None:
        follower = ends[at]
        if follower < n:
            rank = ranks.get(word[at : ends[follower]])
            if rank is not None:
                heapq.heappush(heap, (rank, at, ends[follower]))

    for at in range(n - 1):
        push(at)
    while heap:
        _, at, end = heapq.heappop(heap)
        follower = ends[at]
        if not alive[at] or follower >= n or ends[follower] != end:
            continue
        alive[follower], ends[at] = False, end
        if end < n:
            before[end] = at
        push(at)
        if before[at] >= 0:
            push(before[at])
    found, at = [], 0
    while at < n:
        found.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return found


class Coder:
    """Encodes and decodes texts by one table of ranks, remembering the distinct words met."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split, self.words = ranks, regex.compile(pattern), {}
        self.pieces = {rank: piece for piece, rank in ranks.items()}

    def encode_packed(self, text: str) -> bytes:
        """The ids of a text as unsigned numbers of 32 bits, in the machine's order of bytes."""
        ids, words = [], self.words
        for match in self.split.finditer(text):
            word = match.group()
            known = words.get(word)
            if known is None:
                raw = word.encode("utf-8", "surrogatepass")
                known = array("I", merge(raw, self.ranks)).tobytes()
                if len(raw) <= WORD_BYTES:
                    if len(words) >= WORDS_HELD:
                        words.clear()
                    words[word] = known
            ids.append(known)
        return b"".join(ids)

    def encode(self, text: str) -> list[int]:
        return array("I", self.encode_packed(text)).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.pieces[i] for i in ids])


_coders: dict[str, Coder] = {}


def _coder(token: str, pickled: Callable[[], bytes]) -> Coder:
    """One coder for each worker process and vocabulary."""
    if token not in _coders:
        _coders.clear()
        _coders[token] = Coder(*pickle.loads(pickled()))
    return _coders[token]


def _over_batches(rows: DataFrame, column: str, kept: list[str], names: list[str], kinds: str, path: str, work: Callable) -> DataFrame:
    """Apply `work(coder, values)` to a column, batch by batch, keeping other columns."""
    spark = rows.sparkSession
    ready(spark)
    pickled = pickle.dumps((read_ranks(path), public_tokenizers.PATTERN))
    shared, token = spark.sparkContext.broadcast(pickled), hashlib.sha1(pickled).hexdigest()
    inner = rows.select(F.struct(*(kept or [F.lit(1).alias("one")])).alias("_kept"), F.col(column).alias("_in"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        coder = _coder(token, lambda: shared.value)
        for batch in batches:
            yield pa.record_batch([batch.column(0), *work(coder, batch.column(1).to_pylist())], ["_kept", *names])

    schema = f"_kept {inner.schema['_kept'].dataType.simpleString()}, {kinds}"
    return inner.mapInArrow(run, schema).select(*(f"_kept.`{c}`" for c in kept), *names)


def encode(rows: DataFrame, text: str = "text", keep: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """The kept columns and `ids`, an array of token ids of each whole text.

    Text is cut by the tokenizer's pattern; each piece is merged by itself; there are no special tokens.
    Null and empty texts have no ids. Repeated rows are encoded each; an empty table gives an empty table.
    """
    return _over_batches(rows, text, list(keep), ["ids"], "ids array<int>", path or public_tokenizers.path(VOCABULARY), _encode)


def decode(rows: DataFrame, ids: str = "ids", keep: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """The kept columns and `decoded`, the joined bytes of each array of ids; null ids give no bytes. An id
    that the vocabulary lacks is an error."""
    return _over_batches(rows, ids, list(keep), ["decoded"], "decoded binary", path or public_tokenizers.path(VOCABULARY), _decode)


def _encode(coder: Coder, texts: list[str | None]) -> list[pa.Array]:
    packed = [coder.encode_packed(text or "") for text in texts]
    ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
    return [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))]


def _decode(coder: Coder, arrays: list[list[int] | None]) -> list[pa.Array]:
    return [pa.array([coder.decode(ids or []) for ids in arrays], pa.large_binary())]


def _digests(coder: Coder, texts: list[str | None]) -> list[pa.Array]:
    counts, of_ids, of_bytes = [], [], []
    for text in texts:
        packed = array("I", coder.encode_packed(text or ""))
        ids = packed.tolist()
        counts.append(len(ids))
        if sys.byteorder == "big":
            packed.byteswap()
        of_ids.append(hashlib.sha256(packed).hexdigest())
        of_bytes.append(hashlib.sha256(coder.decode(ids)).hexdigest())
    return [pa.array(counts, pa.int64()), pa.array(of_ids, pa.large_string()), pa.array(of_bytes, pa.large_string())]


def digests(rows: DataFrame, text: str = "text", keep: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """The kept columns, n_tokens, and the digests of the ids (little-endian, 32 bits each) and of the bytes
    decoded from them, in one pass; nulls and empty texts as in encode."""
    return _over_batches(
        rows, text, list(keep), ["n_tokens", "ids_sha256", "decoded_sha256"], "n_tokens long, ids_sha256 string, decoded_sha256 string",
        path or public_tokenizers.path(VOCABULARY), _digests)


def _round_trip(coder: Coder, texts: list[str | None]) -> list[pa.Array]:
    [ids] = _encode(coder, texts)
    digests = [hashlib.sha256(coder.decode(own)).hexdigest() for own in ids.to_pylist()]
    return [ids, pa.array(digests, pa.large_string())]


def round_trip(rows: DataFrame, text: str = "text", keep: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """The kept columns, ids as from encode, and decoded_sha256, the digest of the bytes that decode makes of them;
    in one pass, as two would hold a second worker for each task."""
    return _over_batches(
        rows, text, list(keep), ["ids", "decoded_sha256"], "ids array<int>, decoded_sha256 string", path or public_tokenizers.path(VOCABULARY), _round_trip)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    return digests(table(spark, sf_dir, "documents"), keep=("doc_id",))
