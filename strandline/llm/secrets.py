"""Secrets: three known formats, and random strings that a tokenizer's vocabulary spells with few characters a token."""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator
from itertools import islice, takewhile

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.bpe import VOCABULARY, Coder, _coder, read_ranks
from strandline.llm.common import ready, table

KINDS = ("assign", "access", "hex", "random")
SHORTEST = 20  # characters of a run that may be a random string
RATIO = 1.9  # fewer characters a token than this: random
DIGESTS = (32, 40, 48, 56, 64, 96, 128)  # hexadecimal digits of common digests

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
# words joined by separators or capitals, with a number of up to four digits between them at most
_IDENTIFIER = re.compile(r"[A-Za-z]+([-_/+=]+[A-Za-z]+|[-_/+=]*[0-9]{1,4}(?![0-9]))*[-_/+=]*")
_NUMBER = re.compile(r"[0-9+/_=-]+")

Span = tuple[int, int, int]  # start, kind, end


def known_formats(text: str) -> list[Span]:
    """The spans of the three formats; each is looked for from left to right, and failing matches are dropped."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return spans


def is_known(run: str) -> bool:
    """Whether a run is a digest, an identifier or a number rather than a secret."""
    if _UUID.fullmatch(run) or _NUMBER.fullmatch(run) or _IDENTIFIER.fullmatch(run):
        return True
    return len(run) in DIGESTS and all(c in "0123456789abcdefABCDEF" for c in run)


def find(text: str | None, coder: Coder) -> tuple[list[Span], list[Span]]:
    """The spans of known formats, and of random strings beside them, each sorted by start and kind."""
    if not text:
        return [], []
    base, runs = known_formats(text), [(m.start(), m.end()) for m in _RUN.finditer(text)]
    for start, end in runs:
        if end - start >= 32:  # a run of hexadecimal digits lies within such a run
            base += [(m.start(), 2, m.end()) for m in _HEX.finditer(text, start, end) if m.end() - m.start() >= 32]
    base.sort()
    taken, added = [(start, end) for start, _, end in base], []
    at = 0
    for start, end in runs:
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if any(e > start for _, e in takewhile(lambda span: span[0] < end, islice(taken, at, None))):
            continue
        run = text[start:end].strip("+/_=-")
        if len(run) >= SHORTEST and not is_known(run) and len(run) < RATIO * len(coder.encode(run)):
            begin = start + text[start:end].index(run)
            added.append((begin, 3, begin + len(run)))
    return base, added


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = (), path: str | None = None) -> DataFrame:
    """The kept columns, n_assign, n_access, n_hex, base_sha256, spans and n_random.

    Whole texts are searched; positions count code points, ends are exclusive. A random string is a run of at
    least 20 letters, digits and +/_=- that has fewer than 1.9 characters a token under the vocabulary, is
    no digest, UUID, number or identifier, and touches no span of a known format. Null and empty texts have
    no spans. Repeated rows are searched each; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    ready(spark)
    pickled = pickle.dumps((read_ranks(path or public_tokenizers.path(VOCABULARY)), public_tokenizers.PATTERN))
    shared, token = spark.sparkContext.broadcast(pickled), hashlib.sha1(pickled).hexdigest()
    inner = docs.select(F.struct(*(keep or [F.lit(1).alias("one")])).alias("_kept"), F.col(text).cast("string").alias("_text"))
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(token, lambda: shared.value)
        for batch in batches:
            columns = [[] for _ in names]
            for value in batch.column(1).to_pylist():
                base, added = find(value, coder)
                kinds = [kind for _, kind, _ in base]
                found = (*(kinds.count(k) for k in range(3)), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + added)), len(added))
                for column, item in zip(columns, found):
                    column.append(item)
            kinds = [pa.int64()] * 3 + [pa.large_string()] * 2 + [pa.int64()]
            yield pa.record_batch([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["_kept", *names])

    schema = f"_kept {inner.schema['_kept'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    return inner.mapInArrow(run, schema).select(*(f"_kept.`{c}`" for c in keep), *names)


def op5_token_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in every document."""
    return scan(table(spark, sf_dir, "documents"), keep=("doc_id",))
