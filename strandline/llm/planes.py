"""Token ids in files of planes: blocks of ids transposed into byte or bit planes, each compressed by itself.

A stored corpus is a Parquet table written by Spark, so that it lies on any file system and survives lost
executors; its binary column holds the compressed planes, the others are the index of the chunks. A shard is
the part that one task writes; shards are numbered in ascending order of the documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import frugal, ready, table
from strandline.llm.units import UnitCoder, byte_level, larger_batches
from strandline.session import LANDED, work_path

VOCABULARY = "byte_bpe_50k.json"
END = 2  # the id that ends each document
CHUNK = 1 << 16  # ids in a chunk; the last one of a shard has fewer
LEVEL = 3  # of compression
PLANES = {"byte": 4, "bit": 32}

INDEX = "shard int, chunk int, first long, n_ids int, docs_before long, doc_ids array<long>, doc_starts array<int>, kind string"
STORED = f"{INDEX}, planes array<binary>"


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """Compressed planes of a block of ids, lowest first; planes of zeros are empty."""
    cells = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    rows = cells.T if kind == "byte" else np.packbits(np.unpackbits(cells, axis=1, bitorder="little").T, axis=1, bitorder="little")
    packer = zstandard.ZstdCompressor(level=LEVEL)
    return [packer.compress(row.tobytes()) if row.any() else b"" for row in rows]


def from_planes(planes: list[bytes], n_ids: int, kind: str = "byte") -> np.ndarray:
    """The ids of a block."""
    unpacker = zstandard.ZstdDecompressor()
    width = n_ids if kind == "byte" else (n_ids + 7) // 8
    rows = np.zeros((PLANES[kind], width), np.uint8)
    for row, plane in zip(rows, planes, strict=True):
        if plane:
            row[:] = np.frombuffer(unpacker.decompress(plane, max_output_size=width), np.uint8)
    cells = rows.T if kind == "byte" else np.packbits(np.unpackbits(rows, axis=1, count=n_ids, bitorder="little").T, axis=1, bitorder="little")
    return np.ascontiguousarray(cells).view("<u4").reshape(-1)


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32, in its reflected order of bits."""
    found = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            found ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return found


def join_crc32(parts: list[tuple[int, int]]) -> int:
    """The CRC-32 of joined byte strings, from (CRC-32, length) of each."""
    whole = parts[0][0] if parts else 0
    for crc, length in parts[1:]:
        shift, power = 1 << 31, 1 << 23  # x^0 and x^8
        while length:
            if length & 1:
                shift = _times(shift, power)
            power, length = _times(power, power), length >> 1
        whole = _times(shift, whole) ^ crc
    return whole


class _Shard:
    """Collects the ids of a shard and cuts them into chunks."""

    def __init__(self, kind: str, size: int):
        self.kind, self.size = kind, size
        self.shard = TaskContext.get().partitionId()
        self.chunk = self.first = self.docs = self.docs_before = self.held = 0
        self.parts: list[np.ndarray] = []
        self.doc_ids: list[int | None] = []
        self.doc_starts: list[int] = []  # counted in the shard

    def begin(self, doc_id: int | None) -> None:
        self.doc_ids.append(doc_id)
        self.doc_starts.append(self.first + self.held)

    def add(self, ids: np.ndarray) -> Iterator[tuple]:
        self.parts.append(ids)
        self.held += len(ids)
        if self.held >= self.size:
            held = np.concatenate(self.parts)
            for at in range(0, len(held) - self.size + 1, self.size):
                yield self._cut(held[at : at + self.size])
            self.parts = [held[len(held) // self.size * self.size :]]
            self.held = len(self.parts[0])

    def rest(self) -> Iterator[tuple]:
        if self.held:
            yield self._cut(np.concatenate(self.parts))

    def _cut(self, ids: np.ndarray) -> tuple:
        end = self.first + len(ids)
        n = sum(start < end for start in self.doc_starts)
        row = (self.shard, self.chunk, self.first, len(ids), self.docs_before, self.doc_ids[:n], [s - self.first for s in self.doc_starts[:n]],
               self.kind, to_planes(ids, self.kind))
        self.doc_ids, self.doc_starts, self.docs_before = self.doc_ids[n:], self.doc_starts[n:], self.docs_before + n
        self.first, self.chunk = end, self.chunk + 1
        return row


_FIELDS = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()), ("docs_before", pa.int64()),
                     ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int32())), ("kind", pa.large_string()), ("planes", pa.list_(pa.large_binary()))])


def _batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), fields.types, strict=True)], schema=fields)


_coders: dict[str, UnitCoder] = {}


def _coder(path: str) -> UnitCoder:
    """One for each worker process."""
    if path not in _coders:
        _coders.clear()
        _coders[path] = UnitCoder(byte_level(path))
    return _coders[path]


def write_ids(docs: DataFrame, path: str, kind: str = "byte", chunk: int = CHUNK, vocabulary: str | None = None, end: int = END) -> None:
    """Encode the whole `text` of each document, append the id `end`, and store all ids in ascending order of doc_id.

    Documents are dealt out by range, so that any number of rows of one doc_id, or of null ones, which come
    first, may span shards; rows of one doc_id are in the order of a hash of their text. Null texts count as
    empty and have the end alone. An empty table gives a table of no chunks. Other columns are left out. The
    library encodes each distinct unit that a worker meets (see units.py), and a task holds one chunk; a text
    without any blank is encoded whole.
    """
    if kind not in PLANES:
        raise ValueError(f"kind must be one of {', '.join(PLANES)}, found {kind}")
    ready(docs.sparkSession)
    place = vocabulary or public_tokenizers.path(VOCABULARY)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        coder, shard = _coder(place), _Shard(kind, chunk)
        for batch in larger_batches(batches):
            for doc_id, parts in zip(batch.column(0).to_pylist(), coder.ids_of_batch(batch.column(1)), strict=True):
                shard.begin(doc_id)
                for ids in parts:
                    for row in shard.add(ids):
                        yield _batch([row], _FIELDS)
                for row in shard.add(np.array([end], np.uint32)):
                    yield _batch([row], _FIELDS)
        for row in shard.rest():
            yield _batch([row], _FIELDS)

    dealt.mapInArrow(run, STORED).write.option("compression", "none").parquet(path)


def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """The chunks without their planes, and `start`, the number of ids of the whole corpus before each."""
    return _placed(spark.read.schema(INDEX).parquet(path), spark, path)


def _placed(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Rows with `shard` and `first`, with the ids of all before them as `start`; there is one total for each shard."""
    totals = spark.read.schema(INDEX).parquet(path).groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    before = totals.select("shard", (F.sum("_ids").over(Window.orderBy("shard")) - F.col("_ids")).alias("_before"))
    return rows.join(before, "shard").withColumn("start", F.col("_before") + F.col("first")).drop("_before")


def read_span(spark: SparkSession, path: str, start: int, n_ids: int) -> DataFrame:
    """start and `ids` of the chunks that hold the ids [start, start + n_ids), cut to them; other planes are not opened."""
    end = start + n_ids
    chunks = _placed(spark.read.schema(STORED).parquet(path), spark, path)
    wanted = chunks.filter((F.col("start") < end) & (F.col("start") + F.col("n_ids") > start)).select("start", "n_ids", "kind", "planes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes(row["planes"], row["n_ids"], row["kind"])
                low, high = max(start - row["start"], 0), min(end - row["start"], row["n_ids"])
                yield pa.record_batch([pa.array([row["start"] + low]), pa.array([ids[low:high].astype(np.int64)], pa.list_(pa.int64()))], ["start", "ids"])

    return wanted.mapInArrow(run, "start long, ids array<long>")


_PART = "shard int, doc long, chunk int, doc_id long, first long, n_tokens long, ids_crc32 long"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each chunk has of each document: its number in the shard, place, ids and their CRC-32."""
    fields = pa.schema([("shard", pa.int32()), ("doc", pa.int64()), ("chunk", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        for row in batch.to_pylist():
            raw = from_planes(row["planes"], row["n_ids"], row["kind"]).astype("<u4").tobytes()
            starts, doc_ids = row["doc_starts"], row["doc_ids"]
            if not starts or starts[0]:  # goes on with a document of the chunk before
                starts, doc_ids, number = [0, *starts], [None, *doc_ids], row["docs_before"] - 1
            else:
                number = row["docs_before"]
            found = [
                (row["shard"], number + k, row["chunk"], doc_ids[k], row["first"] + a, b - a, zlib.crc32(raw[4 * a : 4 * b]))
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], row["n_ids"]], strict=True))
            ]
            yield _batch(found, fields)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = [join_crc32([(p["ids_crc32"], 4 * p["n_tokens"]) for p in parts]) for parts in batch.column(3).to_pylist()]
        yield pa.record_batch([*(batch.column(i) for i in range(3)), pa.array([sum(p["n_tokens"] for p in x) for x in batch.column(3).to_pylist()], pa.int64()),
                               pa.array(whole, pa.int64())], ["shard", "doc_id", "first", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every stored document, from the ids in the planes.

    Each chunk is opened once and its part of each document summed up by itself, so that only counts and
    checksums meet, and of a document of any length one for each of its chunks.
    """
    ready(spark)
    parts = spark.read.schema(STORED).parquet(path).mapInArrow(_parts, _PART)
    gathered = (parts.groupBy("shard", "doc")
                .agg(F.max("doc_id").alias("doc_id"), F.min("first").alias("first"), F.sort_array(F.collect_list(F.struct("chunk", "n_tokens", "ids_crc32"))).alias("parts"))
                .select("shard", "doc_id", "first", "parts"))
    rows = gathered.mapInArrow(_joined, "shard int, doc_id long, first long, n_tokens long, ids_crc32 long")
    return _placed(rows, spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the files written."""
    path = work_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path)
    LANDED.append(path)
    return read_documents(spark, path)
