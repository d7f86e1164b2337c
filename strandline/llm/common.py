"""Row keys, reading, batches of text and a fixed-size filter of keys: what the operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.session import land, ship

# Characters handled at once by the vectorised passes; bounds a worker's memory whatever the texts' lengths.
BLOCK = 1 << 20
# The key of a row: its file and its place there.
KEY = ("_f", "_r")


def ready(spark: SparkSession) -> None:
    """Ship the package and keep the batches that reach Python workers small, since rows hold whole texts."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def frugal() -> None:
    """Let a worker give freed memory back to the system, as workers are used again by later stages."""
    if pa.default_memory_pool().backend_name != "system":
        pa.set_memory_pool(pa.system_memory_pool())
    if hasattr(library := ctypes.CDLL(None), "malloc_trim"):
        library.malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame) -> DataFrame:
    """The rows as they lie in Parquet files: as given if they come straight from there, or else written to the
    shared folder."""
    try:
        rows.select(rows.metadataColumn("_metadata")["row_index"]).schema  # noqa: B018  analysed here
        return rows
    except AnalysisException:
        return land(rows, "rows")


def keyed(rows: DataFrame, *columns: str | Column) -> DataFrame:
    """The columns, and a key (_f, _r) of each of the stored rows: a hash of its file's path and its place there.

    The key stays the same however often and by whatever split the files are scanned.
    """
    meta = rows.metadataColumn("_metadata")
    return rows.select(F.xxhash64(meta["file_path"]).alias("_f"), meta["row_index"].alias("_r"), *columns)


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents kept from learning."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def blocks(texts: list[str | None], size: int = BLOCK) -> Iterator[tuple[list[int], list[str]]]:
    """Runs of (places, pieces) of at most about `size` characters together; longer texts come in pieces."""
    places, pieces, room = [], [], size
    for place, text in enumerate(texts):
        for start in range(0, len(text or ""), size):
            piece = text[start : start + size]
            if pieces and len(piece) > room:
                yield places, pieces
                places, pieces, room = [], [], size
            places.append(place)
            pieces.append(piece)
            room -= len(piece)
    if pieces:
        yield places, pieces


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finishing steps of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int = 0) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


def key_filter(keys: DataFrame, column: str, words: int = 1 << 20) -> DataFrame:
    """A Bloom filter of fixed size over 64-bit keys, as at most `words` rows of 64 bits, to broadcast.

    It only thins out what must be shuffled, and an exact join follows; with more keys than it is made
    for, it thins out less.
    """
    spot = F.xxhash64(column).bitwiseAND(words * 64 - 1)
    return (keys.select(spot.alias("_spot")).groupBy(F.shiftright("_spot", 6).alias("_word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(_spot & 63 as int))")).alias("_bits")))


def maybe_in(rows: DataFrame, column: str, bits: DataFrame, words: int = 1 << 20) -> DataFrame:
    """The rows whose key may be in the filter."""
    spot = F.xxhash64(column).bitwiseAND(words * 64 - 1)
    found = rows.withColumn("_spot", spot).withColumn("_word", F.shiftright("_spot", 6)).join(F.broadcast(bits), "_word")
    return found.filter(F.expr("(shiftright(_bits, cast(_spot & 63 as int)) & 1) = 1")).drop("_word", "_bits", "_spot")


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a simple DDL string."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.large_string(), "binary": pa.large_binary(),
             "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.strip().split(" ", 1) for field in ddl.split(","))])
