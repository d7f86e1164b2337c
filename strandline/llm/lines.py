"""Fuzzy line dedup: character-shingle MinHash, banding, exact Jaccard, and one line kept of each component."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import BLOCK, KEY, arrow_schema, blocks, code_points, frugal, key_filter, keyed, maybe_in, mix, ready, seeds, stored, table
from strandline.llm.components import key_pairs, linked
from strandline.session import land

WIDTH = 8  # characters of a shingle
BANDS, ROWS = 10, 4  # at a Jaccard similarity of 0.8 a pair meets in some band with a probability of 0.995
THRESHOLD = 0.8
BLANKS = " \t\r\f\v\u00a0"  # what lines are trimmed of
SIGNED = 2000  # lines signed at once

_FACTORS = seeds(61)
_SIGNED = "_f long, _r long, _id long, _line int, _a long, _b long, _keys array<long>"
_NAMED = "id long, _text string"


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """A 64-bit hash for each run of `width` characters; of a shorter text, one for the whole of it."""
    points = code_points(text).astype(np.uint64)
    size = min(width, len(points))
    total = np.zeros(max(0, len(points) - size + 1), np.uint64)
    for step, factor in enumerate(seeds(size)):
        total += points[step : len(total) + step] * factor
    return mix(total)


def line_shingles(lines: list[str], width: int = WIDTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, hashes) of the shingles of many lines, in blocks that fit the cache; places index the lines."""
    overlap = width - 1
    for places, pieces in blocks(lines, 1 << 15):
        # one array for all pieces; shingles that straddle two pieces are left out
        joined = shingles("".join(pieces), width)
        sizes = np.array([len(piece) for piece in pieces])
        owner = np.repeat(np.array(places), sizes)[: len(joined)]
        inside = np.arange(len(joined)) + overlap < np.repeat(np.cumsum(sizes), sizes)[: len(joined)]
        yield owner[inside], joined[inside]
    for place, line in enumerate(lines):
        if len(line) < width or len(line) > 1 << 15:  # shorter than a shingle, or in pieces
            own = np.concatenate([shingles(line[at : at + BLOCK + overlap], width) for at in range(0, max(1, len(line) - overlap), BLOCK)])
            yield np.full(len(own), place), own


def band_keys(lines: list[str], width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """The band keys of each line: one permutation of its shingles dealt to bands x rows bins, least of each bin.

    A bin without a shingle takes the next filled one's value, changed by the distance.
    """
    bins = bands * rows
    least = np.full(len(lines) * bins, np.iinfo(np.uint64).max, np.uint64)
    for owner, values in line_shingles(lines, width):
        np.minimum.at(least, owner * bins + ((values >> np.uint64(40)) * np.uint64(bins) >> np.uint64(24)).astype(np.int64), values)
    grid = least.reshape(len(lines), bins)
    empty = grid == np.iinfo(np.uint64).max
    filled = grid.copy()
    for step in range(1, bins):
        if not empty.any():
            break
        other = np.roll(grid, -step, axis=1)
        take = empty & (other != np.iinfo(np.uint64).max)
        filled[take] = other[take] + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64)
        empty &= ~take
    keys = np.zeros((len(lines), bands), np.uint64)
    for row, factor in enumerate(seeds(rows, 7)):
        keys += filled[:, row::rows][:, :bands] * factor
    return mix(keys + seeds(bands, 11)[None, :])


def shingle_sets(lines: list[str]) -> list[np.ndarray]:
    """The distinct shingles of each line, sorted."""
    found: list[list[np.ndarray]] = [[] for _ in lines]
    for owner, values in line_shingles(lines):
        starts = np.flatnonzero(np.diff(owner, prepend=-1)).tolist()  # the shingles of a line lie together
        for start, end in zip(starts, [*starts[1:], len(owner)]):
            found[owner[start]].append(values[start:end])
    sets = []
    for parts in found:
        values = np.sort(np.concatenate(parts))
        fresh = np.ones(len(values), bool)
        np.not_equal(values[1:], values[:-1], out=fresh[1:])
        sets.append(values[fresh])
    return sets


def shared(left: np.ndarray, right: np.ndarray) -> int:
    """How many values two sorted arrays without repeats have in common."""
    small, large = sorted((left, right), key=len)
    spots = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int(np.count_nonzero(large[spots] == small))


def line_names(lines: list[str]) -> np.ndarray:
    """Two 64-bit hashes of each line."""
    digests = b"".join(blake2b(line.encode("utf-8", "surrogatepass"), digest_size=16).digest() for line in lines)
    return np.frombuffer(digests, "<i8").reshape(-1, 2)


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(places, numbers, lines) of the lines that aren't blank: the place of their text, their number there, and they trimmed."""
    parts = pc.split_pattern(texts, "\n")
    sizes = pc.list_value_length(parts).fill_null(0).to_numpy(zero_copy_only=False)
    places = np.repeat(np.arange(len(texts)), sizes)
    numbers = np.arange(len(places)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    trimmed = pc.utf8_trim(parts.flatten(), characters=BLANKS)
    filled = pc.not_equal(trimmed, "")
    inside = filled.to_numpy(zero_copy_only=False)
    return places[inside], numbers[inside], trimmed.filter(filled)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frugal()
    schema = arrow_schema(_SIGNED)
    for batch in batches:
        places, numbers, lines = _lines(batch.column("_text"))
        known: set[int] = set()  # copies within a batch need no second signature
        for start in range(0, len(lines), SIGNED):
            some = lines.slice(start, SIGNED).to_pylist()
            names = line_names(some)
            fresh = [not (name in known or known.add(name)) for name in names[:, 0].tolist()]
            keys = band_keys([line for line, new in zip(some, fresh) if new]).view(np.int64)
            nested = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(np.array(fresh) * BANDS)]).astype(np.int32), pa.array(keys.ravel()))
            at = pa.array(places[start : start + SIGNED])
            columns = [batch.column(name).take(at) for name in ("_f", "_r", "_id")]
            yield pa.record_batch([*columns, pa.array(numbers[start : start + SIGNED], pa.int32()), *(pa.array(x) for x in names.T.copy()), nested], schema=schema)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frugal()
    for batch in batches:
        _, _, lines = _lines(batch.column("_text"))
        for start in range(0, len(lines), SIGNED):
            some = lines.slice(start, SIGNED)
            yield pa.record_batch([pa.array(line_names(some.to_pylist())[:, 0].copy()), some], schema=arrow_schema(_NAMED))


def _similar(pairs: list[tuple[str, str]]) -> list[bool]:
    names = {text: place for place, text in enumerate(dict.fromkeys(text for pair in pairs for text in pair))}
    sets, found = shingle_sets(list(names)), []
    for left, right in pairs:
        one, other = sets[names[left]], sets[names[right]]
        both = len(one) + len(other)
        # of sets that differ too much in size no more than the smaller can be shared
        plausible = (1 + THRESHOLD) * min(len(one), len(other)) >= THRESHOLD * both
        n = shared(one, other) if plausible else 0
        found.append(plausible and n >= THRESHOLD * (both - n))
    return found


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frugal()
    for batch in batches:
        keep: list[bool] = []
        held: list[tuple[str, str]] = []
        room = 1 << 17  # characters whose shingles are sorted at once, so that long lines take little memory
        for pair in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist()):
            held.append(pair)
            room -= len(pair[0]) + len(pair[1])
            if room <= 0:
                keep += _similar(held)
                held, room = [], 1 << 17
        if held:
            keep += _similar(held)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def duplicate_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_f, _r, _lines): for each row that loses lines, their numbers. See dedup_lines."""
    spark = docs.sparkSession
    ready(spark)
    whole = F.make_valid_utf8(F.col(text)).alias("_text")
    # a row for each line that isn't blank, with its row's key, its number, two hashes of it trimmed, and its band keys
    signed = land(keyed(docs, F.col(doc_id).cast("long").alias("_id"), whole).mapInArrow(_sign, _SIGNED), "lines")
    # near copies: verified pairs of different lines
    buckets = signed.select(F.explode("_keys").alias("bucket"), F.col("_a").alias("id"))
    pairs = land(key_pairs(signed.select("_keys", F.col("_a").alias("id")), BANDS * signed.count()), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = maybe_in(docs.select(whole).mapInArrow(_named, _NAMED), "id", key_filter(wanted, "id"))
    # an inner join: a semi join would be moved below the filter, and all lines shuffled
    texts = land(texts.join(wanted, "id").groupBy("id").agg(F.min("_text").alias("t")), "texts")

    def sides(some: DataFrame, left: str = "ref", right: str = "id") -> DataFrame:
        both = some.join(texts.select(F.col("id").alias(right), F.col("t").alias("right")), right)
        return both.join(texts.select(F.col("id").alias(left), F.col("t").alias("left")), left).select(*some.columns, "left", "right")

    def alike(some: DataFrame) -> DataFrame:
        return sides(some.select("a", "b"), "a", "b").mapInArrow(_verify, "a long, b long")

    roots = linked(buckets, pairs, alike, sides, shingle_sets)
    # exact copies by both hashes, then the components; the least (document, row, line) of each stays
    place = F.struct(F.col("_id").isNull().alias("n"), "_id", *KEY, "_line")
    exact = signed.groupBy("_a", "_b").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    grouped = land(exact.join(roots.select(F.col("id").alias("_a"), "root"), "_a", "left").filter("n > 1 or root is not null"), "copies")
    # a table of its own, so that the join below may split a large component
    best = land(grouped.filter("root is not null").groupBy("root").agg(F.min("first").alias("best")), "best")
    keep = land(grouped.join(best, "root", "left").select("_a", "_b", F.coalesce("best", "first").alias("keep")), "keep")
    gone = signed.select(*KEY, "_line", "_a", "_b").join(keep, ["_a", "_b"]).filter(
        (F.col("_f") != F.col("keep._f")) | (F.col("_r") != F.col("keep._r")) | (F.col("_line") != F.col("keep._line")))
    return gone.groupBy(*KEY).agg(F.collect_set("_line").alias("_lines"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_row, _text, _n_lines, _n_gone), one row for each row; _row is a struct of the columns but the text.

    Lines are what newlines separate, trimmed. Blank lines are never removed. Two lines are copies if
    trimmed alike, near copies if the Jaccard similarity of their sets of 8-character shingles is 0.8 or
    more (a shorter line is one shingle). Of each component of copies and near copies, the line of the
    least document stays (null document ids last, then the place in the files, then the line's number),
    and the others are cut out of their texts. A null text stays null and has no line; an empty text has
    one blank line. Repeated rows are documents of their own: the first keeps its lines. Other columns,
    whatever their names, stay as they are. An empty table gives an empty table.
    """
    docs = stored(docs)
    gone = duplicate_lines(docs, doc_id, text)
    # the texts cross the join as arrays of lines, so that they are split once
    rows = keyed(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text)).alias("_row"), F.split(F.col(text), "\n").alias("_parts"))
    joined = rows.join(gone, list(KEY), "left")
    n_lines = F.when(F.col("_parts").isNotNull(), F.size("_parts")).otherwise(0)
    stay = F.array_except(F.sequence(F.lit(0), n_lines - 1), "_lines")
    return joined.select(
        "_row", n_lines.cast("long").alias("_n_lines"),
        F.when(F.col("_lines").isNotNull(), F.size("_lines")).otherwise(0).cast("long").alias("_n_gone"),
        F.array_join(F.when(F.col("_lines").isNull(), F.col("_parts")).otherwise(
            F.transform(stay, lambda i: F.get(F.col("_parts"), i))), "\n").alias("_text"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_gone, and the text without the lines that others stand for."""
    rows = dedup_lines(table(spark, sf_dir, "documents"))
    return rows.select(F.col("_row.doc_id").alias("doc_id"), F.col("_n_lines").alias("n_lines"), F.col("_n_gone").alias("n_gone"), F.col("_text").alias("text"))
