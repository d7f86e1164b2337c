"""Near-duplicate documents by order MinHash, candidates verified by banded alignment, classes by union-find."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import KEY, arrow_schema, blocks, code_points, frugal, key_filter, keyed, maybe_in, mix, ready, seeds, stored, table
from strandline.llm.components import key_pairs, linked
from strandline.session import land

WORDS = 5  # words of a shingle
THRESHOLD = 0.8
PICKED = 2  # least occurrence-labelled shingles of a sketch, kept in text order
BANDS, ROWS = 16, 2  # at a similarity of 0.8 a pair meets in some band with a probability of 0.9998

_SIGNED = "_f long, _r long, _id long, _a long, _b long, _n long, _keys array<long>"


@lru_cache(1)
def _word_characters() -> np.ndarray:
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


@lru_cache(1)
def _powers() -> np.ndarray:
    return mix(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word (run of letters and digits) of a lower-cased text."""
    found = []
    at = 0
    while at < len(text):  # in blocks that end between words, so memory stays small for very long texts
        end = min(len(text), at + (1 << 20))
        while end < len(text) and text[end - 1].isalnum() and text[end].isalnum():
            end += 1
        found.append(_hash_block(text[at:end]))
        at = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _hash_block(text: str) -> np.ndarray:
    points = code_points(text.lower())
    inside = _word_characters()[points]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    places = np.flatnonzero(inside)
    offset = places - np.repeat(starts, ends - starts)
    terms = (points[places].astype(np.uint64) + np.uint64(1)) * _powers()[offset & 4095]
    sizes = ends - starts
    return mix(np.add.reduceat(terms, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))


def labelled_shingles(words: np.ndarray) -> np.ndarray:
    """A hash for each run of five words and the number of times it stood before; of a shorter text, one for
    the whole of it; none for a text without words."""
    size = min(WORDS, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for step, factor in enumerate(seeds(size, size)):
        total += words[step : step + len(total)] * factor
    total = mix(total)
    order = np.argsort(total, kind="stable")
    ranked = total[order]
    fresh = np.ones(len(total), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    if fresh.all():
        return total
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(total)), 0))
    times = np.empty(len(total), np.uint64)
    times[order] = (np.arange(len(total)) - first).astype(np.uint64)
    return np.where(times == 0, total, mix(total + times * np.uint64(0x632BE59BD9B4E019)))


def sketches(documents: list[np.ndarray], count: int = BANDS * ROWS) -> np.ndarray:
    """Order MinHash: for each document and permutation, the hash of its two least shingles in text order."""
    sizes = np.array([len(d) for d in documents])
    flat, starts = np.concatenate(documents), np.cumsum(sizes) - sizes
    owner, found = np.repeat(np.arange(len(sizes)), sizes), np.empty((len(sizes), count), np.uint64)
    top = np.uint64(np.iinfo(np.uint64).max)
    for k, seed in enumerate(seeds(count, 3)):
        values = mix(flat ^ seed)
        spots = []
        for _ in range(PICKED):
            least = np.minimum.reduceat(values, starts)
            hits = np.flatnonzero(values == least[owner])
            spot = hits[np.searchsorted(hits, starts)]  # of equals, the first in the document
            spots.append(spot)
            values[spot] = top
        ordered = np.sort(np.stack(spots), axis=0)
        total = np.zeros(len(sizes), np.uint64)
        for row, factor in zip(ordered, seeds(PICKED, 5)):
            total += flat[row] * factor
        found[:, k] = mix(total)
    return found


def band_keys(documents: list[np.ndarray]) -> np.ndarray:
    grid = sketches(documents)
    keys = np.zeros((len(documents), BANDS), np.uint64)
    for row, factor in enumerate(seeds(ROWS, 7)):
        keys += grid[:, row::ROWS] * factor
    return mix(keys + seeds(BANDS, 13)[None, :])


def aligned(left: np.ndarray, right: np.ndarray) -> int:
    """The longest common subsequence of two sequences without repeats, as far as a similarity of 0.8 allows.

    An alignment of that similarity shifts no shingle by more than the shingles it leaves out, so only
    matches within that band of the diagonal count.
    """
    need = int(np.ceil(THRESHOLD / (1 + THRESHOLD) * (len(left) + len(right)) - 1e-9))
    band = max(len(left), len(right)) - need
    if band < 0:
        return 0
    _, at, to = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    order = np.argsort(at)
    at, to = at[order], to[order]
    near = np.abs(at - to) <= band
    to = to[near]
    if len(to) < need:
        return 0
    if (np.diff(to) > 0).all():
        return len(to)
    tails: list[int] = []
    for place in to.tolist():
        spot = bisect_left(tails, place)
        if spot == len(tails):
            tails.append(place)
        else:
            tails[spot] = place
    return len(tails)


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether the shingles that an alignment shares make up 0.8 or more of all shingles of both."""
    shared = aligned(left, right)
    return shared > 0 and shared >= THRESHOLD * (len(left) + len(right) - shared)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frugal()
    for batch in batches:
        texts = batch.column("_text").to_pylist()
        n, keys = np.zeros(len(texts), np.int64), np.zeros((len(texts), BANDS), np.uint64)
        names = np.zeros((2, len(texts)), np.uint64)
        places, held, room = [], [], 1 << 18
        for place, text in enumerate(texts):
            words = word_hashes(text or "")
            n[place] = len(words)
            if not len(words):
                continue
            spread = np.arange(1, len(words) + 1, dtype=np.uint64)
            for row, factor in enumerate(seeds(2, 17)):
                names[row, place] = np.bitwise_xor.reduce(mix(words + spread * factor))
            places.append(place)
            held.append(labelled_shingles(words))
            room -= len(held[-1])
            if room <= 0:
                keys[places] = band_keys(held)
                places, held, room = [], [], 1 << 18
        if held:
            keys[places] = band_keys(held)
        nested = pa.ListArray.from_arrays(
            np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))]).astype(np.int32), pa.array(keys[n > 0].ravel().view(np.int64)))
        columns = [batch.column(name) for name in ("_f", "_r", "_id")]
        yield pa.record_batch([*columns, *(pa.array(row.view(np.int64)) for row in names), pa.array(n), nested], schema=arrow_schema(_SIGNED))


def shingle_sets(texts: list[str]) -> Iterator[np.ndarray]:
    """The labelled shingles of each text, none twice; an alignment shares no more than the sets do."""
    return (labelled_shingles(word_hashes(text)) for text in texts)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frugal()
    last = (None, None)
    for batch in batches:
        kept = []
        for a, b, left, right in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if last[0] != a:
                last = (a, labelled_shingles(word_hashes(left)))
            if similar(last[1], labelled_shingles(word_hashes(right))):
                kept.append((a, b))
        yield pa.record_batch([pa.array([x[i] for x in kept], pa.int64()) for i in (0, 1)], ["a", "b"])


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_f, _r, _id, _class, _size, _first): for each row its class, the rows in it, and whether it stays.

    Words are runs of letters and digits, lower-cased. Texts with the same words are copies. Two others are
    near copies if an alignment of their five-word shingles (labelled by occurrence; a text of fewer words
    is one shingle) shares 0.8 or more of all shingles of both. Classes are the connected components; a text
    without words, a null or an empty one, is a class of its own. _class is the least document id (null if
    the class has none but null). The row of the least id, then of the least key, stays. Repeated rows are
    rows of one class. Candidates are found by order MinHash: two shingles of least hash in text order, 16
    bands of two sketches. Other columns are not looked at; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    ready(spark)
    docs = stored(docs)
    texts = keyed(docs, F.col(doc_id).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    signed = land(texts.mapInArrow(_sign, _SIGNED), "signed")
    # one row for all copies of a text
    distinct = signed.filter("_n > 0").groupBy("_a", "_b").agg(F.first("_keys").alias("_keys"))
    keys = land(distinct.select(F.col("_a").alias("id"), "_keys"), "keys")
    buckets = keys.select(F.explode("_keys").alias("bucket"), "id")
    pairs = land(key_pairs(keys.select("_keys", "id"), BANDS * keys.count()), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    # the text of one row for each wanted id
    chosen = signed.filter("_n > 0").groupBy(F.col("_a").alias("id")).agg(F.min(F.struct(*KEY)).alias("k"), F.max("_n").alias("_n"))
    chosen = land(chosen.join(wanted, "id", "left_semi").select("id", F.col("k._f").alias("_f"), F.col("k._r").alias("_r"), F.greatest(F.lit(1), F.col("_n") - (WORDS - 1)).alias("n")), "chosen")
    thin = maybe_in(texts.withColumn("_spotted", F.xxhash64(*KEY)), "_spotted", key_filter(chosen.select(F.xxhash64(*KEY).alias("k")), "k"))
    found = land(thin.join(chosen, list(KEY)).select("id", F.col("_text").alias("t")), "texts")

    def sides(some: DataFrame, left: str = "ref", right: str = "id") -> DataFrame:
        both = some.join(found.select(F.col("id").alias(right), F.col("t").alias("right")), right)
        return both.join(found.select(F.col("id").alias(left), F.col("t").alias("left")), left).select(*some.columns, "left", "right")

    def alike(some: DataFrame) -> DataFrame:
        # of texts that differ too much in shingles no more than those of the smaller can be shared
        for side in ("a", "b"):
            some = some.join(chosen.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}")), side)
        some = some.filter(F.least("n_a", "n_b") >= (THRESHOLD - 1e-9) * F.greatest("n_a", "n_b")).select("a", "b")
        return sides(some, "a", "b").mapInArrow(_verify, "a long, b long")

    roots = linked(buckets, pairs, alike, sides, shingle_sets)
    # texts without words are alone: their class is keyed by their row
    rows = signed.select(*KEY, "_id", "_a", "_b", "_n").join(roots.select(F.col("id").alias("_a"), "root"), "_a", "left")
    group = F.when(F.col("_n") == 0, F.struct(F.col("_f").alias("x"), F.col("_r").alias("y"), F.lit(0).alias("z"))).when(
        F.col("root").isNotNull(), F.struct(F.col("root").alias("x"), F.lit(0).cast("long").alias("y"), F.lit(1).alias("z"))).otherwise(
        F.struct(F.col("_a").alias("x"), F.col("_b").alias("y"), F.lit(2).alias("z")))
    rows = land(rows.select(*KEY, "_id", group.alias("_g")), "grouped")
    order = F.struct(F.col("_id").isNull().alias("n"), "_id", *KEY)
    # a table of its own, so that the join below may split a large class
    best = land(rows.groupBy("_g").agg(F.min(order).alias("_best"), F.count("*").alias("_size")), "best")
    return rows.join(best, "_g").select(
        *KEY, "_id", F.col("_best._id").alias("_class"), "_size", ((F.col("_f") == F.col("_best._f")) & (F.col("_r") == F.col("_best._r"))).alias("_first"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents, one of each class; the least document id of a class stays."""
    docs = stored(docs)
    first = near_classes(docs).filter("_first").select(*KEY)
    return keyed(docs, F.struct("*").alias("_row")).join(first, list(KEY), "left_semi").select("_row.*")


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, class_id and class_size of every document."""
    found = near_classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("_id").alias("doc_id"), F.col("_class").alias("class_id"), F.col("_size").alias("class_size"))
