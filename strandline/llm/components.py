"""From bucketed keys to connected components, both without gathering any bucket or component in one task."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import arrow_schema, frugal, key_filter, maybe_in, mix
from strandline.session import land


ROUND = 1 << 18  # pairs that a round of `linked` may make at least; beyond that, as many as the first pairs
SLICES = 16  # parts of a bucket that meet its pivots in tasks of their own
EDGES = 1 << 20  # edges that a task contracts at once
DEALT = 1 << 20  # keys that a task sorts at once before it deals them
PART = 1 << 18  # keys of a part, some
THRESHOLD = 0.8  # least Jaccard similarity of the sets of pairs that `plausible` gives
# Sets x and y are so similar if they differ in no more than SLACK * (|x| + |y|) members.
SLACK = (1 - THRESHOLD) / (1 + THRESHOLD)
BLOCK = 16  # a reference of m rows has sqrt(m) / BLOCK blocks
TOKENS = 1 << 19  # members of differences in a block
TOGETHER = 256  # rows of small cells that are taken together
WORK = 1 << 20  # pairs and shared members counted at once

Sides = Callable[[DataFrame], DataFrame]
Shingles = Callable[[list[str]], Iterable[np.ndarray]]
_DEALT = "part int, keys array<long>, ids array<long>, a array<long>, b array<long>"
_DIFFERENCES = "ref long, id long, root long, outer boolean, size long, n long, tokens array<long>"


def _by_bucket(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, ids, a, b): each bucket with its least id, in the order of keys, and the pairs a < b of each other id
    with its bucket's least and with its predecessor there."""
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    again = np.zeros(len(keys), bool)
    again[1:] = keys[1:] == keys[:-1]
    several = again.copy()
    several[:-1] |= again[1:]
    # few buckets have several rows; only those are sorted by id
    bucket, held = keys[several], ids[several]
    held = held[np.lexsort((held, bucket))]
    ids[several] = held
    fresh = ~again[several]
    first = held[np.maximum.accumulate(np.where(fresh, np.arange(len(held)), 0))]
    before = np.roll(held, 1)
    star, chain = ~fresh & (first != held), ~fresh & (before != held) & (before != first)
    return keys[~again], ids[~again], np.concatenate([first[star], before[chain]]), np.concatenate([held[star], held[chain]])


def _nested(values: np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), pa.array(values))


def _deal(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of rows (keys, id), paired by their own keys and cut into parts of the range of keys, in which each
    key of the block has one row left."""
    bounds = np.array([part * 2**64 // parts for part in range(1, parts)], np.uint64)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        schema = arrow_schema(_DEALT)
        held, room = [], DEALT

        def block() -> pa.RecordBatch:
            keys, ids, a, b = _by_bucket(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
            ends = np.append(np.searchsorted(keys, bounds), len(keys))
            even = np.arange(1, parts + 1) * len(a) // parts
            columns = [pa.array(np.arange(parts), pa.int32()), _nested(keys.view(np.int64), ends), _nested(ids, ends), _nested(a, even), _nested(b, even)]
            filled = (np.diff(ends, prepend=0) > 0) | (np.diff(even, prepend=0) > 0)
            return pa.record_batch(columns, schema=schema).filter(pa.array(filled))

        for batch in batches:
            lists = batch.column(0)
            keys = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            # spread evenly over the whole range, whatever the keys
            held.append((mix(keys), np.repeat(batch.column(1).to_numpy(zero_copy_only=False), sizes)))
            room -= len(keys)
            if room <= 0:
                yield block()
                held, room = [], DEALT
        if held:
            yield block()

    return dealt


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of the blocks, and of the rows that they left, of rows sorted by part."""
    frugal()
    held, last = [], None

    def paired() -> pa.RecordBatch:
        keys, ids, a, b = ([h[i] for h in held] for i in range(4))
        _, _, more_a, more_b = _by_bucket(np.concatenate(keys).view(np.uint64), np.concatenate(ids))
        return pa.record_batch([pa.array(np.concatenate([*a, more_a])), pa.array(np.concatenate([*b, more_b]))], ["a", "b"])

    for batch in batches:
        part = batch.column(0).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(part)]):
            if held and part[start] != last:
                yield paired()
                held = []
            rows = batch.slice(start, end - start)
            held.append([rows.column(i).flatten().to_numpy(zero_copy_only=False) for i in range(1, 5)])
            last = part[start]
    if held:
        yield paired()


def key_pairs(signed: DataFrame, n_keys: int) -> DataFrame:
    """Distinct pairs (a < b) of ids to verify, from rows (keys, id), some n_keys keys in all; at most two for each key.

    All ids of a key are connected by the pairs. Tasks sort blocks of rows by key: an id is paired with the least one of its
    key in the block and with its predecessor, and of each key only the least id goes on. The keys are dealt to
    tasks by parts of their range, and what is left is paired likewise there. So a key of any number of ids sends
    no more than one row from each block.
    """
    parts = max(1, -(-n_keys // PART))
    dealt = signed.mapInArrow(_deal(parts), _DEALT).repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(_links, "a long, b long").distinct()


def candidate_pairs(buckets: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of ids to verify, from rows (bucket, id), at most two for each row. See key_pairs."""
    return key_pairs(buckets.select(F.array("bucket").alias("keys"), "id"), buckets.count())


def least_members(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, roots) of the ids in the edges (a, b): the least id of the component of each."""
    ids, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[: len(a)], places[len(a) :]
    label = np.arange(len(ids))
    while (label[x] != label[y]).any():
        # the larger root of an edge hangs on the smaller, then all hang on the roots
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]
    return ids, ids[label]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges (u, v) of the same components, in blocks, each id with the least one of its component there."""
    frugal()
    held, room = [], EDGES

    def contracted() -> pa.RecordBatch:
        ids, roots = least_members(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
        hangs = ids != roots
        return pa.record_batch([pa.array(ids[hangs]), pa.array(roots[hangs])], ["u", "v"])

    for batch in batches:
        held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
        room -= batch.num_rows
        if room <= 0:
            yield contracted()
            held, room = [], EDGES
    if held:
        yield contracted()


def components(pairs: DataFrame) -> DataFrame:
    """(id, root) for each id in a pair, root being the least id of its component.

    Tasks first contract blocks of edges. If there are several blocks, large-star and small-star steps follow
    until nothing changes; each is a grouping with partial sums and a join, and the edges are written to the
    shared folder after each round.
    """
    edges = land(pairs.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    blocks = -(-edges.count() // EDGES)
    edges = land(edges.coalesce(max(1, blocks)).mapInArrow(_contract, "u long, v long"), "edges")
    if blocks > 1:
        edges = _stars(edges)
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)


def _stars(edges: DataFrame) -> DataFrame:
    """Edges (u, v) from each id to the least one of its component."""
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: the larger neighbours of u go to the least one
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        # small star: the smaller neighbours of u, and u, go to the least one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = land(small.select("e.u", "e.v").filter("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges
        state = now


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ids are not in one component."""
    for side in ("a", "b"):
        pairs = pairs.join(roots.select(F.col("id").alias(side), F.col("root").alias(f"_{side}")), side, "left")
    return pairs.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def _unjoined(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows (bucket, id) of buckets with several components, with their root, the most frequent root and the rows there."""
    rows = members.join(roots, "id", "left").select("bucket", "id", F.coalesce("root", "id").alias("root"))
    sizes = rows.groupBy("bucket", "root").agg(F.count("*").alias("c"))
    sizes = sizes.groupBy("bucket").agg(F.max_by("root", F.struct("c", "root")).alias("top"), F.sum("c").alias("n"), F.max("c").alias("most"))
    # a table of its own, so that the join may split a large bucket
    sizes = land(sizes.filter("n > 2 and most < n").select("bucket", "top", "n"), "sizes")
    return land(rows.join(sizes, "bucket"), "unjoined")


def _met(pivots: DataFrame, rows: DataFrame, fits: str) -> DataFrame:
    """Distinct pairs of a pivot (bucket, pivot, ...) and a row of its bucket that fit; a large bucket is met in slices."""
    pivots = pivots.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(SLICES)).cast("int"))
    met = sliced.join(pivots, ["bucket", "slice"]).filter(fits)
    return met.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()


def differences(shingles: Shingles) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For rows (ref, id, root, outer, left, right), left being the text of the reference and right that of the id:
    the size of the id's set and the members that only one of the two sets has."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        schema = arrow_schema(_DIFFERENCES)

        def told(held: list[tuple]) -> pa.RecordBatch:
            names = list(dict.fromkeys(text for row in held for text in row[4:]))
            sets = dict(zip(names, shingles(names)))
            found = [np.setxor1d(sets[left], sets[right], assume_unique=True) for *_, left, right in held]
            sizes = [len(sets[row[5]]) for row in held]
            n = np.array([len(values) for values in found])
            nested = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), pa.array(np.concatenate(found).view(np.int64)))
            heads = [pa.array([row[i] for row in held], schema.field(i).type) for i in range(4)]
            return pa.record_batch([*heads, pa.array(sizes, pa.int64()), pa.array(n), nested], schema=schema)

        for batch in batches:
            held, room = [], 1 << 17  # characters whose shingles are held at once
            for row in zip(*(batch.column(name).to_pylist() for name in ("ref", "id", "root", "outer", "left", "right"))):
                held.append(row)
                room -= len(row[5]) + (len(row[4]) if len(held) == 1 or row[4] != held[-2][4] else 0)
                if room <= 0:
                    yield told(held)
                    held, room = [], 1 << 17
            if held:
                yield told(held)

    return tokens


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size says, one range after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _close(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The pairs of an outer row and another of its cell whose sets are similar, the members that their differences
    share being counted for many pairs at once."""
    column = {name: rows.column(name).combine_chunks() for name in rows.column_names}
    ref, low, high, block, ids, root, size, n = (column[name].to_numpy(zero_copy_only=False) for name in ("ref", "low", "high", "block", "id", "root", "size", "n"))
    outer = column["outer"].to_numpy(zero_copy_only=False)
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (ref[1:] != ref[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    cell = np.cumsum(fresh)
    token = column["tokens"].flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    owner = np.repeat(np.arange(len(ids)), n)
    # tokens are members of one cell; two of a hash would only let more pairs pass
    _, token, owners = np.unique(mix(token + cell[owner].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    met = (owners > 1) & (np.bincount(token, weights=outer[owner], minlength=len(owners)) > 0)
    owner, token = owner[met[token]], token[met[token]]
    by_token = owner[np.argsort(token, kind="stable")]
    owners = np.where(met, owners, 0)
    first = np.cumsum(owners) - owners
    own = np.bincount(owner, minlength=len(ids))
    begin = np.cumsum(own) - own
    work = np.bincount(owner, weights=owners[token], minlength=len(ids)) + len(ids)
    left = np.flatnonzero(outer)
    for some in np.split(left, np.flatnonzero(np.diff((np.cumsum(work[left]) // WORK).astype(np.int64))) + 1):
        if not len(some):
            continue
        used = token[_ranges(begin[some], own[some])]
        line = np.repeat(np.repeat(np.arange(len(some)), own[some]), owners[used])
        both = np.bincount(line * len(ids) + by_token[_ranges(first[used], owners[used])], minlength=len(some) * len(ids)).reshape(len(some), -1)
        one = some[:, None]
        # two sets differ in as many members as their differences to a third do
        fits = n[one] + n - 2 * both <= SLACK * (size[one] + size) + 1e-6
        fits &= (cell[one] == cell) & (root[one] != root) & ((low == high) | (block[one] != block)) & (~outer | (one < np.arange(len(ids))))
        x, y = np.nonzero(fits)
        a, b = ids[some[x]], ids[y]
        yield pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The similar pairs of rows sorted by cell; small cells are taken together."""
    frugal()
    held, n, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(name).to_numpy(zero_copy_only=False) for name in ("ref", "low", "high")])
        starts = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, [batch.num_rows]])
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
            now = tuple(key[:, start].tolist())
            if now != last and n >= TOGETHER:
                yield from _close(pa.Table.from_batches(held))
                held, n = [], 0
            held.append(batch.slice(start, end - start))
            n, last = n + end - start, now
    if held:
        yield from _close(pa.Table.from_batches(held))


def plausible(near: DataFrame, sides: Sides, shingles: Shingles) -> DataFrame:
    """Distinct pairs (a, b) of ids with one reference and different roots, being all whose sets have a
    similarity of THRESHOLD; from rows (ref, id, root, outer), one of each pair being outer.

    Two sets differ in as many members as their differences to a third do, so the differences to the reference
    are compared, which are short. The rows of a reference are dealt to blocks, and each two of them meet in a cell
    of its own, where all their pairs are counted by the members they share; no row is made of a pair that is not similar. A
    reference of m rows has some sqrt(m) / BLOCK blocks, or more if the differences are long, so a row is copied as
    often as that and a cell holds no more than two blocks. The time still grows with the square of m.
    """
    rows = land(sides(near).mapInArrow(differences(shingles), _DIFFERENCES), "differences")
    sizes = rows.groupBy("ref").agg(F.count("*").alias("m"), F.sum("n").alias("tokens"))
    blocks = F.greatest(F.ceil(F.sqrt("m") / BLOCK), F.ceil(F.col("tokens") / TOKENS), F.lit(1)).cast("int")
    # a table of its own, so that the join may split a large group
    sizes = land(sizes.filter("m > 1").select("ref", blocks.alias("blocks")), "blocks")
    placed = rows.join(sizes, "ref").withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), "blocks").cast("int"))
    dealt = placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    cells = dealt.select(
        "ref", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "root", "outer", "size", "n", "tokens")
    return cells.repartition("ref", "low", "high").sortWithinPartitions("ref", "low", "high").mapInArrow(_cells, "a long, b long").distinct()


def linked(
    buckets: DataFrame, pairs: DataFrame, alike: Callable[[DataFrame], DataFrame], sides: Sides | None = None, shingles: Shingles | None = None,
) -> DataFrame:
    """(id, root) of the components of all alike pairs that share a bucket; `pairs` are the candidate_pairs of the
    rows (bucket, id), and `alike` gives those pairs (a, b) that are alike.

    The candidate pairs come first. As they connect each bucket, one with several components holds a pair that is
    not alike, and only such buckets are looked at again. There the member with most links, as the original of
    many copies has, meets all others. Then all pairs of members still in different components are compared; but if `sides` (the
    texts of rows (ref, id, ...) as left and right) and `shingles` (a set of numbers for each text, of a similarity of
    THRESHOLD for texts that are alike) are given, only those whose sets are similar (see `plausible`). Without them, that
    member meets the others while that joins many, and the rest is compared in rounds of bounded size.
    """
    good = land(alike(pairs), "alike")
    roots = land(components(good), "roots")
    loose = land(_apart(pairs, roots).select(F.explode(F.array("a", "b")).alias("id")).distinct(), "loose")
    if loose.isEmpty():
        return roots
    hot = maybe_in(buckets, "id", key_filter(loose, "id")).join(loose, "id").groupBy("bucket").agg(F.count("*").alias("n"))
    hot = land(hot.filter("n > 1").select("bucket"), "hot")
    members = land(maybe_in(buckets, "bucket", key_filter(hot, "bucket")).join(hot, "bucket").select("bucket", "id").distinct(), "members")
    compared, links, used = pairs, good, None

    def compare(met: DataFrame) -> tuple[int, int]:
        nonlocal compared, links, roots
        new = land(_apart(met.join(compared, ["a", "b"], "left_anti"), roots), "met")
        compared = compared.unionByName(new)
        found = land(alike(new), "alike")
        n, m = new.count(), found.count()
        if m:
            links = links.unionByName(found)
            roots = land(components(roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(found)), "roots")
        return n, m

    if sides is not None and shingles is not None:
        rows = _unjoined(members, roots)
        if rows.isEmpty():
            return roots
        degrees = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("links"))
        order = F.struct(F.coalesce("links", F.lit(0)).alias("links"), "id")
        refs = rows.join(degrees, "id", "left").groupBy("bucket").agg(F.max_by(F.struct("id", "root"), order).alias("hub"))
        refs = land(refs.select("bucket", F.col("hub.id").alias("pivot"), F.col("hub.root").alias("other")), "hubs")
        compare(_met(refs, rows, "root <> other"))
        near = _unjoined(members, roots).join(refs, "bucket").filter("id <> pivot").select(F.col("pivot").alias("ref"), "id", "root").distinct()
        near = land(near, "near")
        tops = near.groupBy("ref", "root").agg(F.count("*").alias("c")).groupBy("ref").agg(F.max_by("root", F.struct("c", "root")).alias("top"))
        compare(plausible(near.join(tops, "ref").select("ref", "id", "root", (F.col("root") != F.col("top")).alias("outer")), sides, shingles))
        return roots

    while True:
        rows = _unjoined(members, roots)
        if rows.isEmpty():
            return roots
        degrees = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("links"))
        free = rows if used is None else rows.join(used, ["bucket", "id"], "left_anti")
        hubs = free.join(degrees, "id").groupBy("bucket").agg(F.max_by(F.struct("id", "root"), F.struct("links", "id")).alias("hub"))
        hubs = land(hubs.select("bucket", F.col("hub.id").alias("pivot"), F.col("hub.root").alias("other")), "hubs")
        tried = hubs.select("bucket", F.col("pivot").alias("id"))
        used = tried if used is None else used.unionByName(tried)
        n, m = compare(_met(hubs, rows, "root <> other"))
        if m * 8 <= n:
            break
    rows = _unjoined(members, roots) if m else rows
    # all pairs of members whose roots differ now: one of the two is outside of the bucket's largest component
    total = rows.agg(F.sum(F.when(F.col("root") != F.col("top"), F.col("n")))).first()[0] or 0
    rounds = -(-total // max(ROUND, pairs.count()))
    rows = rows.withColumn("round", F.pmod(F.xxhash64("id"), F.lit(max(1, rounds))))
    for at in range(rounds):
        pivots = rows.filter((F.col("root") != F.col("top")) & (F.col("round") == at)).select("bucket", F.col("id").alias("pivot"), F.col("root").alias("other"))
        compare(_met(pivots, rows, f"root <> other and (root = top or round > {at} or round = {at} and id > pivot)"))
    return roots
