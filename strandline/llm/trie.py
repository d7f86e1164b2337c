"""Conversation prefix trie: every distinct beginning of a conversation, with counts over its subtree.

Rebuilt conversations are cut into segments of at most WIDTH turns (and the one after them), each with a key of
the turns before it, so that a conversation of any length is spread over tasks. Segments are dealt by range of
(block, key, turns, conversation); a task turns them into padded matrices of turn ids, a bounded number of rows
each. Nodes inside a matrix are whole; those at its first or last row may go on in others and are recombined by key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import frugal, ready, table
from strandline.session import land

WIDTH = 32  # turns of a segment
ROWS = 1 << 14  # segments of a matrix
GROUP = 5  # conversations c - c % GROUP to c share a head
HEADS = 9  # a head has fewer turns than this
SUPER = 1 << 12  # segments that are summed up by one window
ID = 16  # bytes of a turn's id
KEYED = 64  # characters of role and text that take part in dealing out turns; the rest only in ordering them


def _head(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 0), id and size (UTF-8 bytes of the text) of each turn, ordered by turn, nulls first.

    Turns of one number are ordered by role, then text. Rows without conv_id belong to no conversation and are
    left out. The turns are numbered by their places in the files of one sorted table, so that a conversation of
    any length is numbered by many tasks.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    dealt = rows.repartitionByRange("conv_id", "turn", F.substring("role", 1, KEYED), F.substring("text", 1, KEYED)).sortWithinPartitions("conv_id", "turn", "role", "text")
    spelled = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    stored = land(dealt.select("conv_id", F.md5(spelled.cast("binary")).alias("id"), F.octet_length("text").cast("long").alias("size")), "turns")
    meta = stored.metadataColumn("_metadata")
    placed = stored.select("*", meta["file_name"].alias("file"), meta["row_index"].alias("at"))
    files = placed.groupBy("file").agg(F.count("*").alias("n"))  # a row for each task that wrote
    in_order = Window.orderBy(F.length("file"), "file")  # numbers of files have five digits or more
    before = files.select("file", (F.sum("n").over(in_order) - F.col("n")).alias("before"))
    every = placed.join(before, "file").select("conv_id", "id", "size", (F.col("before") + F.col("at")).alias("at"))
    firsts = every.groupBy("conv_id").agg(F.min("at").alias("first"))
    return every.join(firsts, "conv_id").select("conv_id", (F.col("at") - F.col("first")).alias("place"), "id", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns as rebuilt (conv_id, place, id, size), and conv_id and n_turns of every conversation.

    The first h turns of conversation c - c % 5 (remainders as in SQL, with the sign of c), then c's own after its
    first h, with h the unsigned CRC-32 of c in decimals, modulo 9.
    """
    counts = land(turns.groupBy("conv_id").agg(F.count("*").alias("n")).select("*", _head(F.col("conv_id")).alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base")), "conversations")
    bases = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = counts.join(bases, "base", "left").select(
        "conv_id", "base", "h", "n", F.least("h", F.coalesce("n_base", F.lit(0))).alias("n_head"))
    own = (turns.join(convs, "conv_id").filter("place >= h")
           .select("conv_id", (F.col("n_head") + F.col("place") - F.col("h")).alias("place"), "id", "size"))
    # at most eight turns for each of at most nine conversations of a base
    first = turns.filter((F.col("place") < HEADS - 1) & (F.col("conv_id") % GROUP == 0)).withColumnRenamed("conv_id", "base")
    heads = first.join(convs.select("conv_id", "base", "h"), "base").filter("place < h").select("conv_id", "place", "id", "size")
    lengths = convs.select("conv_id", (F.col("n_head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns"))
    return own.unionByName(heads), lengths


def _before(rows: DataFrame, sums: list[str]) -> DataFrame:
    """Sums over the earlier blocks of the same conversation: within runs of SUPER blocks, then over the runs."""
    rows = rows.withColumn("run", F.floor(F.col("block") / SUPER))
    inner = Window.partitionBy("conv_id", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("conv_id", "run").agg(*(F.sum(c).alias(f"all_{c}") for c in sums))
    runs = runs.select("conv_id", "run", *(F.coalesce(F.sum(f"all_{c}").over(outer), F.lit(0)).alias(f"all_{c}") for c in sums))
    found = rows.withColumns({f"in_{c}": F.coalesce(F.sum(c).over(inner), F.lit(0)) for c in sums}).join(runs, ["conv_id", "run"])
    return found.select("conv_id", "block", *((F.col(f"in_{c}") + F.col(f"all_{c}")).alias(c) for c in sums))


def segments(turns: DataFrame, lengths: DataFrame, width: int = WIDTH) -> DataFrame:
    """conv_id, n_turns, block, key, ids, sizes, before and own for each run of `width` turns of a conversation.

    `ids` and `sizes` are of its turns and of the one after; `key` tells the turns before it apart, `before` is their
    size, `own` that of its turns without the one after. A conversation whose length is a multiple of the width, and so one of no turns, has a
    segment without turns at its end.
    """
    block = F.floor(F.col("place") / width)
    twice = F.when((F.col("place") > 0) & (F.col("place") % width == 0), F.array(block, block - 1)).otherwise(F.array(block))
    dealt = turns.select("conv_id", F.explode(twice).alias("block"), F.struct("place", "id", "size").alias("turn"))
    ends = lengths.filter(F.col("n_turns") % width == 0).select("conv_id", F.floor(F.col("n_turns") / width).alias("block"), F.lit(None).cast(dealt.schema["turn"].dataType).alias("turn"))
    rows = dealt.unionByName(ends).groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("turn")).alias("turns"))  # at most width + 1 turns
    mine = F.slice("turns", 1, width)
    digest = F.md5(F.concat(F.col("block").cast("string"), F.lit(":"), F.array_join(mine["id"], "")).cast("binary"))
    lanes = {f"lane{k}": F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)}
    rows = rows.join(lengths, "conv_id").withColumn("own", F.aggregate(mine["size"], F.lit(0).cast("long"), lambda a, b: a + b))
    short = F.col("n_turns") < width
    sums = ["size", *lanes]
    added = rows.filter(~short).withColumn("digest", digest).select("conv_id", "block", F.col("own").alias("size"), *(c.alias(n) for n, c in lanes.items()))
    long_before = _before(added, sums).withColumn("key", F.unhex(F.md5(F.concat_ws(",", *lanes).cast("binary"))))
    common = ["conv_id", "n_turns", "block", F.unhex(F.array_join(F.col("turns")["id"], "")).alias("ids"), F.col("turns")["size"].alias("sizes"), "own"]
    nothing = F.unhex(F.lit(""))
    whole = rows.filter(short).select(*common, nothing.alias("key"), F.lit(0).cast("long").alias("before"))
    first = F.col("block") == 0
    parts = rows.filter(~short).select(*common).join(long_before, ["conv_id", "block"])
    return whole.unionByName(parts.select(*whole.columns[:-2], F.when(first, nothing).otherwise(F.col("key")).alias("key"), F.col("size").alias("before")))


_FIELDS = pa.schema([
    ("kind", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()), ("shown", pa.bool_()), ("conv_id", pa.int64()), ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("before", pa.int64()), ("ends", pa.string())])
_NODES = ("kind string, key binary, parent_key binary, shown boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
          "n_leaves long, saved_tokens long, before long, ends string")


def _numbers(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    cells = np.frombuffer(raw, ">u8").reshape(-1, 2).astype(np.uint64)
    return cells[:, 0], cells[:, 1]


def _ranks(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Numbers from 1 that order ids as their bytes do."""
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def matrix_nodes(rows: pa.Table, width: int, whole: bool) -> pa.RecordBatch:
    """The nodes of a matrix of segments: kind `node`, or `open` for those that touch its first or last row.

    Without `whole`, only what is needed to find each node's smallest conversation and its children. With it, also
    the sums over `credit` and `until` of the conversations, and `ends`: the digest of a node's ends, or for open
    nodes their ids, in rows of kind `ends`.
    """
    n, conv = rows.num_rows, rows["conv_id"].to_numpy().astype(np.int64)
    raw_ids, keys = rows["ids"].to_pylist(), rows["key"].to_pylist()
    count = np.array([len(x) // ID for x in raw_ids], np.int64)
    block, n_turns = rows["block"].to_numpy().astype(np.int64), rows["n_turns"].to_numpy().astype(np.int64)
    at = np.repeat(np.arange(n), count), np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    turn = np.zeros((n, width + 1), np.int64)
    turn[at] = _ranks(*_numbers(b"".join(raw_ids)))
    size = np.zeros((n, width + 1), np.int64)
    size[at] = np.concatenate([np.asarray(x, np.int64) for x in rows["sizes"].to_pylist()]) if len(at[0]) else []
    key = _ranks(*_numbers(b"".join(x or bytes(ID) for x in keys)))

    order = np.lexsort((conv, *turn.T[::-1], key, block))
    conv, count, block, n_turns, turn, size, key = (x[order] for x in (conv, count, block, n_turns, turn, size, key))
    raw_ids, keys = [raw_ids[i] for i in order], [keys[i] for i in order]
    before = rows["before"].to_numpy().astype(np.int64)[order]
    if whole:
        credit, until = rows["credit"].to_numpy(zero_copy_only=False).astype(np.int64)[order], rows["until"].to_numpy().astype(np.int64)[order]

    # starts[j]: a node of level j starts at the row, that is, one of its first j turns differs from those of the row before
    starts = np.ones((width + 2, n), bool)
    starts[0, 1:] = (block[1:] != block[:-1]) | (key[1:] != key[:-1])
    starts[1:, 1:] = (turn[1:] != turn[:-1]).T
    np.logical_or.accumulate(starts, axis=0, out=starts)
    there = count >= np.arange(width + 2)[:, None]
    sized = before[:, None] + np.concatenate([np.zeros((n, 1), np.int64), np.cumsum(size, axis=1)], axis=1)

    parts: list[list] = [[] for _ in _FIELDS]

    def add(m: int, **given: object) -> None:
        for part, field in zip(parts, _FIELDS, strict=True):
            value = given.get(field.name)
            part.append(pa.array(value, field.type) if isinstance(value, (np.ndarray, list)) else pa.nulls(m, field.type) if value is None else pa.repeat(pa.scalar(value, field.type), m))

    def name(level: int, row: int) -> bytes:
        return hashlib.md5(b"%d,%d,%d:" % (block[row], level, len(keys[row])) + keys[row] + raw_ids[row][: ID * level]).digest()

    above: tuple | None = None
    for level in range(width + 2):
        begin = np.flatnonzero(starts[level])
        end = np.append(begin[1:], n)
        is_open = (begin == 0) | (end == n)
        least = np.minimum.reduceat(conv, begin)
        run = np.cumsum(starts[level]) - 1
        if level:
            parent = above[0][begin]
            parent_conv, parent_open = above[1][parent], above[2][parent]
        else:
            parent_conv, parent_open = np.zeros(len(begin), np.int64), np.zeros(len(begin), bool)
        exists = there[level][begin]
        if level <= width:
            below = starts[level + 1] & there[level + 1]
            if n:  # children that touch an edge are counted when they are recombined
                edge = np.zeros(n, bool)
                edge[0] = True
                edge[np.flatnonzero(starts[level + 1])[-1]] = True
                below &= ~edge
            children = np.add.reduceat(below.astype(np.int64), begin)
        else:
            children = np.zeros(len(begin), np.int64)
        depth = block[begin] * width + level
        shown = exists & ((block[begin] == 0) if level == 0 else np.full(len(begin), level <= width))
        floor = sized[:, level - 1] if level else np.zeros(n, np.int64)
        sums = {"n_convs": end - begin, "n_children": children, "before": floor[begin]}
        if whole:
            sums |= {"n_leaves": np.add.reduceat(credit, begin), "saved_tokens": np.add.reduceat(np.maximum(until - floor, 0), begin)}
        ended = (count == level) & (n_turns == block * width + level)
        n_ended = np.add.reduceat(ended.astype(np.int64), begin)

        def spelled(k: int, begin=begin, n_ended=n_ended) -> str:
            return ",".join(map(str, conv[begin[k] : begin[k] + n_ended[k]].tolist()))

        take = np.flatnonzero(shown & ~is_open)
        if len(take):
            unknown = parent_open[take]
            ends = [hashlib.sha256(spelled(k).encode()).hexdigest() if n_ended[k] else _NO_ENDS for k in take.tolist()] if whole else None
            add(len(take), kind="node", shown=True, conv_id=least[take], depth=depth[take], ends=ends,
                parent_conv_id=pa.array(parent_conv[take], mask=unknown).to_pylist() if unknown.any() else parent_conv[take],
                parent_key=[name(level - 1, int(begin[k])) if u else None for k, u in zip(take.tolist(), unknown.tolist(), strict=True)] if level else None,
                **{c: x[take] for c, x in sums.items()})
        take = np.flatnonzero(exists & is_open)
        if len(take):
            named = [name(level, int(begin[k])) for k in take.tolist()]
            add(len(take), kind="open", key=named, parent_key=[name(level - 1, int(begin[k])) for k in take.tolist()] if level else None,
                shown=shown[take].tolist(), conv_id=least[take], depth=depth[take], **{c: x[take] for c, x in sums.items()})
            if whole and len(some := [i for i, k in enumerate(take.tolist()) if n_ended[k] and shown[k]]):
                add(len(some), kind="ends", key=[named[i] for i in some], conv_id=conv[begin[take[some]]], ends=[spelled(int(take[i])) for i in some])
        above = (run, least, is_open)
    return pa.record_batch([pa.concat_arrays(part) if part else pa.nulls(0, field.type) for part, field in zip(parts, _FIELDS, strict=True)], schema=_FIELDS)


_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _nodes(rows: DataFrame, width: int, whole: bool, at_once: int) -> DataFrame:
    order = ("block", "key", "ids", "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        held, n = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                held.append(batch.slice(start, at_once))
                n += held[-1].num_rows
                if n >= at_once:
                    yield matrix_nodes(pa.Table.from_batches(held), width, whole)
                    held, n = [], 0
        if n:
            yield matrix_nodes(pa.Table.from_batches(held), width, whole)

    return land(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _NODES), "nodes")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest of the joined ids of each key; rows come sorted by key and place."""
    key, digest = None, None
    for batch in batches:
        done = []
        for found, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if found != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = found, hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        if done:
            yield pa.record_batch([pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done])], ["key", "ends"])
    if key is not None:
        yield pa.record_batch([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends"])


def _recombined(nodes: DataFrame) -> DataFrame:
    """One row for each open node, from its parts."""
    parts = nodes.filter("kind = 'open'")
    sums = parts.groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("shown").alias("shown"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        F.max("before").alias("before"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")))
    children = sums.filter("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("n_open"))
    return sums.join(children, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("n_open", F.lit(0))).drop("n_open")


def prefix_trie(turns: DataFrame, lengths: DataFrame, width: int = WIDTH, at_once: int = ROWS) -> DataFrame:
    """Every distinct beginning of the conversations, the empty one included.

    turns: conv_id, place, id (an MD5 in hexadecimals), size; lengths: conv_id, n_turns. Returns conv_id (the
    smallest that begins so), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    No conversations give no nodes.

    Two passes are made over the matrices. The first finds each node's smallest conversation, hence the depth from
    which a conversation is the smallest of its nodes, and whether it ends in a leaf; with these two numbers beside
    its segments, the second sums up subtrees that reach into other segments. The ids of the conversations that end
    at one node are digested as a stream, as SHA-256 demands, by one task.
    """
    ready(turns.sparkSession)
    cut = land(segments(turns, lengths, width), "segments")
    found = _nodes(cut, width, False, at_once)
    columns = ["conv_id", "depth", "before", "n_children"]
    known = found.filter("kind = 'node'").select(*columns).unionByName(_recombined(found).filter("shown").select(*columns))
    firsts = known.groupBy("conv_id").agg(F.min(F.struct("depth", "before")).alias("first"), F.max(F.col("n_children") == 0).alias("credit"))
    totals = cut.groupBy("conv_id").agg(F.sum("own").alias("total"))
    facts = totals.join(firsts, "conv_id", "left").select("conv_id", F.coalesce("credit", F.lit(False)).alias("credit"), F.coalesce("first.before", "total").alias("until"))
    nodes = _nodes(cut.join(facts, "conv_id"), width, True, at_once)

    numbers = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    ends = nodes.filter("kind = 'ends'").select("key", "ends", "conv_id").repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ends")
    digests = ends.mapInArrow(_digests, "key binary, ends string")
    edges = land(_recombined(nodes), "edges")  # a few for each matrix
    whole = nodes.filter("kind = 'node'").withColumnRenamed("ends", "ends_sha256")
    opened = edges.filter("shown").join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(_NO_ENDS)))
    names = edges.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    below = whole.filter("parent_key is not null").drop("parent_conv_id").unionByName(opened.filter("parent_key is not null"), allowMissingColumns=True)
    return (whole.filter("parent_key is null").select(*numbers, "ends_sha256")
            .unionByName(opened.filter("parent_key is null").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*numbers, "ends_sha256"))
            .unionByName(below.join(names, "parent_key").select(*numbers, "ends_sha256")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    turns, lengths = rebuilt(land(numbered_turns(table(spark, sf_dir, "conversations")), "numbered"))
    return prefix_trie(land(turns, "rebuilt"), land(lengths, "lengths"))


# CRC-32 is spelled out: its table of 256 entries comes from the polynomial, then a fold over the digits of conv_id.
OP13_SQL = """
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM ids, crc
), turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), parts AS (
  SELECT g.conv_id, 0 AS part, place, role, text FROM heads g JOIN turns t ON t.conv_id = g.base WHERE place < h
  UNION ALL
  SELECT g.conv_id, 1, place, role, text FROM heads g JOIN turns t ON t.conv_id = g.conv_id WHERE place >= h
), made AS (
  SELECT ids.conv_id, coalesce(turns, []) AS turns
  FROM ids LEFT JOIN (SELECT conv_id, list({'role': role, 'text': text} ORDER BY part, place) AS turns FROM parts GROUP BY conv_id) USING (conv_id)
), members AS (
  SELECT conv_id, depth, len(turns) AS n, turns[1:depth] AS node FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM made)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256,
         CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * strlen(node[-1].text) END AS gain
  FROM members GROUP BY node, depth
), kids AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT node[1:d] AS node, sum(leaf) AS n_leaves, sum(gain) AS saved_tokens
  FROM (SELECT a.node, gain, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(depth + 1)) AS d FROM nodes a LEFT JOIN kids b ON a.node = b.node)
  GROUP BY 1
)
SELECT a.conv_id, a.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, a.n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, a.ends_sha256
FROM nodes a LEFT JOIN kids k ON a.node = k.node JOIN below b ON a.node = b.node
LEFT JOIN nodes p ON a.depth > 0 AND p.depth = a.depth - 1 AND p.node = a.node[1:a.depth - 1]
"""
