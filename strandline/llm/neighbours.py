"""Approximate nearest neighbours: a hierarchy of neighbour graphs per shard, kept as flat arrays, and merged results.

The graph is not built by inserting nodes one after the other, as HNSW does. A node's links come from its exact nearest
on the layer; every node of a layer is on the next one too or is linked from a node there; and the highest layer
is small and is scanned whole, so that no cluster is without an entry.

A shard is a run of at most `SHARD` rows of an input partition, so no row moves to build the index and a
shard fits a worker whatever the table's size. Queries come in blocks of bounded size, which are sent to
all shards; each task merges its shards' results before they are shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.llm.common import mix, ready, table
from strandline.session import land

SHARD = 8192  # vectors of a shard, at most
LINKS = 16  # neighbours of a node on the upper layers; twice as many on the lowest
BEAM = 64  # nodes kept while searching a layer
ENTRIES = 256  # nodes of the highest layer, about at most; it is scanned whole
BLOCK_BYTES = 32 << 20  # of the query vectors sent to the shards at once

_INDEX = "ids array<long>, sizes array<long>, vectors binary, width int, layers array<long>, links binary, entries array<long>"


@dataclass
class Graph:
    """The layers of a shard's graph: for each layer the nodes on it and an array of neighbours, -1 for none."""

    vectors: np.ndarray  # nodes x width, of length one
    levels: list[np.ndarray]  # for each layer but the highest, from the lowest, nodes x links
    entries: np.ndarray  # the nodes of the highest layer


def node_levels(n: int, vectors: np.ndarray) -> np.ndarray:
    """The top layer of each node, falling off by a factor of LINKS; chosen by a hash of the vector's bytes."""
    raw = np.ascontiguousarray(vectors).view(np.uint32).astype(np.uint64)
    spread = mix(raw + np.arange(1, raw.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    share = (np.bitwise_xor.reduce(spread, axis=1) >> np.uint64(11)).astype(float) / 2**53
    return np.minimum(8, (-np.log(np.maximum(share, 1e-18)) / np.log(LINKS)).astype(int))


def build(vectors: np.ndarray) -> Graph:
    """The graph of distinct vectors of length one.

    On each layer the candidates of a node are its nearest there, found by products of blocks of rows with all
    of the shard, as it is small; of these it keeps neighbours nearer to itself than to one kept before, then fills up
    with the nearest left, and links run both ways. The layer above holds a hashed choice of nodes, and those
    that no link of a chosen one leads to.
    """
    n = len(vectors)
    top = node_levels(n, vectors)
    nodes, levels = np.arange(n), []
    while True:
        links = _link(vectors, nodes, np.full((n, LINKS * (1 if levels else 2)), -1, np.int32))
        levels.append(links)
        above = _above(nodes, links, nodes[top[nodes] >= len(levels)])
        # with so few above, or a layer that does not get much smaller, these are the entries
        nodes = above
        if len(nodes) <= ENTRIES or len(nodes) * 2 > int((links[:, :1] >= 0).sum()):
            return Graph(vectors, levels, nodes)


def _above(nodes: np.ndarray, links: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The chosen nodes, and as many others as it takes that each node is among them or linked from one of them."""
    reached = np.zeros(len(links) + 1, bool)  # the last one stands for no link
    reached[chosen] = True
    reached[links[chosen]] = True
    more = []
    for node in nodes.tolist():
        if not reached[node]:
            more.append(node)
            reached[node] = True
            reached[links[node]] = True
    return np.sort(np.concatenate([chosen, np.array(more, np.int64)]).astype(np.int64))


def _link(vectors: np.ndarray, nodes: np.ndarray, links: np.ndarray) -> np.ndarray:
    width, own = links.shape[1], vectors[nodes]
    wanted = min(len(nodes) - 1, 2 * width)
    if wanted < 1:
        return links
    out: list[list[int]] = []
    for start in range(0, len(nodes), 512):
        near = own[start : start + 512] @ own.T
        near[np.arange(len(near)), np.arange(start, start + len(near))] = -np.inf
        picked = np.argpartition(-near, wanted - 1, axis=1)[:, :wanted]
        close = np.take_along_axis(near, picked, axis=1)
        order = close.argsort(axis=1)[:, ::-1]
        picked, close = np.take_along_axis(picked, order, axis=1), np.take_along_axis(close, order, axis=1)
        for row, near_row in zip(picked, close):
            among = own[row] @ own[row].T  # how near the candidates are to one another
            kept: list[int] = []
            left: list[int] = []
            for at in range(wanted):
                if len(kept) == width // 2:
                    break
                if kept and among[at, kept].max() > near_row[at]:
                    left.append(at)
                else:
                    kept.append(at)
            out.append(row[kept + left[: width // 2 - len(kept)]].tolist())
    both: list[list[int]] = [list(x) for x in out]
    for at, row in enumerate(out):
        for other in row:
            if at not in both[other] and len(both[other]) < width:
                both[other].append(at)
    for at, row in enumerate(both):
        links[nodes[at], : len(row)] = nodes[row]
    return links


def search(graph: Graph, query: np.ndarray, wanted: int) -> list[int]:
    """Nodes near the query: the nearest of the highest layer, then a beam on each layer below, started from those found above."""
    beam = max(BEAM, wanted)
    near = graph.vectors[graph.entries] @ query
    if len(near) > beam:
        picked = np.argpartition(-near, beam - 1)[:beam]
    else:
        picked = np.arange(len(near))
    found = list(zip(near[picked].tolist(), graph.entries[picked].tolist()))
    for links in graph.levels[::-1]:
        found = _beam(graph.vectors, links, query, found, beam)
    return [node for _, node in sorted(found, reverse=True)]


def _beam(vectors: np.ndarray, links: np.ndarray, query: np.ndarray, found: list[tuple[float, int]], beam: int) -> list[tuple[float, int]]:
    seen = np.zeros(len(vectors), bool)
    seen[[at for _, at in found]] = True
    todo = [(-near, at) for near, at in found]
    heapq.heapify(todo)
    heapq.heapify(found)
    while todo:
        far, at = heapq.heappop(todo)
        if len(found) >= beam and -far < found[0][0]:
            break
        around = links[at]
        around = around[around >= 0]
        around = around[~seen[around]]
        if not len(around):
            continue
        seen[around] = True
        for near, other in zip((vectors[around] @ query).tolist(), around.tolist()):
            if len(found) < beam or near > found[0][0]:
                heapq.heappush(todo, (-near, other))
                heapq.heappush(found, (near, other))
                if len(found) > beam:
                    heapq.heappop(found)
    return found


def _unit(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.sqrt((vectors.astype(float) ** 2).sum(axis=1, keepdims=True))).astype(np.float32)


def _index_rows(ids: list[int], vectors: list[bytes], width: int) -> pa.RecordBatch:
    """One shard as a row: copies of a vector are one node, whose ids stand together in ascending order."""
    own = np.frombuffer(b"".join(vectors), np.float64).reshape(len(ids), width)
    distinct, node = np.unique(own, axis=0, return_inverse=True)
    node = node.reshape(-1)
    graph = build(_unit(distinct))
    order = np.lexsort((np.array(ids), node))
    return pa.record_batch([
        pa.array([np.array(ids)[order].tolist()], pa.list_(pa.int64())), pa.array([np.bincount(node, minlength=len(distinct)).tolist()], pa.list_(pa.int64())),
        pa.array([distinct.tobytes()], pa.large_binary()), pa.array([width], pa.int32()),
        pa.array([[x.shape[1] for x in graph.levels]], pa.list_(pa.int64())),
        pa.array([b"".join(x.tobytes() for x in graph.levels)], pa.large_binary()), pa.array([graph.entries.tolist()], pa.list_(pa.int64())),
    ], [name.strip().split(" ")[0] for name in _INDEX.split(",")])


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, tuple[list[int], list[bytes]]] = {}
    for batch in batches:
        for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids, vectors = held.setdefault(len(vector), ([], []))
            ids.append(key)
            vectors.append(np.array(vector, np.float64).tobytes())
            if len(ids) == SHARD:
                yield _index_rows(*held.pop(len(vector)), len(vector))
    for width, (ids, vectors) in held.items():
        yield _index_rows(ids, vectors, width)


def usable(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, v) of the rows that take part: an id, and a vector of finite components that aren't all zero."""
    v = F.col(embedding).cast("array<double>")
    fine = F.size(v) > 0
    fine &= F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))


def build_index(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The stored index: a row for each shard with its ids, vectors and flat arrays of neighbours."""
    ready(rows.sparkSession)
    return land(usable(rows, vec_id, embedding).mapInArrow(_build, _INDEX), "shards")


def _search_shard(row: dict, queries: np.ndarray, query_ids: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
    vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["width"])
    n, levels, at = len(vectors), [], 0
    links = np.frombuffer(row["links"], np.int32)
    for width in row["layers"]:
        levels.append(links[at : at + n * width].reshape(n, width))
        at += n * width
    graph, sizes, ids = Graph(_unit(vectors), levels, np.array(row["entries"], np.int64)), np.array(row["sizes"]), np.array(row["ids"])
    starts, lengths = np.cumsum(sizes) - sizes, np.sqrt((vectors**2).sum(axis=1))
    units = _unit(queries)
    for place, (query, unit) in enumerate(zip(queries, units)):
        nodes = search(graph, unit, k + 1)
        exact = (vectors[nodes] * query).sum(axis=1) / (lengths[nodes] * np.sqrt((query**2).sum()))
        best: list[tuple[float, int]] = []
        for near, node in zip(exact.tolist(), nodes):
            # of copies the least ids come first; one of them may be the query itself
            best += [(-near, int(x)) for x in ids[starts[node] : starts[node] + min(sizes[node], k + 1)] if x != query_ids[place]]
        yield from ((place, key, -near) for near, key in heapq.nsmallest(k, best))


def search_all(index: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query (id, v) the k nearest found, by cosine, then by id.

    Rows with the query's own id are left out. Of several queries with one id, one counts (the least vector).
    """
    spark = index.sparkSession
    ready(spark)
    one = queries.groupBy("id").agg(F.min("v").alias("v"))
    # blocks of bounded size, numbered by running sums of counts by hash, so the driver sees one block at a time
    n, width = one.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    blocks = max(1, -(-n * width * 8 // BLOCK_BYTES))
    asked = land(one.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))), "queries", "block")
    found = None
    for block in range(blocks):
        got = asked.filter(F.col("block") == block).select("id", "v").toPandas().sort_values("id")
        by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, part in got.groupby(got["v"].str.len()):
            by_width[int(size)] = (part["id"].to_numpy(np.int64), np.array(part["v"].tolist(), float))
        part = _search_block(index, by_width, k)
        found = part if found is None else found.unionByName(part)
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_block(index: DataFrame, by_width: dict[int, tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(by_width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int]]] = {}  # of all shards of the task
        for batch in batches:
            for row in batch.to_pylist():
                ids, queries = shared.value.get(row["width"], (None, None))
                if ids is None:
                    continue
                for place, key, near in _search_shard(row, queries, ids, k):
                    kept = best.setdefault(int(ids[place]), [])
                    kept.append((-near, key))
                    if len(kept) >= 8 * k:
                        kept[:] = heapq.nsmallest(k, kept)
        flat = [(query, key, -near) for query, kept in best.items() for near, key in heapq.nsmallest(k, kept)]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        yield pa.record_batch([pa.array([x[i] for x in flat], kind) for i, kind in enumerate(kinds)], ["query_id", "vec_id", "score"])

    return index.mapInArrow(run, "query_id long, vec_id long, score double")


def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found of every vector whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings")
    return search_all(build_index(rows), usable(rows).filter("id % 50 = 0"))
