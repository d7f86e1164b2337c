import math

import numpy as np
import pytest

from strandline.llm import neighbours


def brute_force(rows, query_id, k=5):
    query = next(v for i, v in rows if i == query_id)
    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))
    return sorted(((-cosine(query, v), i) for i, v in rows if i != query_id))[:k]


def search(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, v string").repartition(3)
    index = neighbours.build_index(frame)
    return neighbours.search_all(index, neighbours.usable(frame).filter("id % 50 = 0")).collect()


def test_recall_on_several_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 300)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=24).astype(np.float32).tolist(), "x", "y") for i in range(2000)]
    got = search(spark, rows)
    plain = [(i, v) for i, v, _, _ in rows]
    hits = 0
    for query in range(0, 2000, 50):
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == query)
        assert [x[0] for x in mine] == [1, 2, 3, 4, 5]
        want = brute_force(plain, query)
        hits += len({i for _, i in want} & {i for _, i, _ in mine})
        exact = {i: -s for s, i in brute_force(plain, query, 2000)}
        assert all(abs(exact[i] - s) < 1e-12 for _, i, s in mine)
    assert hits >= 0.9 * 200


@pytest.mark.parametrize("width, hot", [(64, 0), (64, 2700), (256, 2700)])
def test_recall_on_a_full_clustered_shard(width, hot):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=((8000 - hot) // 70, width))
    rows = [np.repeat(centres, 70, axis=0), np.repeat(rng.normal(size=(1, width)), hot, axis=0)]
    vectors = np.concatenate(rows)
    vectors = neighbours._unit(vectors + 0.05 * rng.normal(size=vectors.shape))
    graph = neighbours.build(vectors)
    found = []
    for query in rng.choice(len(vectors), 200, replace=False):
        want = set(np.argsort(-(vectors @ vectors[query]))[:6].tolist()) - {int(query)}
        found.append(len(want & set(neighbours.search(graph, vectors[query], 6)[:6])) / len(want))
    assert np.mean(found) >= 0.97 and min(found) > 0


def test_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(4)
    same = rng.normal(size=8).astype(np.float32).tolist()
    rows = [(i, same, "x", "y") for i in range(100, 900)] + [(i, rng.normal(size=8).astype(np.float32).tolist(), "x", "y") for i in range(100)]
    rows += [(1000, None, "x", "y"), (1050, [0.0] * 8, "x", "y"), (1100, [1.0, None] + [1.0] * 6, "x", "y"), (1150, [float("nan")] * 8, "x", "y"),
             (1200, [float("inf")] * 8, "x", "y"), (1250, [], "x", "y"), (None, same, "x", "y"), (850, same, "x", "y"), (850, same, "x", "y")]
    got = search(spark, rows)
    assert {r.query_id for r in got} == set(range(0, 900, 50))
    for query in range(150, 900, 50):
        assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == query] == [i for i in range(100, 107) if i != query][:5]


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_few_vectors(spark, n):
    rows = [(50 * i, [1.0, float(i)], "x", "y") for i in range(n)]
    got = search(spark, rows)
    assert len(got) == n * (n - 1)
