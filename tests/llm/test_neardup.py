from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tests.llm import cases

from strandline.llm import components as components_module
from strandline.llm import neardup
from strandline.llm.components import candidate_pairs, components
from strandline.session import land


def brute_force(rows):
    shingles = [neardup.labelled_shingles(neardup.word_hashes(t or "")) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(shingles):
        for j in range(i):
            if len(a) and len(shingles[j]) and neardup.similar(shingles[j], a):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        groups[root(i)].append(key)
    return sorted(((rows[i][0], min((k for k in groups[root(i)] if k is not None), default=None), len(groups[root(i)])) for i in range(len(rows))), key=str)


def test_against_brute_force(spark):
    texts = cases.texts()
    texts[13], texts[14] = "only four words here", "Only FOUR words, here!"
    docs = land(cases.documents(spark, texts), "docs")
    got = neardup.near_classes(docs).select("_id", "_class", "_size").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_force([(r.doc_id, r.text) for r in docs.collect()])
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {2, 3, 4} < {r.doc_id for r in kept.collect()} and not {20, 31, 32} & {r.doc_id for r in kept.collect()}
    assert kept.filter("doc_id = 7").count() == 1


def test_a_thousand_independent_edits_of_one_original(spark):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in rng.integers(0, 10**9, 400)]
    texts = [" ".join(words)]
    for copy in range(1000):
        changed = list(words)
        for k in range(8):  # 2 % of the words, at spread places: 0.82 to the original, 0.68 to one another
            changed[50 * k + int(rng.integers(5, 45))] = f"edit{copy}x{k}"
        texts.append(" ".join(changed))
    shingles = [neardup.labelled_shingles(neardup.word_hashes(t)) for t in texts[:3]]
    assert neardup.similar(shingles[0], shingles[1]) and not neardup.similar(shingles[1], shingles[2])
    docs = land(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5), "docs")
    got = neardup.near_classes(docs).filter("_class = 0").count()
    assert got >= 995  # a pair meets in no band with a probability of 0.0002


def test_all_members_of_a_bucket_are_compared(spark, monkeypatch):
    # alike are only the pairs (k, 99 - k), which are neither neighbours nor the first of the bucket but for two
    monkeypatch.setattr(components_module, "ROUND", 500)
    buckets = land(spark.createDataFrame([(7, i) for i in range(100)] + [(8, 5), (8, 6)], "bucket long, id long").repartition(4), "buckets")
    pairs = land(candidate_pairs(buckets), "pairs")
    roots = components_module.linked(buckets, pairs, lambda some: some.filter("a + b = 99")).collect()
    assert {(r.id, r.root) for r in roots} == {(k, min(k, 99 - k)) for k in range(100)}


def test_alignment_counts_order():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 100).astype(np.uint64)
    assert neardup.aligned(a, a) == 100 and neardup.similar(a, a)
    assert not neardup.similar(a, a[::-1].copy())
    b = np.concatenate([a[:40], rng.integers(0, 2**63, 10).astype(np.uint64), a[40:]])
    assert neardup.aligned(a, b) == 100 and neardup.similar(a, b)


def test_empty_table(spark):
    assert neardup.near_classes(cases.empty(spark)).collect() == []


def test_candidate_pairs_join_buckets_over_many_tasks(spark):
    rows = [(7, i) for i in range(3000)] + [(k, k) for k in range(10_000, 10_400)] + [(9, 5), (9, 2999), (8, 77_777)]
    buckets = land(spark.createDataFrame(rows, "bucket long, id long").repartition(7), "buckets")
    pairs = candidate_pairs(buckets)
    assert pairs.count() <= 2 * len(rows)
    roots = components(pairs).collect()
    assert {r.id for r in roots} == set(range(3000)) and {r.root for r in roots} == {0}


def test_pairs_join_keys_over_many_blocks_and_parts(monkeypatch):
    # blocks and parts of a few keys; no row of the shuffle for each key and id, and one at most of a block's heavy key
    monkeypatch.setattr(components_module, "DEALT", 60)
    rng = np.random.default_rng(5)
    keys = rng.integers(-300, 300, (500, 3))
    keys[:200, 0] = 7
    ids = rng.integers(0, 400, 500)  # some are repeated
    nested = [pa.record_batch([pa.array(keys[at : at + 10].tolist(), pa.list_(pa.int64())), pa.array(ids[at : at + 10])], ["keys", "id"]) for at in range(0, 500, 10)]
    dealt = pa.Table.from_batches(batch for start in (0, 25) for batch in components_module._deal(4)(iter(nested[start : start + 25])))
    assert dealt.num_rows <= 4 * 26 and len(dealt["keys"].combine_chunks().flatten()) < 0.95 * keys.size
    found = list(components_module._links(iter(dealt.sort_by("part").to_batches(max_chunksize=7))))
    pairs = {pair for batch in found for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())}
    buckets = defaultdict(set)
    for row, key in zip(ids.tolist(), keys.tolist()):
        for k in key:
            buckets[k].add(row)
    assert all(a < b and any({a, b} <= bucket for bucket in buckets.values()) for a, b in pairs)
    assert sum(batch.num_rows for batch in found) <= 2 * keys.size
    for bucket in buckets.values():  # the pairs within a bucket connect it
        seen, left = set(), [min(bucket)]
        while left:
            seen.add(x := left.pop())
            left += [y for pair in pairs if x in pair for y in pair if y in bucket and y not in seen]
        assert seen == bucket


def test_keys_are_paired_without_a_row_for_each(spark):
    signed = land(spark.createDataFrame([([k, k + 1], k) for k in range(50)], "keys array<long>, id long"), "signed")
    pairs = components_module.key_pairs(signed, 100)
    plan = pairs._jdf.queryExecution().toString()
    assert "Generate" not in plan and "rangepartitioning" not in plan
    assert {(r.a, r.b) for r in pairs.collect()} == {(k, k + 1) for k in range(49)}


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(100, 101), (101, 50), (5, 5)]])
def test_components(spark, edges):
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}
    for a, b in edges:
        if a != b:
            ra, rb = a, b
            while parent.setdefault(ra, ra) != ra:
                ra = parent[ra]
            while parent.setdefault(rb, rb) != rb:
                rb = parent[rb]
            parent[max(ra, rb)] = min(ra, rb)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    assert got == {x: root(x) for x in parent}


def test_plausible_pairs_miss_no_similar_pair_and_leave_out_most(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(words)]
    for _ in range(300):
        changed = list(words)
        for at in rng.integers(0, 120, rng.integers(1, 9)):
            changed[at] = f"edit{rng.integers(0, 40)}"
        texts.append(" ".join(changed))
    texts += [" ".join(f"v{k}x{i}" for i in range(40)) for k in range(20)]
    sets = [set(s.tolist()) for s in neardup.shingle_sets(texts)]
    pairs = [(a, b) for b in range(1, len(sets)) for a in range(1, b)]
    close = {(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    near = spark.createDataFrame([(0, k, k, True) for k in range(1, len(texts))], "ref long, id long, root long, outer boolean")
    table = spark.createDataFrame(list(enumerate(texts)), "id long, text string")

    def sides(some):
        both = some.join(table.withColumnRenamed("text", "right"), "id")
        return both.join(table.selectExpr("id AS ref", "text AS left"), "ref")

    got = {(r.a, r.b) for r in components_module.plausible(near, sides, neardup.shingle_sets).collect()}
    assert close <= got
    is_near = [len(s & sets[0]) >= 0.8 * len(s | sets[0]) for s in sets]
    far = [(a, b) for a, b in pairs if not (is_near[a] and is_near[b])]
    assert len(got.intersection(far)) < len(far) / 4


def test_blocks_of_edges(spark, monkeypatch):
    monkeypatch.setattr(components_module, "EDGES", 40)
    edges = [(i, i + 1) for i in range(100)] + [(200, i) for i in range(201, 260)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(101)}, **{i: 200 for i in range(200, 260)}}


def test_no_row_is_made_of_a_pair_that_is_not_similar(spark, monkeypatch):
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(120)]
    texts = [" ".join(words)]
    for _ in range(200):
        changed = list(words)
        for at in rng.integers(0, 120, rng.integers(1, 9)):
            changed[at] = f"edit{rng.integers(0, 40)}"
        texts.append(" ".join(changed))
    sets = [set(s.tolist()) for s in neardup.shingle_sets(texts)]
    close = {(a, b) for b in range(1, len(sets)) for a in range(1, b)
             if (a % 3 == 0 or b % 3 == 0) and a % 7 != b % 7 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    near = spark.createDataFrame([(0, k, k % 7, k % 3 == 0) for k in range(1, len(texts))], "ref long, id long, root long, outer boolean")
    table = spark.createDataFrame(list(enumerate(texts)), "id long, text string")

    def sides(some):
        both = some.join(table.withColumnRenamed("text", "right"), "id")
        return both.join(table.selectExpr("id AS ref", "text AS left"), "ref")

    for block, tokens in ((16, 1 << 19), (4, 1 << 19), (16, 2000)):  # one block, and several by rows or by members
        monkeypatch.setattr(components_module, "BLOCK", block)
        monkeypatch.setattr(components_module, "TOKENS", tokens)
        assert {(r.a, r.b) for r in components_module.plausible(near, sides, neardup.shingle_sets).collect()} == close
