import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strandline.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    """Conversations by id, rebuilt, from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = own.get(base, [])[:h] + turns[h:]
    return made


def brute(made):
    """Rows of the trie, node by node."""
    members = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[tuple(made[c][:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        gain = (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += gain
            leaves[node[:d]] += not children[node]
    return sorted(
        (convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(str(c) for c in convs if len(made[c]) == len(node)).encode()).hexdigest())
        for node, convs in members.items())


def got(spark, rows, width, at_once):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("place", "id", "block", "key", "n", "base", "run", "file", "at")})
    turns, lengths = trie.rebuilt(trie.numbered_turns(frame))
    found = trie.prefix_trie(turns, lengths, width, at_once)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, found.collect()))


def random_rows(seed):
    """Few texts, so that beginnings are shared; copies of whole conversations, nulls, ties and repeated turns."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(40), -7, 10**12]:
        n = rng.choice([1, 2, 3, 5, 9, 14, 30])
        rows += [(c, t, rng.choice(["user", "user", None]), rng.choice(["a", "bé", "", None])) for t in range(n)]
    long = [("user", rng.choice("xy")) for _ in range(60)]
    for c in (45, 50, 55, 60, 61, 62, 70):
        rows += [(c, t, *turn) for t, turn in enumerate(long[: 60 if c < 60 else 50])]
    rows += [(3, None, "system", "z"), (3, None, "system", "y"), (8, 1, "user", "tie"), (8, 1, "user", "tie"), (None, 0, "user", "lost")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("width", "at_once"), [(32, 1 << 14), (3, 4), (2, 7), (8, 1)])
def test_equals_brute_force(spark, width, at_once):
    rows = random_rows(width)
    assert got(spark, rows, width, at_once) == brute(rebuilt(rows))


def test_one_beginning_shared_by_all_and_turnless_conversations(spark):
    rows = [(c, 0, "user", "only") for c in range(300) if c % 10] + [(c, 1, "user", "more") for c in range(0, 300, 3) if c % 10]
    want = brute(rebuilt(rows))
    assert any(len(turns) == 0 for turns in rebuilt(rows).values())
    assert got(spark, rows, 4, 16) == want


def test_empty_table(spark):
    assert got(spark, [], 4, 16) == []
    assert got(spark, [(None, 1, "user", "x")], 4, 16) == []
