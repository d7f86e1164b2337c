import random

import pyarrow as pa
from pyspark.sql import functions as F
from tests.llm import cases

from strandline.llm import lines


def shingles(line):
    return {line[i : i + 8] for i in range(len(line) - 7)} or {line}


def brute_force(rows):
    """The texts after dedup, of rows (doc_id, text) in the order of their places."""
    spots = [((i is None, i or 0, at, n), line.strip(" \t\r\f\v")) for at, (i, t) in enumerate(rows) if t is not None for n, line in enumerate(t.split("\n"))]
    spots = [s for s in spots if s[1]]
    distinct = sorted({line for _, line in spots})
    parent = {line: line for line in distinct}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {line: shingles(line) for line in distinct}
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            shared = len(sets[a] & sets[b])
            if shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared):
                parent[root(a)] = root(b)
    best = {}
    for spot, line in spots:
        best[root(line)] = min(best.get(root(line), spot), spot)
    gone = {(spot[2], spot[3]) for spot, line in spots if best[root(line)] != spot}
    return [None if t is None else "\n".join(line for n, line in enumerate(t.split("\n")) if (at, n) not in gone) for at, (_, t) in enumerate(rows)]


def test_against_brute_force(spark):
    texts = cases.texts()
    texts[12] = cases.prose(12, 2000)
    long = cases.prose(40, 60).replace("\n", " ")
    near = long[:100] + "x" + long[101:]
    texts[14] = f"{long}\n\n  {near}\t\nab\nab\nabc\n"
    texts[15] = f"{near}\n\n\nunlike"
    texts[16] = "\n".join(["same line over and over"] * 50)
    docs = cases.documents(spark, texts).coalesce(1)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = lines.dedup_lines(docs).select("_row.doc_id", "_row._row", "_text", "_n_gone", "_n_lines").collect()
    assert sorted(((r.doc_id, r._text) for r in got), key=str) == sorted(zip((i for i, _ in rows), brute_force(rows)), key=str)
    assert {r._row for r in got} == {"clash"}
    assert next(r for r in got if r.doc_id == 16)._n_lines == 50


def test_hubs_and_templated_lines_against_brute_force(spark):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz "
    hub = "".join(rng.choice(letters) for _ in range(320)).strip()
    rows = [hub]
    for _ in range(150):  # four changes: 0.81 to the hub, 0.67 to one another
        changed = list(hub)
        for k in range(4):
            changed[70 * k + rng.randint(10, 60)] = rng.choice("0123456789#+")
        rows.append("".join(changed))
    # lines of one template, most pairs below 0.8 and some above
    template = "".join(rng.choice(letters) for _ in range(60))
    for k in range(150):
        rows.append(f"{template} request {rng.randint(0, 40):04d} took {rng.randint(0, 5)} ms at node {rng.choice('abcdef') * 6} {template[:40]}")
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, "\n".join(rows[i * 10 : i * 10 + 10])) for i in range(31)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r._text for r in lines.dedup_lines(docs).select("_row.doc_id", "_text").collect()}
    want = brute_force([(r.doc_id, r.text) for r in docs.collect()])
    left, wanted = (sorted(line for t in texts for line in t.split("\n") if line) for texts in (got.values(), want))
    assert len(left) <= len(wanted) + 2 and set(wanted) <= set(left)  # a pair at 0.8 meets in no band with 0.005


def test_empty_table(spark):
    assert lines.dedup_lines(cases.empty(spark)).collect() == []


def test_a_line_longer_than_a_block():
    block = "ab cd" * 300_000
    keys = lines.band_keys([block + "tail", "other", block + "tail"])
    assert (keys[0] == keys[2]).all() and (keys[0] != keys[1]).any()


def test_lines_are_split_as_spark_splits_them(spark):
    texts = [None, "", "\n", "a\n\n \u00a0b\t\n", "\r\n c d \x0b\x0c\n", "\u2003e\u2003", "end\n", "é\n日本\r"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", F.posexplode(F.split("text", "\n")).alias("n", "line"))
    trimmed = docs.withColumn("line", F.btrim("line", F.lit(" \t\r\f\v\u00a0"))).filter("line <> ''")
    places, numbers, found = lines._lines(pa.array(texts, pa.large_string()))
    assert list(zip(places.tolist(), numbers.tolist(), found.to_pylist())) == [tuple(r) for r in trimmed.orderBy("id", "n").collect()]


def test_texts_that_are_no_utf8(spark):
    docs = spark.sql("select * from values (1L, cast(X'61FF0A6262' as string)), (2L, 'bb\n\nbb') as t(doc_id, text)")
    got = lines.dedup_lines(docs).select("_row.doc_id", "_n_lines", "_n_gone").collect()
    assert sorted(map(tuple, got)) == [(1, 2, 0), (2, 3, 2)]


def test_sets_of_shingles_are_sorted_line_by_line(monkeypatch):
    # sorting all lines of a block by two keys took most of the time of a verification
    monkeypatch.setattr(lines.np, "lexsort", None)
    texts = ["ab", "abcdefgh" * 9, "x" * 70_000 + "y", "some line of words"]
    for text, found in zip(texts, lines.shingle_sets(texts)):
        assert len(found) == len(shingles(text)) and (found[1:] > found[:-1]).all()
