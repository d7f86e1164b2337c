import hashlib
import re

from tests.llm import cases

from strandline.llm import contamination
from strandline.llm.common import KEY, keyed
from strandline.session import land


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_force(text, items):
    own, hit, found = words(text), set(), set()
    for item, benchmark in items:
        w = words(benchmark)
        if item is None or not w:
            continue
        size = min(13, len(w))
        for at in range(max(1, len(w) - 12)):
            window = w[at : at + size]
            for start in range(len(own) - size + 1):
                if own[start : start + size] == window:
                    hit |= set(range(start, start + size))
                    found.add(str(item))
    return len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(own)


def items(spark):
    rows = [(1, cases.prose(501, 40)), (2, "Ring, STONE river"), (10, cases.prose(502, 13)), (3, None), (4, ""), (None, "lost words here"),
            (5, cases.prose(503, 14)), (5, cases.prose(503, 14)), (6, "ÉLAN niño"), (7, "!!")]
    return spark.createDataFrame(rows, "item_id long, text string"), rows


def test_against_brute_force(spark):
    table, rows = items(spark)
    texts = cases.texts()
    texts[7] += " " + rows[0][1]
    texts[8] = rows[0][1].upper() + "\n" + rows[6][1]
    texts[9] += " ring stone river élan Niño"
    texts[10] = (rows[5 - 3][1] + " ") * 20
    texts[11] = " ".join(words(rows[0][1])[3:20])
    texts[12] = texts[12][:20_000] + rows[6][1]
    docs = land(cases.documents(spark, texts), "docs")
    found = keyed(docs, "doc_id", "text").join(contamination.contamination(docs, table), list(KEY)).collect()
    assert len(found) == docs.count()
    for row in found:
        want = brute_force(row.text, rows)
        assert (row._n_words, row._n_hit, row._n_items, row._items_sha256, row._contaminated) == want, row.doc_id
    kept = contamination.clean(docs, table)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if r._contaminated}


def test_index_counts_the_words_of_every_document(spark):
    table, _ = items(spark)
    docs = land(cases.documents(spark), "docs")
    terms = table.limit(0).selectExpr("text AS word", "item_id AS term")
    index = contamination.build_index(docs, terms)
    ends = index.filter(f"term = {contamination.END}").join(keyed(docs, "text"), list(KEY)).collect()
    assert len(ends) == docs.count() == index.count() and all(r.place == len(words(r.text)) for r in ends)


def test_proximity(spark):
    table = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    docs = land(spark.createDataFrame([(0, "one two extra three four five six"), (1, "six one far away two")], "doc_id long, text string"), "docs")
    rows = {r.doc_id: r for r in keyed(docs, "doc_id").join(contamination.contamination(docs, table), list(KEY)).collect()}
    assert (rows[0]._n_hit, rows[0]._n_near, rows[1]._n_near) == (0, 1, 0)


def test_empty_tables(spark):
    table, _ = items(spark)
    assert contamination.contamination(cases.empty(spark), table).collect() == []
    none = contamination.contamination(cases.documents(spark), table.filter("false")).collect()
    assert none and not any(r._n_hit or r._contaminated for r in none)
