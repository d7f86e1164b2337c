import hashlib
import re

from tests.llm import cases

from strandline.llm import pii
from strandline.llm.common import KEY, keyed
from strandline.session import land

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]
ODD = [
    "a@b.c@d.e x@a.b_c@d.e", "1.2.3.4.5.6.7.8 999.1.1.1 1.2.3 000.1.2.0255", "4111 1111 1111 1111 4111-1111-1111-1111x44785380592391139",
    "+1 (743) 555-3824 +1-23 +", "é" * 5 + " ü@x.de a.b@c-d.co.uk.", "9" * 3000, "a" * 5000 + "@b.c", "a@b.cc " * 3000, "1 " * 20_000,
    "+1 234 567 8901 +49 (0) 30 1234567.", "😀 a@b.co 😀 +1 234 567 8901", "a." * 20_000 + "b@c" + ".d" * 20_000,
]


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(digits[::-1])) % 10 == 0


def brute_force(text):
    spans = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            passes = (True, kind == 1 and all(int(x) <= 255 for x in m[0].split(".")), 14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15)
            if passes[kind]:
                spans.append((m.start(), kind, m.end()))
    return sorted(spans)


def test_against_brute_force(spark):
    docs = land(cases.documents(spark, ODD + cases.texts()), "docs")
    rows = keyed(docs, "doc_id", "text").join(pii.personal_data(docs), list(KEY)).collect()
    assert len(rows) == docs.count()
    for row in rows:
        want = brute_force(row.text)
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert [row._n_email, row._n_ip, row._n_card, row._n_phone] == [sum(k == kind for _, k, _ in want) for kind in range(4)], row.doc_id
        assert row._base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(row._spans.split(","))


def test_trees_add_loose_phones_only_where_nothing_else_stands(spark):
    good = [f"call +1 (555) {200 + i}-{1000 + i} today" for i in range(400)]
    bad = [f"sum +{i % 9}-1 of {i}" for i in range(400)]
    texts = good + bad + ["call (555) 201-1234 now", "call +1 (555) 201-1234 now"]
    docs = land(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "docs")
    rows = {r.doc_id: r for r in keyed(docs, "doc_id").join(pii.personal_data(docs), list(KEY)).collect()}
    assert rows[800]._spans == "phone:5:19" and rows[800]._n_phone == 0
    assert rows[801]._spans == "phone:5:22" and rows[801]._n_phone == 1
    assert all(rows[i]._n_phone == 1 for i in range(400)) and not any(rows[i]._spans for i in range(400, 800))


def test_trees_learn_from_every_strict_match(spark):
    # more matches than a bounded sample would hold, in few distinct kinds
    docs = spark.range(24_000).selectExpr("id AS doc_id", "concat('call +1 (555) ', 200 + id % 700, '-', 1000 + id % 9000, ' or +1-', id % 9, ' now') AS text")
    found = land(pii.candidates(land(docs, "docs")), "candidates")
    rows, names = pii.examples(found)
    held = rows.groupBy("label").agg({"n": "sum"}).collect()
    assert {r.label: r["sum(n)"] for r in held} == {1.0: 24_000, 0.0: 24_000} and found.filter("strict").count() == 48_000
    assert len(names) + 3 == len(rows.columns) and rows.count() < 2000


def test_empty_table(spark):
    assert pii.personal_data(cases.empty(spark)).collect() == []
