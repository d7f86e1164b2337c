import numpy as np
from tests.llm import cases

from strandline.llm import quality


def test_held_out_accuracy(spark):
    texts = [cases.prose(i, 60) if i % 3 else cases.prose(i, 60).replace(" ", "!! ").upper() for i in range(300)]
    docs = cases.documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    trees = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, trees, keep=("doc_id",)).collect()}
    assert sum((got[i] >= 0.5) == (i % 3 > 0) for i in range(300)) >= 297
    odd = {r.doc_id: r.score for r in quality.score(cases.documents(spark), trees, keep=("doc_id",)).collect()}
    assert len(odd) == 35 and all(0 <= s <= 1 for s in odd.values()) and odd[2] == odd[3]


def test_flat_arrays_equal_a_walk():
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(500, 16))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 5] > 0.5)).astype(float)
    trees = quality.boost(rows, labels)
    scores = trees.score(rows)
    assert ((scores >= 0.5) == (labels == 1)).mean() > 0.95
    for i in range(0, 500, 50):
        total = trees.prior
        for feature, threshold, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if rows[i, feature[node]] > threshold[node] else 1)
            total += leaf[node - len(feature)]
        assert abs(scores[i] - 1 / (1 + np.exp(-total))) < 1e-12


def test_one_label_none_and_empty(spark):
    docs = cases.documents(spark)
    labels = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id long, quality int")
    assert min(r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()) > 0.5
    assert {r.score for r in quality.score(docs, quality.fit(docs, labels.filter("false"))).collect()} == {0.5}
    assert quality.score(cases.empty(spark), quality.fit(docs, labels)).collect() == []


def test_statistics_of_blocks(monkeypatch):
    text = cases.prose(3, 500) + " " + "same " * 40
    whole = quality.statistics(text)
    monkeypatch.setattr(quality, "BLOCK", 100)
    assert np.allclose(quality.statistics(text), whole)
