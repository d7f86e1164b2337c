import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from tests.llm import cases

from strandline.llm import language
from strandline.llm.common import held_out


def sample(kind, seed, n):
    letters = {"de": "äöüschtenri", "fr": "éèçeaulqoi"}[kind]
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list(letters), rng.integers(2, 8))) for _ in range(n))


def training(spark):
    rows = [(i, sample("de" if i % 2 else "fr", i, 80), "de" if i % 2 else "fr") for i in range(60)]
    return spark.createDataFrame([*rows, (900, None, "fr"), (901, "no label", None), (902, "1234 !", "xx")], "doc_id long, text string, lang string")


def phrases(text, factors):
    """Greedy parsing of segments of 256 symbols, on the set of all factors of a sample."""
    n = 0
    for at in range(0, len(text), 256):
        segment, start = text[at : at + 256], 0
        n += 1
        for end in range(1, len(segment) + 1):
            if segment[start:end] not in factors:
                n += 1
                start = end - 1 if segment[end - 1] in factors else end
    return n


def test_phrases_against_brute_force(spark):
    model = language.fit(training(spark), samples=8, piece=40)
    assert model.langs == ("de", "fr")
    codes = language.code_table(model.alphabet)
    texts = [sample("de", 1001, 90), sample("fr", 1002, 300), "Äh! Ça va? zzz 123", "x", ""]
    parser = language.Parser(model)
    found, symbols, letters = parser.phrases(texts)
    for k, (states, edges) in enumerate(model.automata):
        step = {}
        for a, c, b in edges.tolist():
            step.setdefault(a, {})[c] = b

        class Factors:
            def __contains__(self, run):
                at = 0
                for c in run:
                    at = step.get(at, {}).get(c)
                    if at is None:
                        return False
                return True

        class One(Factors):
            def __contains__(self, run):
                return super().__contains__(run if isinstance(run, tuple) else (run,))

        for i, text in enumerate(texts):
            own = tuple(language.normalise(language.code_points(text.lower()), codes).tolist())
            assert found[i, k] == phrases(own, One()) and symbols[i] == len(own)


def test_suffix_automaton_holds_all_factors_and_no_other():
    rng = np.random.default_rng(5)
    text = rng.integers(0, 3, 60).tolist()
    states, edges = language.suffix_automaton(text)
    step = {(a, c): b for a, c, b in edges.tolist()}
    factors = {tuple(text[i:j]) for i in range(60) for j in range(i + 1, 61)}
    for run in {*factors, *(tuple(rng.integers(0, 3, rng.integers(1, 9)).tolist()) for _ in range(300))}:
        at = 0
        for c in run:
            at = step.get((at, c), -1) if at >= 0 else -1
        assert (at >= 0) == (run in factors)


def test_held_out_accuracy_and_awkward_texts(spark):
    model = language.fit(training(spark))
    more = spark.createDataFrame([(2000 + i, sample("de" if i % 2 else "fr", 5000 + i, 12)) for i in range(80)], "doc_id long, text string")
    got = language.predict(more, model, keep=("doc_id",)).collect()
    assert sum(r.lang_pred == ("de" if r.doc_id % 2 else "fr") for r in got) >= 76
    assert all(0 <= r.score <= 1 for r in got)
    odd = {r.doc_id: r for r in language.predict(cases.documents(spark), model, keep=("doc_id", "_row", "score")).drop("score").collect()}
    assert {odd[i].lang_pred for i in (2, 3, 4, 5)} == {"und"} and odd[12].lang_pred in model.langs and odd[1]._row == "clash"
    assert language.predict(cases.empty(spark), model, keep=("doc_id",)).collect() == []


def test_no_training_rows(spark):
    model = language.fit(training(spark).filter("false"))
    assert {r.lang_pred for r in language.predict(cases.documents(spark), model, keep=("doc_id",)).collect()} == {"und"}


def test_filter_keeps_columns(spark):
    docs = cases.documents(spark)
    kept = language.known_language(docs, language.fit(language.learnable(docs)))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == {2, 3, 4, 5}


def test_held_out_rule(spark):
    rows = spark.range(50).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_no_language_and_no_letter_is_left_out(spark, monkeypatch):
    # 70 languages, and two whose letters are thousands of Chinese characters each from the same range
    rng = random.Random(8)
    def words(letters):
        return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(60)]
    spoken = {f"l{k:02d}": words("abcdefghijklmnopqrstuvwxyz") for k in range(70)}
    han = [chr(0x4E00 + k) for k in range(4000)]
    rng.shuffle(han)
    spoken |= {"han0": words(han[:2000]), "han1": words(han[2000:])}
    def speak(name):
        return " ".join(rng.choice(spoken[name]) for _ in range(80))
    rows = [(speak(name), name) for name in spoken for _ in range(3)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert set(model.langs) == set(spoken)
    assert set("".join(w for words in spoken.values() for w in words)) >= set(model.alphabet) and len(model.alphabet) > 250
    asked = [speak(name) for name in spoken]
    monkeypatch.setattr(language, "TABLE_CELLS", 0)
    sparse = language.Parser(model)
    found = sparse.phrases(asked)[0]
    assert [model.langs[k] for k in found.argmin(axis=1)] == list(spoken)
    monkeypatch.setattr(language, "TABLE_CELLS", 1 << 40)
    small = language.LanguageModel(model.langs[:3], model.alphabet, model.automata[:3], model.sizes[:3])
    dense = language.Parser(small)
    assert dense.dense and not sparse.dense and (dense.phrases(asked)[0] == found[:, :3]).all()
