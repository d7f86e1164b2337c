"""Language identification by cross-parsing: the language whose sample needs the fewest phrases to spell a text wins."""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import blocks, code_points, frugal, held_out, ready, table
from strandline.session import land

SEGMENT = 256  # symbols; texts are parsed in segments of this length, each starting a new phrase
SAMPLES, PIECE = 160, 200  # bounded sample: so many pieces of so many characters for each language
TABLE_CELLS = 1 << 25  # of a dense transition table; where more were needed, edges are searched for instead
UNKNOWN = "und"
MIN_PHRASE = 1.5  # symbols; texts with shorter phrases on average are in no known language


@dataclass(frozen=True)
class LanguageModel:
    """alphabet: lower-case letters, numbered from 1 (0 stands for anything between letters, the number after
    the last for letters unseen); of each language a suffix automaton, as flat arrays of (state, symbol, next)."""

    langs: tuple[str, ...]
    alphabet: str
    automata: tuple[tuple[int, np.ndarray], ...]  # number of states, edges
    sizes: tuple[int, ...]  # symbols in the sample


def normalise(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Symbols of lower-cased code points; a run of other characters is one 0."""
    symbols = codes[points]
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    return symbols[keep]


def code_table(alphabet: str) -> np.ndarray:
    """The symbol of every code point."""
    letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    codes = np.where(letters, len(alphabet) + 1, 0).astype(np.min_scalar_type(len(alphabet) + 1))
    codes[code_points(alphabet)] = np.arange(1, len(alphabet) + 1)
    return codes


def suffix_automaton(symbols: list[int]) -> tuple[int, np.ndarray]:
    """The number of states and the edges (state, symbol, next) of the automaton of all factors of a sequence."""
    nexts, link, length, last = [{}], [-1], [0], 0
    for symbol in symbols:
        now = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and symbol not in nexts[at]:
            nexts[at][symbol] = now
            at = link[at]
        if at != -1:
            other = nexts[at][symbol]
            if length[at] + 1 == length[other]:
                link[now] = other
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[other]))
                length.append(length[at] + 1)
                link.append(link[other])
                while at != -1 and nexts[at].get(symbol) == other:
                    nexts[at][symbol] = copy
                    at = link[at]
                link[other] = link[now] = copy
        last = now
    edges = [(state, symbol, to) for state, out in enumerate(nexts) for symbol, to in out.items()]
    return len(nexts), np.array(edges, np.int32).reshape(-1, 3)


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", samples: int = SAMPLES, piece: int = PIECE) -> LanguageModel:
    """Learn from a bounded sample of labelled rows: `samples` pieces of `piece` characters for each
    language, chosen by hashes of the texts over all rows. Rows without a text, a letter
    or a language teach nothing; without any row the model knows no language."""
    spark = rows.sparkSession
    ready(spark)
    known = rows.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l")).filter("t is not null and l is not null").filter(F.col("t").rlike("\\p{L}"))
    hashed = known.withColumn("h", F.xxhash64("t"))
    slots = hashed.groupBy("l", F.pmod("h", F.lit(samples)).alias("slot")).agg(F.min("h").alias("h"), F.count("*").alias("n"))
    slots = land(slots, "slots")
    langs = sorted(row["l"] for row in slots.select("l").distinct().collect())
    if not langs:
        return LanguageModel((), "", (), ())
    picked = slots.select("l", "h")
    picked = F.broadcast(picked) if len(langs) * samples < 500_000 else picked
    start = F.pmod(F.shiftright("h", 8), F.greatest(F.lit(1), F.length("t") - piece + 1)).cast("int") + 1
    pieces = (hashed.join(picked, ["l", "h"]).select("l", "h", F.substring("t", start, F.lit(piece)).alias("p"))
              .groupBy("l", "h").agg(F.min("p").alias("p")).toPandas().sort_values(["l", "h"]))
    pieces["p"] = pieces["p"].str.lower()
    alphabet = "".join(sorted(c for c in set("".join(pieces["p"])) if c.isalpha()))
    codes, automata = code_table(alphabet), []
    own = dict(list(pieces.groupby("l")["p"]))
    for name in langs:
        symbols = [normalise(code_points(p), codes) for p in own[name]]
        joined = np.concatenate([np.append(s, 0) for s in symbols])
        automata.append((*suffix_automaton(joined.tolist()), len(joined)))
    return LanguageModel(tuple(langs), alphabet, tuple(x[:2] for x in automata), tuple(x[2] for x in automata))


class Parser:
    """The model's automata as one table, dense or, with many languages or letters, of sorted edges; counts the
    phrases of many texts in step."""

    def __init__(self, model: LanguageModel):
        self.model, self.width, self.codes = model, len(model.alphabet) + 2, code_table(model.alphabet)
        states = np.array([n for n, _ in model.automata], np.int64)
        # state numbers are multiplied by the width
        self.roots = (np.cumsum(states) - states) * self.width
        self.dense = int(states.sum()) * self.width <= TABLE_CELLS
        places = [root + edges[:, 0].astype(np.int64) * self.width + edges[:, 1] for root, (_, edges) in zip(self.roots, model.automata)]
        to = [root + edges[:, 2].astype(np.int64) * self.width for root, (_, edges) in zip(self.roots, model.automata)]
        places, to = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (places, to))
        if self.dense:
            self.table = np.full(int(states.sum()) * self.width, -1, np.int32)  # -1: no such factor
            self.table[places] = to
        else:
            order = places.argsort()
            self.places, self.to = places[order], to[order]
        # after a mismatch the phrase starts anew at this symbol; one that a language lacks leads back to its root
        symbols = np.arange(self.width)
        self.again = np.stack([np.where((t := self._next(r + symbols)) < 0, r, t) for r in self.roots]) if len(self.roots) else None

    def _next(self, places: np.ndarray) -> np.ndarray:
        """The state that a state and a symbol (as their sum) lead to, or -1."""
        if self.dense:
            return self.table[places]
        at = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        return np.where(self.places[at] == places, self.to[at], -1)

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text the phrases in each language, the symbols and the letters."""
        n = len(texts)
        found, symbols, letters = np.zeros((n, len(self.model.langs)), np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for places, pieces in blocks(texts):
            parts = [normalise(code_points(p.lower()), self.codes) for p in pieces]
            lengths = np.array([len(p) for p in parts])
            np.add.at(symbols, places, lengths)
            np.add.at(letters, places, [int(np.count_nonzero(p)) for p in parts])
            flat = np.concatenate(parts)
            lanes = -(-lengths // SEGMENT)
            owner = np.repeat(np.array(places), lanes)
            within = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
            starts = np.repeat(np.cumsum(lengths) - lengths, lanes) + within * SEGMENT
            size = np.minimum(SEGMENT, np.repeat(lengths, lanes) - within * SEGMENT)
            order = np.argsort(-size, kind="stable")
            if self.again is not None and len(order):
                np.add.at(found, owner[order], self._parse(flat, starts[order], size[order]).T)
        return found, symbols, letters

    def _parse(self, flat: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        state = np.repeat(self.roots[:, None], len(starts), axis=1)
        phrases = np.ones(state.shape, np.int32)
        for step in range(int(size[0])):
            active = int(np.searchsorted(-size, -step, side="left"))
            symbol = flat[starts[:active] + step].astype(np.int64)
            to = self._next(state[:, :active] + symbol)
            lost = to < 0
            phrases[:, :active] += lost
            state[:, :active] = np.where(lost, self.again[:, symbol], to)
        return phrases


_parsers: dict[str, Parser] = {}


def _parser(token: str, pickled: bytes) -> Parser:
    """One parser for each worker process and model."""
    if token not in _parsers:
        _parsers.clear()
        _parsers[token] = Parser(pickle.loads(pickled))
    return _parsers[token]


def predict(rows: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The kept columns, lang_pred, score and phrase_length (mean symbols of a phrase in that language).

    A text is lower-cased, anything between its letters becomes one space, and segments of 256 symbols are
    parsed greedily into the longest factors of each language's sample. The language that needs fewest
    phrases for each symbol wins; of equals, the first by name. score: the winner's share if each phrase
    costs the logarithm of the sample's length. Null texts, texts without a letter, and all texts where no
    language is known get `und` with score 0. Texts of any length are parsed whole.
    """
    spark = rows.sparkSession
    ready(spark)
    pickled = pickle.dumps(model)
    shared, token = spark.sparkContext.broadcast(pickled), hashlib.sha1(pickled).hexdigest()

    @F.arrow_udf("lang_pred string, score double, phrase_length double")
    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        frugal()
        parser = _parser(token, shared.value)
        cost = np.log(np.maximum(2, np.array(parser.model.sizes, float)))
        names = np.array([*parser.model.langs, UNKNOWN], object)
        for texts in batches:
            found, symbols, letters = parser.phrases(texts.to_pylist())
            none = (letters == 0) | (found.shape[1] == 0)
            best, score, fewest = np.full(len(none), len(names) - 1), np.zeros(len(none)), np.zeros(len(none))
            if found.shape[1]:
                fewest = found.min(axis=1)
                best = np.where(none, best, found.argmin(axis=1))
                gap = (found - fewest[:, None]) * cost[None, :]
                score = np.where(none, 0.0, 1 / np.exp(-np.minimum(gap, 700)).sum(axis=1))
            length = np.where(none, 0.0, symbols / np.maximum(1, fewest))
            yield pa.StructArray.from_arrays(
                [pa.array(names[best], pa.string()), pa.array(score), pa.array(length)], names=["lang_pred", "score", "phrase_length"])

    # only the text goes to the workers
    found = rows.select(*keep, identify(F.col(text).cast("string")).alias("_found"))
    return found.select(*keep, "_found.lang_pred", "_found.score", "_found.phrase_length")


def learnable(docs: DataFrame) -> DataFrame:
    """Documents to learn from: those not held out."""
    return docs.filter(~held_out(F.col("doc_id")))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score and phrase_length of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit(learnable(docs))
    found = predict(docs, model, keep=("doc_id",))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "phrase_length")


def known_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents in a known language: without those that are `und` or fall into phrases of less than 1.5 symbols."""
    whole = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text"))
    found = predict(whole, model, text="_text", keep=("_row",))
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("phrase_length") >= MIN_PHRASE)).select("_row.*")
