"""A quality classifier: histogram gradient-boosted trees over statistics of the texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import BLOCK, code_points, held_out, mix, ready, table

SAMPLE_ROWS = 20_000  # labelled documents to learn from, at most; chosen by a hash of their ids
TREES, DEPTH, RATE, BINS, LEAST = 60, 3, 0.2, 63, 20.0
FEATURES = (
    "log_chars", "letters", "upper_of_letters", "digits", "newlines", "stops", "symbols", "other", "log_words", "word_length",
    "word_length_spread", "distinct_words", "repeated_words", "symbol_ended_words", "wordless_words", "log_line_length",
)

_LOWER, _UPPER, _DIGIT, _SPACE, _NEWLINE, _STOP, _SYMBOL, _OTHER = range(8)


@lru_cache(1)
def _kinds() -> np.ndarray:
    """The kind of every code point."""
    kinds = np.full(0x110000, _OTHER, np.uint8)
    for c in range(0x110000):
        char = chr(c)
        if char.isalpha():
            kinds[c] = _UPPER if char.isupper() else _LOWER
        elif char.isdigit():
            kinds[c] = _DIGIT
        elif char == "\n":
            kinds[c] = _NEWLINE
        elif char.isspace():
            kinds[c] = _SPACE
        elif char in ".,;:?'\"()-":
            kinds[c] = _STOP
        elif c < 128:
            kinds[c] = _SYMBOL
    return kinds


def statistics(text: str | None) -> np.ndarray:
    """The features of a text, in blocks that end between words; a null or empty text has zeros."""
    text = text or ""
    counts, n_words, total, squares, repeated, symbol_ended, wordless = np.zeros(8), 0, 0.0, 0.0, 0, 0, 0
    seen, before, at = [], None, 0
    while at < len(text):
        end = min(len(text), at + BLOCK)
        while end < len(text) and not text[end - 1].isspace():
            end += 1
        points = code_points(text[at:end])
        at = end
        kinds = _kinds()[points]
        counts += np.bincount(kinds, minlength=8)
        inside = (kinds != _SPACE) & (kinds != _NEWLINE)
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            continue
        sizes = ends - starts
        places = np.flatnonzero(inside)
        offset = (places - np.repeat(starts, sizes)).astype(np.uint64)
        first = np.cumsum(sizes) - sizes
        hashes = np.add.reduceat(mix(points[places].astype(np.uint64) + (offset << np.uint64(32))), first)
        n_words += len(sizes)
        total += sizes.sum()
        squares += (sizes.astype(float) ** 2).sum()
        repeated += int(np.count_nonzero(hashes[1:] == hashes[:-1])) + int(before is not None and before == hashes[0])
        before = hashes[-1]
        symbol_ended += int(np.count_nonzero(kinds[ends - 1] == _SYMBOL))
        wordless += int(np.count_nonzero(np.maximum.reduceat((kinds[places] <= _DIGIT).astype(np.int8), first) == 0))
        seen.append(np.unique(hashes))
    n, words = max(1.0, counts.sum()), max(1, n_words)
    distinct = len(np.unique(np.concatenate(seen))) if seen else 0
    letters = counts[_LOWER] + counts[_UPPER]
    mean = total / words
    return np.array([
        np.log1p(counts.sum()), letters / n, counts[_UPPER] / max(1.0, letters), counts[_DIGIT] / n, counts[_NEWLINE] / n, counts[_STOP] / n,
        counts[_SYMBOL] / n, counts[_OTHER] / n, np.log1p(n_words), mean, np.sqrt(max(0.0, squares / words - mean * mean)),
        distinct / words, repeated / words, symbol_ended / words, wordless / words, np.log1p(n / (1 + counts[_NEWLINE])),
    ])


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth as flat arrays: feature and threshold of each inner node, value of each leaf."""

    prior: float
    feature: np.ndarray  # trees x (2^depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2^depth

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The probability of label 1 of each row; all rows and trees go down a level at a time."""
        total = np.full(len(rows), self.prior)
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[node]] > threshold[node])
            total += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def boost(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Boosted trees on histograms of binned features, for the logistic loss. With one kind of label only, or
    none, every row has the prior: that label's, or one half."""
    share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.5
    prior, inner, leaves = float(np.log(share / (1 - share))), 2**DEPTH - 1, 2**DEPTH
    if len(np.unique(labels)) < 2:
        return Trees(prior, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in rows.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, rows.T)], axis=1)
    raw = np.full(len(rows), prior)
    features, thresholds, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        g, h = labels - p, p * (1 - p)
        feature, threshold, cut = np.zeros(inner, np.int64), np.full(inner, np.inf), np.full(inner, BINS + 1)
        node = np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            base, width = 2**level - 1, 2**level
            local = node - base
            best = np.full(width, 1e-6)
            for k in range(rows.shape[1]):
                spot = local * (BINS + 1) + binned[:, k]
                gs, hs, ns = (np.bincount(spot, w, width * (BINS + 1)).reshape(width, -1).cumsum(axis=1) for w in (g, h, None))
                gl, hl, nl = gs[:, :-1], hs[:, :-1], ns[:, :-1]
                gt, ht, nt = gs[:, -1:], hs[:, -1:], ns[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(nl < LEAST) | (nt - nl < LEAST)] = 0
                gain[:, len(edges[k]):] = 0
                top = gain.argmax(axis=1)
                value = gain[np.arange(width), top]
                for j in np.flatnonzero(value > best):
                    best[j], feature[base + j], cut[base + j], threshold[base + j] = value[j], k, top[j], edges[k][top[j]]
            node = 2 * node + 1 + (binned[np.arange(len(rows)), feature[node]] > cut[node])
        spot = node - inner
        leaf = RATE * np.bincount(spot, g, leaves) / (np.bincount(spot, h, leaves) + 1)
        raw += leaf[spot]
        features.append(feature)
        thresholds.append(threshold)
        values.append(leaf)
    return Trees(prior, np.array(features), np.array(thresholds), np.array(values))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(text).tolist() for text in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["y", "x"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Learn from at most `sample_rows` labelled documents, chosen by a hash of their ids over all labels that
    aren't held out; each document teaches once. Null labels teach nothing."""
    spark = docs.sparkSession
    ready(spark)
    chosen = (labels.select("doc_id", F.col("quality").cast("int").alias("y")).filter("y in (0, 1) and doc_id is not null")
              .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.select(F.struct("doc_id", "y").alias("y"), "text").mapInArrow(_features, "y struct<doc_id:bigint,y:int>, x array<double>")
    got = rows.groupBy("y.doc_id", "y.y").agg(F.min("x").alias("x")).toPandas().sort_values("doc_id")
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES))
    return boost(x, got["y"].to_numpy(float))


def score(docs: DataFrame, trees: Trees, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The kept columns and `score`, the probability that a text's quality is 1. Null and empty texts are
    scored by their statistics, all zero; texts of any length count whole; repeated rows score alike."""
    ready(docs.sparkSession)
    inner = docs.select(F.struct(*(keep or [F.lit(1).alias("one")])).alias("_kept"), F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(text) for text in batch.column(1).to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.record_batch([batch.column(0), pa.array(trees.score(rows))], ["_kept", "score"])

    schema = f"_kept {inner.schema['_kept'].dataType.simpleString()}, score double"
    return inner.mapInArrow(run, schema).select(*(f"_kept.`{c}`" for c in keep), "score")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted quality of every document."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")), keep=("doc_id",))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
