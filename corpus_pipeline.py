"""From raw documents to token ids: language ID, line dedup, near-dedup, decontamination, byte-level BPE."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import bpe, contamination, language, lines, neardup
from strandline.llm.common import table
from strandline.session import LANDED, land, remove_landed

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[str] = []


def tidy(stage: Stage) -> Stage:
    """A stage that first deletes the intermediate tables of the stage before, whose result is written by then."""

    @wraps(stage)
    def tidied(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_landed(spark, [path for path in _left if path in LANDED])
        _left.clear()
        known = len(LANDED)
        try:
            return stage(spark, docs, sf_dir)
        finally:
            _left.extend(LANDED[known:])

    return tidied


@tidy
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language known from the labelled documents of the input; the others go."""
    return language.known_language(docs, language.fit(language.learnable(docs)))


@tidy
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line stands for; those that lose every line with content go."""
    rows = lines.dedup_lines(docs)
    left = (F.col("_n_gone") == 0) | F.col("_text").rlike("\\S")
    return rows.filter(left).select(*(F.col("_text").alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns))


@tidy
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one of the least id; documents without words stay."""
    return neardup.one_of_each(docs)


@tidy
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark windows don't contaminate."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


@tidy
def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, the token ids, and the digest of the bytes decoded from them."""
    back = bpe.round_trip(docs, keep=("doc_id", "lang", "source"))
    return back.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("language ID", language_id), ("line dedup", line_dedup), ("near-dedup", near_dedup), ("decontamination", decontamination),
    ("byte-level BPE", byte_bpe),
]
# The stages learn a model, verify similarities and fold merges, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents one after the other, each result written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = land(docs, "stage")
    return docs
