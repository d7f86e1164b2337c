"""Benchmark decontamination over a positional inverted index, with DataFrame functions only.

The index is a table with a posting (row, term, place) for each place of a benchmark term in a document. A
window of benchmark words starts from the list of its rarest term, moved back by the term's place in the
window; the lists of its other terms, moved back likewise, are intersected with it. Where all meet is an
exact phrase; where all lie within a few places of that, a proximity match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import KEY, key_filter, keyed, maybe_in, stored, table
from strandline.session import land

WINDOW = 13
SLOP = 3  # places by which a proximity match may move a term
MAX_SHARE = 20  # contaminated: at least one word in so many is hit
END = -1  # the term of the posting after a document's last word
BROADCAST_ROWS = 300_000  # tables of benchmark terms are broadcast up to so many narrow rows; larger ones are shuffled

_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def raw_words(text: Column) -> Column:
    """The words of a text, letters as they are; null has none."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.array().cast("array<string>"))


def lowered(word: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, _UPPER, _LOWER))


def _sized(rows: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The rows, to be broadcast if there are few of them."""
    return F.broadcast(rows) if rows.limit(limit + 1).count() <= limit else rows


def windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """(win, items, words): each distinct window, numbered, with the items it stands in.

    An item of fewer words than a window, but not none, is one window.
    """
    words = items.select(F.col(item_id).cast("string").alias("item"), raw_words(F.col(text)).alias("raw")).filter("size(raw) > 0 and item is not null")
    words = words.select("item", F.transform("raw", lowered).alias("all"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - size, F.lit(0)))
    each = words.select("item", "all", F.explode(starts).alias("start")).select("item", F.slice("all", F.col("start") + 1, size).alias("words"))
    grouped = each.groupBy("words").agg(F.collect_set("item").alias("items"))
    return land(grouped.select(F.monotonically_increasing_id().alias("win"), "items", "words"), "windows")


def build_index(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """The stored index (_f, _r, term, place) of the given terms (word, term) over whole documents.

    Each document also has a posting of the term END at the place after its last word, so its words are found and counted in one pass.
    """
    # no word is empty, so the empty string marks the end
    places = keyed(docs, F.posexplode(F.concat(raw_words(F.col(text)), F.array(F.lit("")))).alias("place", "raw"))
    named = places.select(*KEY, "place", lowered(F.col("raw")).alias("word"))
    ended = terms.unionByName(docs.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(END).cast("long").alias("term")))
    return land(named.join(_sized(ended), "word").select(*KEY, "term", "place"), "index")


def matches(index: DataFrame, spelled: DataFrame) -> DataFrame:
    """(_f, _r, win, start, length, exact) of exact phrases and proximity matches.

    `spelled` has a row (win, term, offset) for each term of each window.
    """
    counts = land(index.groupBy("term").agg(F.count("*").alias("n")), "counts")
    counted = spelled.join(_sized(counts), "term")
    sizes = spelled.groupBy("win").agg(F.count("*").alias("size"))
    # a window with a term that no document has cannot occur
    rarest = (counted.groupBy("win").agg(F.min(F.struct("n", "term", "offset")).alias("least"), F.count("*").alias("there"))
              .join(sizes, "win").filter("there = size").select("win", "size", "least.term", "least.offset"))
    rarest = land(rarest, "rarest")
    start = (F.col("place") - F.col("offset")).alias("start")
    started = land(index.join(_sized(rarest), "term").select(*KEY, "win", "size", start).filter("start >= 0"), "starts")
    thin = maybe_in(index.withColumn("_row", F.xxhash64(*KEY)), "_row", key_filter(started.select(F.xxhash64(*KEY).alias("k")), "k"))
    # places are joined by runs of eight, so a frequent term of a long document meets few of them
    due = started.join(_sized(spelled), "win").withColumn("due", F.col("start") + F.col("offset"))
    runs = F.array_distinct(F.array(F.floor((F.col("due") - SLOP) / 8), F.floor((F.col("due") + SLOP) / 8)))
    due = due.select(*KEY, "win", "size", "start", "term", "offset", "due", F.explode(runs).alias("run"))
    met = due.join(thin.withColumn("run", F.floor(F.col("place") / 8)), [*KEY, "term", "run"]).filter(F.abs(F.col("place") - F.col("due")) <= SLOP)
    seen = met.groupBy(*KEY, "win", "start", "size").agg(
        F.sum((F.col("place") == F.col("due")).cast("int")).alias("at"), F.bit_or(F.expr("shiftleft(1L, offset)")).alias("near"))
    return seen.filter((F.col("at") == F.col("size")) | (F.bit_count("near") == F.col("size"))).select(
        *KEY, "win", "start", F.col("size").cast("int").alias("length"), (F.col("at") == F.col("size")).alias("exact"))


def covered(spans: Column) -> Column:
    """How many places sorted (start, length) spans cover together."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(spans, zero, lambda acc, span: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), span["start"] + span["length"] - F.greatest(acc["end"], span["start"].cast("long")))).alias("n"),
        F.greatest(acc["end"], (span["start"] + span["length"]).cast("long")).alias("end")))["n"]


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(_f, _r, _n_words, _n_hit, _n_items, _items_sha256, _contaminated, _n_near) for each row of docs.

    A word of a document is hit if it stands in an occurrence of a window: 13 words that follow one another
    in an item, or the whole of a shorter one. _n_near counts the items that have proximity matches only: all
    words of a window within three places of where they should stand. Null and empty texts have no words and
    are clean. Items that are null, or have no words or no id, have no window; copies of an item with one id
    count once. Repeated rows are counted each by itself. Without any window all documents are clean.
    """
    docs = stored(docs)
    found = windows(items, item_id, item_text)
    terms = land(found.select(F.explode("words").alias("word")).distinct().select("word", F.monotonically_increasing_id().alias("term")), "terms")
    spelled = land(found.select("win", F.posexplode("words").alias("offset", "word")).join(terms, "word").select("win", "term", "offset"), "spelled")
    index = build_index(docs, terms, text)
    hits = matches(index.filter(F.col("term") != END), spelled).join(_sized(found.select("win", "items")), "win")
    by_row = hits.groupBy(*KEY).agg(
        F.array_sort(F.collect_set(F.when(F.col("exact"), F.struct("start", "length")))).alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("exact"), F.col("items")))))).alias("_items"),
        F.array_distinct(F.flatten(F.collect_set(F.when(~F.col("exact"), F.col("items"))))).alias("_near"))
    rows = index.filter(F.col("term") == END).select(*KEY, F.col("place").cast("long").alias("_n_words"))
    none = F.array().cast("array<string>")
    joined = rows.join(by_row, list(KEY), "left").select(
        *KEY, "_n_words", F.coalesce(covered(F.col("_spans")), F.lit(0)).cast("long").alias("_n_hit"),
        F.coalesce("_items", none).alias("_items"), F.coalesce("_near", none).alias("_near"))
    return joined.select(
        *KEY, "_n_words", "_n_hit", F.size("_items").cast("long").alias("_n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("_items_sha256"),
        ((F.col("_n_hit") > 0) & (MAX_SHARE * F.col("_n_hit") >= F.col("_n_words"))).alias("_contaminated"),
        F.size(F.array_except("_near", "_items")).cast("long").alias("_n_near"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated."""
    docs = stored(docs)
    dirty = land(contamination(docs, items).filter("_contaminated").select(*KEY), "contaminated")
    return keyed(docs, F.struct("*").alias("_row")).join(_sized(dirty), list(KEY), "left_anti").select("_row.*")


def op9_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contamination of every document."""
    docs = table(spark, sf_dir, "documents")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    named = keyed(docs, F.col("doc_id")).join(found, list(KEY))
    return named.select("doc_id", *(F.col(f"_{c}").alias(c) for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")))


OP9_SQL = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, w, len(w) AS n
  FROM (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark)
  WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, least(n, 13) AS size, array_to_string(w[s : s + least(n, 13) - 1], ' ') AS phrase
  FROM (SELECT item, w, n, unnest(range(1, greatest(n - 13, 0) + 2)) AS s FROM b)
), sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT row_no, s, size, array_to_string(w[s : s + size - 1], ' ') AS phrase
  FROM (SELECT row_no, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)
), hits AS (SELECT row_no, s, size, item FROM grams JOIN windows USING (size, phrase)),
places AS (SELECT row_no, count(DISTINCT p) AS n_hit FROM (SELECT row_no, unnest(range(s, s + size)) AS p FROM hits) GROUP BY row_no),
found AS (SELECT row_no, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY row_no)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (row_no) LEFT JOIN found USING (row_no)
"""
