"""Personal data, with DataFrame functions only: strict formats, and candidates that boosted trees accept.

Generators with a high recall propose spans, some of which overlap. Those of strict formats that pass their
checks are always taken. Gradient-boosted trees learn from all strict matches, passed or failed, by format
and context; a threshold calibrated on a part kept apart selects further candidates of the loose generators.
Trees run inside Spark's own library of models, without Python on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.llm.common import KEY, keyed, stored, table
from strandline.session import land

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 24  # characters before and after a candidate that features look at
ROUNDS, DEPTH = 8, 3
PRECISION = 0.95  # asked of the candidates accepted in the calibration part
LEAST_ROWS = 40  # of each label; with fewer, nothing is learned and no candidate is added

# Matches are those of the plain formats, found in linear time: a match can only start where a run starts, or
# where the last match ended (\G), and runs are never given back.
_LOCAL = "[A-Za-z0-9._%+-]"
STRICT = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # from 14 digits on: shorter runs fail anyway
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++\x20?(?:\(at\)|\[at\]|@)\x20?[A-Za-z0-9-]++(?:\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_KEYWORDS = r"(?i)(?:mail|contact|write|phone|tel|call|fax|mobile|card|visa|credit|iban|host|address|server|\bip\b)"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.sequence(F.lit(0), F.length(digits) - 1)
    backwards = F.reverse(digits)
    value = lambda i: F.substring(backwards, i + 1, F.lit(1)).cast("int") * (1 + i % 2)
    return F.aggregate(F.transform(places, lambda i: value(i) - F.when(value(i) > 9, 9).otherwise(0)), F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: Column, value: Column) -> Column:
    n = F.length(_digits(value))
    return (F.when(kind == 0, True).when(kind == 1, value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"))
            .when(kind == 2, F.when(n.between(14, 19), luhn(_digits(value))).otherwise(False)).otherwise(n.between(10, 15)))


def _candidate(kind: int, strict: bool) -> Callable[[Column, Column], Column]:
    return lambda zipped, at: F.struct(
        F.lit(kind).alias("kind"), F.lit(strict).alias("strict"), at.alias("at"), zipped["value"].alias("value"), zipped["gap"].alias("gap"))


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_f, _r, kind, strict, start, end, value, left, right, base): the matches of all generators in whole texts.

    Positions count code points, ends are exclusive. base: a strict match that passes its format's checks.
    """
    generators = [(KINDS.index(k), True, p) for k, p in STRICT.items()] + [(KINDS.index(k), False, p) for k, p in LOOSE.items()]
    whole = F.col(text)
    # the matches first, so that a text is only cut where there are some
    found = keyed(docs, whole.alias("_text"), *(F.regexp_extract_all(whole, F.lit(p), F.lit(0)).alias(f"_m{i}") for i, (_, _, p) in enumerate(generators)))
    found = found.filter(" or ".join(f"size(_m{i}) > 0" for i in range(len(generators))))
    runs = []
    for i, (kind, strict, pattern) in enumerate(generators):
        # the text between matches, one more piece than there are matches
        between = F.transform(F.split("_text", pattern, -1), lambda g: F.struct(
            F.length(g).alias("n"), F.right(g, F.lit(CONTEXT)).alias("last"), F.left(g, F.lit(CONTEXT)).alias("first")))
        zipped = F.arrays_zip(F.col(f"_m{i}").alias("value"), between.alias("gap"))
        runs.append(F.when(F.size(f"_m{i}") > 0, F.transform(zipped, _candidate(kind, strict))))
    each = found.select(*KEY, F.explode(F.array_compact(F.array(*runs))).alias("run")).select(*KEY, F.explode("run").alias("c")).select(*KEY, "c.*")
    order = W.partitionBy(*KEY, "kind", "strict").orderBy("at")
    before = F.sum(F.col("gap.n") + F.coalesce(F.length("value"), F.lit(0))).over(order.rowsBetween(W.unboundedPreceding, -1))
    placed = each.withColumn("start", F.coalesce(before, F.lit(0)) + F.col("gap.n")).withColumn("right", F.lead("gap.first").over(order)).filter("value is not null")
    return placed.select(
        *KEY, "kind", "strict", F.col("start").cast("int").alias("start"), (F.col("start") + F.length("value")).cast("int").alias("end"),
        "value", F.col("gap.last").alias("left"), "right", (F.col("strict") & _passes(F.col("kind"), F.col("value"))).alias("base"))


def features(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """Format and context of the candidates, as numbers."""
    digits, value = _digits(F.col("value")), F.col("value")
    made = {
        "x_length": F.length(value), "x_digits": F.length(digits), "x_letters": F.length(F.regexp_replace(value, "[^A-Za-z]", "")),
        "x_kinds_of_digits": F.size(F.array_distinct(F.split(digits, ""))), "x_runs": F.size(F.split(value, "[0-9]+")) - 1,
        "x_plus": F.startswith(value, F.lit("+")), "x_bracket": F.contains(value, F.lit("(")), "x_at": F.contains(value, F.lit("@")),
        "x_dots": F.length(F.regexp_replace(value, "[^.]", "")), "x_blanks": F.length(F.regexp_replace(value, "[^\\x20-]", "")),
        "x_joined_left": F.col("left").rlike("[A-Za-z0-9]$"), "x_joined_right": F.coalesce("right", F.lit("")).rlike("^[A-Za-z0-9]"),
        "x_keyword": F.col("left").rlike(_KEYWORDS), "x_equals": F.col("left").rlike("[=:#]\\s*[\"']?$"),
        **{f"x_{k}": F.col("kind") == i for i, k in enumerate(KINDS)},
    }
    return rows.select("*", *(c.cast("double").alias(name) for name, c in made.items())), list(made)


def examples(found: DataFrame) -> tuple[DataFrame, list[str]]:
    """(part, label, features, n): all strict candidates, counted by part, label and features.

    The trees take the counts as weights, so what they hold grows with the kinds of candidates, not with the candidates.
    """
    part = F.pmod(F.xxhash64("value", "left", "kind"), F.lit(4))
    named, names = features(found.filter("strict").withColumn("label", F.col("base").cast("double")).withColumn("part", part))
    return named.groupBy("part", "label", *names).agg(F.count("*").cast("double").alias("n")), names


def accepted(found: DataFrame) -> DataFrame:
    """The candidates of the loose generators that the trees accept, from a stored table of candidates."""
    counted, names = examples(found)
    assemble = VectorAssembler(inputCols=names, outputCol="x")
    rows = land(counted, "examples")
    learn, check = rows.filter("part <> 0"), rows.filter("part = 0")
    counts = {row["label"]: row["n"] for row in learn.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    nothing = found.filter("false").withColumn("score", F.lit(0.0))
    if len(counts) < 2 or min(counts.values()) < LEAST_ROWS or found.filter("not strict").isEmpty():
        return nothing
    model = GBTClassifier(featuresCol="x", labelCol="label", weightCol="n", maxIter=ROUNDS, maxDepth=DEPTH, stepSize=0.3, maxBins=32, seed=7).fit(assemble.transform(learn))
    scored = lambda frame: model.transform(assemble.transform(frame)).withColumn("score", vector_to_array("probability")[1])
    # the least threshold whose acceptances are right often enough in the part kept apart
    bins = scored(check).groupBy(F.floor(F.col("score") * 50).alias("bin")).agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n")).collect()
    threshold, right, n = None, 0.0, 0
    for row in sorted(bins, key=lambda b: -b["bin"]):
        right, n = right + row["right"], n + row["n"]
        if row["bin"] >= 25 and right >= PRECISION * n:
            threshold = row["bin"] / 50
    if threshold is None:
        return nothing
    return scored(features(found.filter("not strict"))[0]).filter(F.col("score") >= threshold).select(*found.columns, "score")


def redactions(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_f, _r, kind, start, end, base): the strict matches that pass, and the accepted candidates that overlap
    none of them and none accepted before."""
    found = land(candidates(docs, text), "candidates")
    base = found.filter("base").select(*KEY, "kind", "start", "end", F.lit(True).alias("base"))
    added = accepted(found).select(*KEY, "kind", "start", "end", F.lit(False).alias("base"))
    # running ends from the left and starts from the right, so that a text with many spans is walked once each way
    onwards = W.partitionBy(*KEY).orderBy("start", F.desc("base"), "kind").rowsBetween(W.unboundedPreceding, -1)
    back = W.partitionBy(*KEY).orderBy(F.desc("start"), "base", F.desc("kind")).rowsBetween(W.unboundedPreceding, -1)
    walked = base.unionByName(added).select(
        "*", F.max("end").over(onwards).alias("_ended"), F.min(F.when(F.col("base"), F.col("start"))).over(back).alias("_next"))
    free = (F.coalesce("_ended", F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("_next"), F.col("end")) >= F.col("end"))
    return walked.filter(F.col("base") | free).select(*KEY, "kind", "start", "end", "base")


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_f, _r, _n_email, _n_ip, _n_card, _n_phone, _base_sha256, _spans) for each row of docs.

    Counts and digest are of the strict formats' spans, written kind:start:end, by start and kind, joined by
    commas; _spans also has the accepted candidates. Whole texts are searched. Null and empty texts, and all
    texts of a table without matches, have no spans (empty string, its digest, zeros). Repeated rows are
    searched each. Other columns are not looked at.
    """
    docs = stored(docs)
    one = F.struct("start", "kind", "end", "base")
    by_row = redactions(docs, text).groupBy(*KEY).agg(F.array_sort(F.collect_list(one)).alias("s"))
    rows = keyed(docs, F.lit(1).alias("_one")).join(by_row, list(KEY), "left")
    spans = F.coalesce("s", F.array().cast("array<struct<start:int,kind:int,end:int,base:boolean>>"))
    kinds = F.array(*(F.lit(k) for k in KINDS))
    joined = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"], x["end"])), ",")
    base = F.filter(spans, lambda x: x["base"])
    count = lambda k: F.size(F.filter(base, lambda x: x["kind"] == k)).cast("long")
    return rows.select(*KEY, *(count(i).alias(f"_n_{k}") for i, k in enumerate(KINDS)),
                       F.sha2(joined(base).cast("binary"), 256).alias("_base_sha256"), joined(spans).alias("_spans"))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data in every document."""
    docs = table(spark, sf_dir, "documents")
    found = keyed(docs, F.col("doc_id")).join(personal_data(docs), list(KEY))
    return found.select("doc_id", *(F.col(f"_{c}").alias(c) for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")))
