"""Awkward documents that every operator must take: nulls, empty and long texts, copies, ties, clashing columns."""

import random

from pyspark.sql import functions as F

WORDS = "the of and ring stone river Straße élan niño was there when that light fell over cold water by noon".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) if rng.random() < 0.6 else rng.choice(WORDS) for _ in range(n)]
    lines, at = [], 0
    while at < n:
        size = rng.randint(8, 40)
        lines.append(" ".join(made[at : at + size]) + ".")
        at += size
    return "\n".join(lines)


def texts() -> list[str | None]:
    """Texts by id; id 2 is null, 3 empty, 12 very long, 20 to 25 copies, 30 to 32 near copies of each other."""
    found: list[str | None] = [prose(i, 30 + 7 * i) for i in range(34)]
    found[2], found[3], found[4], found[5] = None, "", " \n\t ", "1234 5678 !!"
    found[12] = prose(12, 30_000)
    found[20:26] = [found[19]] * 6
    words = prose(99, 400).split(" ")
    for k in range(3):
        changed = list(words)
        changed[50 + 90 * k] = "swapped"
        found[30 + k] = " ".join(changed)
    return found


def documents(spark, rows: list[str | None] | None = None):
    """A documents table with columns whose names clash with those the operators use, a null id and repeated rows."""
    rows = texts() if rows is None else rows
    data = [(i, t, "en" if i % 2 else "de", None if i % 5 else f"src{i % 3}", len(t or "")) for i, t in enumerate(rows)]
    if len(rows) > 20:
        data += [(None, rows[0], None, None, 1), data[7], data[7]]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("_f", "_r", "_row", "_text", "_lines", "score", "start", "kind", "id", "term", "value", "ids"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame


def empty(spark):
    return documents(spark).filter("false")
