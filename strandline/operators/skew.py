"""Equi joins that stay balanced when single keys own a large share of the rows.

Spark's own skew handling splits a shuffle partition only when both join inputs come straight from a
shuffle. Here the right side is usually an aggregate (one row per key), where it does not apply. So
the heavy keys of the left side are found first, and only those keys are spread over several slices of
a bounded number of rows. Two passes over the key column find them exactly: the first counts rows by a
small hash, which is one short list whatever the data; the second counts the single keys in the few
entries of that list that are beyond a slice. Where there are none, adaptive execution leaves the second
pass out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that a task takes; keys with more are cut into slices of about so many.
MIN_SLICE_ROWS = 1_000_000
# Entries of the first pass.
LIST_SIZE = 1 << 16
# Bound of the broadcast table of heavy keys (two numbers each): beyond MIN_SLICE_ROWS times this number of rows,
# which is 10^12, slices grow with the data.
HEAVY_LIMIT = 1_000_000

_HASH, _COPIES, _SLICE = "__key_hash", "__copies", "__slice"
_OTHER_COPIES, _OTHER_SLICE, _ROWS = "__other_copies", "__other_slice", "__rows"


def _hashed(on: Sequence[str]):
    return F.xxhash64(*[F.col(name) for name in on])


def hot_keys(left: DataFrame, on: Sequence[str], min_slice_rows: int | None = None) -> DataFrame:
    """Hashes of all keys with more than ``min_slice_rows`` rows and the number of slices each is to be cut into."""
    least = MIN_SLICE_ROWS if min_slice_rows is None else min_slice_rows
    keys = left.select(_hashed(on).alias(_HASH)).withColumn("entry", F.pmod(_HASH, F.lit(LIST_SIZE)))
    listed = keys.groupBy("entry").agg(F.count(F.lit(1)).alias("n"))
    full = listed.filter(F.col("n") > least).select("entry", F.lit(True).alias("full"))
    counted = keys.join(F.broadcast(full), "entry", "left_semi").groupBy(_HASH).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least)
    # the sum of all counts, for the bound of the table
    total = listed.agg(F.sum("n")).scalar()
    sliced = counted.withColumn("slice", F.greatest(F.lit(least), F.ceil(total / HEAVY_LIMIT)))
    return sliced.filter("n > slice").select(_HASH, F.ceil(F.col("n") / F.col("slice")).cast("int").alias(_COPIES))


def within_slice(values: DataFrame, min_slice_rows: int | None = None) -> bool:
    """Are there so few distinct rows that one for each of them fits a slice? Stops counting beyond."""
    least = MIN_SLICE_ROWS if min_slice_rows is None else min_slice_rows
    return values.distinct().limit(least + 1).count() <= least


def _own_slice(spread: Sequence[str], copies: str):
    """The slice a row belongs to; 0 unless its key is cut."""
    n = F.coalesce(F.col(copies), F.lit(1))
    return F.when(n == 1, F.lit(0).cast("bigint")).otherwise(F.pmod(F.xxhash64(*[F.col(name) for name in spread]), n))


def _all_slices(copies: str):
    """One row for each slice of the key."""
    n = F.coalesce(F.col(copies), F.lit(1))
    return F.explode(F.sequence(F.lit(0).cast("bigint"), (n - 1).cast("bigint")))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread: Sequence[str],
    min_slice_rows: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Join on the columns ``on``; heavy left keys are cut into slices by a hash of ``spread``.

    ``right`` should hold few rows per key (an aggregate or distinct keys): those of heavy keys are
    copied once per slice. ``spread`` names left columns that differ between rows of one key, such
    as a row id; they are data, not random numbers, so a task that runs again places rows as before.
    ``hot`` may give the ``hot_keys`` to use.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join keeps the left side only, not {how}")
    on = list(on)
    hot = F.broadcast(hot_keys(left, on, min_slice_rows) if hot is None else hot)
    sliced = left.withColumn(_HASH, _hashed(on)).join(hot, _HASH, "left").withColumn(_SLICE, _own_slice(spread, _COPIES))
    copied = right.withColumn(_HASH, _hashed(on)).join(hot, _HASH, "left").withColumn(_SLICE, _all_slices(_COPIES))
    drop = (_HASH, _COPIES)
    return sliced.drop(*drop).join(copied.drop(*drop), [*on, _SLICE], how).drop(_SLICE)


def grid_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_spread: Sequence[str],
    right_spread: Sequence[str],
    min_slice_rows: int | None = None,
    left_hot: DataFrame | None = None,
    right_hot: DataFrame | None = None,
) -> DataFrame:
    """Inner join where both sides may hold many rows of one key.

    A heavy key becomes a grid of left slices by right slices; each row goes to one row or column of
    the grid, so every pair of rows meets in exactly one cell.
    """
    on = list(on)
    none = F.lit(None).cast("int")
    left_hot = hot_keys(left, on, min_slice_rows) if left_hot is None else left_hot
    right_hot = hot_keys(right, on, min_slice_rows) if right_hot is None else right_hot
    by_left = left_hot.withColumn(_OTHER_COPIES, none)
    by_right = right_hot.withColumnRenamed(_COPIES, _OTHER_COPIES).withColumn(_COPIES, none)
    # at most twice HEAVY_LIMIT rows
    hot = F.broadcast(by_left.unionByName(by_right).groupBy(_HASH).agg(F.max(_COPIES).alias(_COPIES), F.max(_OTHER_COPIES).alias(_OTHER_COPIES)))
    drop = (_HASH, _COPIES, _OTHER_COPIES)
    rows = (
        left.withColumn(_HASH, _hashed(on)).join(hot, _HASH, "left")
        .withColumn(_SLICE, _own_slice(left_spread, _COPIES)).withColumn(_OTHER_SLICE, _all_slices(_OTHER_COPIES)).drop(*drop)
    )
    columns = (
        right.withColumn(_HASH, _hashed(on)).join(hot, _HASH, "left")
        .withColumn(_OTHER_SLICE, _own_slice(right_spread, _OTHER_COPIES)).withColumn(_SLICE, _all_slices(_COPIES)).drop(*drop)
    )
    return rows.join(columns, [*on, _SLICE, _OTHER_SLICE], "inner").drop(_SLICE, _OTHER_SLICE)


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    right_spread: Sequence[str],
    min_slice_rows: int | None = None,
) -> DataFrame:
    """Left outer join where both sides may hold many rows of one key.

    The right side is first reduced to one row per key with its row count. That settles all left rows
    with no or one partner, which is nearly all of them as a rule; only keys with several right rows
    go through ``grid_join``. Both ways read the same shuffle of the left side.
    """
    on = list(on)
    values = [name for name in right.columns if name not in on]
    # of a single row, the maximum is the value
    summary = right.groupBy(*on).agg(F.count(F.lit(1)).alias(_ROWS), *[F.max(name).alias(name) for name in values])
    left_hot, right_hot = hot_keys(left, on, min_slice_rows), hot_keys(right, on, min_slice_rows)
    joined = spread_join(left, summary, on, "left", spread, hot=left_hot)
    settled = joined.filter(F.coalesce(F.col(_ROWS), F.lit(1)) == 1).drop(_ROWS)
    several = joined.filter(F.col(_ROWS) > 1).drop(_ROWS, *values)
    keys = summary.filter(F.col(_ROWS) > 1).select(*on)
    partners = spread_join(right, keys, on, "left_semi", right_spread, hot=right_hot)
    return settled.unionByName(grid_join(several, partners, on, spread, right_spread, left_hot=left_hot, right_hot=right_hot))


# About so many different values of a key are one list.
LIST_ROWS = 1000


def listed(rows: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """The values of each key in lists of ``(value, n)``, n being how often the key has it; a key of many values has several lists.

    So a join to the lists leaves the other side in one row for most keys, and copies it once for each list of the others.
    Null keys, which meet nothing, are left out.
    """
    on, rows = list(on), rows.dropna(subset=list(on))
    hot = F.broadcast(hot_keys(rows, on, LIST_ROWS))
    sliced = rows.withColumn(_HASH, _hashed(on)).join(hot, _HASH, "left").withColumn(_SLICE, _own_slice([value], _COPIES))
    # dealt by key and slice once, for both aggregations
    counted = sliced.select(*on, _SLICE, value).repartition(*on, _SLICE).groupBy(*on, _SLICE, value).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(*on, _SLICE).agg(F.collect_list(F.struct(value, "n")).alias(value)).drop(_SLICE)


# Keys up to this count are sent to every executor (about 100 bytes each).
BROADCAST_KEYS = 500_000


def small(keys: DataFrame, limit: int = BROADCAST_KEYS) -> DataFrame:
    """The keys, to be broadcast if a count finds few of them, so that what they are joined to stays in place."""
    return F.broadcast(keys) if keys.limit(limit + 1).count() <= limit else keys
