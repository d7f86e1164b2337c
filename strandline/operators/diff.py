"""Staged rows against stored rows.

Keys are an id and a version; several staged copies of one key stay several rows, as every one is
appended. Joins never multiply staged rows: stored keys are made distinct before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.skew import left_join, spread_join

KEYS = ("entity_type", "entity_id", "version")


def _complete(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return frame.filter(condition)


def _spread_columns(frame: DataFrame, keys: Sequence[str]) -> list[str]:
    rest = [name for name in frame.columns if name not in keys]
    return rest or list(keys)


def rows_to_append(
    staged: DataFrame, existing: DataFrame, keys: Sequence[str] = KEYS, spread: Sequence[str] | None = None
) -> DataFrame:
    """Staged rows with a complete key that no stored row has; duplicates among them are kept.

    ``spread`` names staged columns that tell copies of one key apart (see ``spread_join``).
    """
    stored = existing.select(*keys).distinct()
    return spread_join(_complete(staged, keys), stored, keys, "left_anti", spread or _spread_columns(staged, keys))


def diff(
    staged: DataFrame,
    existing: DataFrame,
    keys: Sequence[str] = KEYS,
    row_id: str = "row_id",
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Full join on the keys: stored row id, staged columns, stored keys, and a ``status``.

    ``status`` is ``new`` (staged only), ``same`` (both) or ``gone`` (stored only). A full outer join
    cannot be split when one key is heavy, so it is put together from a left join and an anti join.
    """
    stored_names = {key: f"existing_{key}" for key in keys}
    stored = existing.select(*keys, row_id, *[F.col(key).alias(name) for key, name in stored_names.items()])
    staged_columns = [F.col(name) for name in staged.columns]
    # a row with an incomplete key matches nothing; such rows differ in the other columns
    left = left_join(staged, stored, keys, spread or _spread_columns(staged, keys), [row_id])
    status = F.when(F.col(row_id).isNull(), "new").otherwise("same")
    both = left.select(row_id, *staged_columns, *stored_names.values(), status.alias("status"))
    staged_keys = _complete(staged, keys).select(*keys).distinct()
    unmatched = spread_join(stored, staged_keys, keys, "left_anti", [row_id])
    empty = [F.lit(None).cast(staged.schema[name].dataType).alias(name) for name in staged.columns]
    gone = unmatched.select(row_id, *empty, *stored_names.values(), F.lit("gone").alias("status"))
    return both.unionByName(gone)


def append_predicate(diffed: DataFrame, keys: Sequence[str] = KEYS, row_id: str = "row_id") -> DataFrame:
    """Rows of a diff that are to be appended, with the staged columns only."""
    fresh = _complete(diffed.filter(F.col(row_id).isNull()), keys)
    return fresh.drop(row_id, "status", *[f"existing_{key}" for key in keys])
