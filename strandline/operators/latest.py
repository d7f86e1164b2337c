"""Which rows are the newest of their id, and which are not.

Four keep rules exist side by side; they differ only in ties and nulls:

* ``outdated_rows`` keeps every row of the newest version;
* ``duplicate_rows`` keeps the largest row id of the newest version, and nothing where all versions are null;
* ``rows_beyond_first`` keeps the smallest row id of the newest version;
* ``file_rows_beyond_first`` keeps a row with a file id before one without, then the smallest row id.

Each first reduces the rows to one winner per id, with partial aggregation before the shuffle, and
joins the winners back. No task ever holds a whole id group, as a window over the id would.
Only the id, version and row-id columns travel; document content stays in the table.
Ids are primary keys and never null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.skew import spread_join

KEYS = ("entity_type", "entity_id")


def latest_versions(rows: DataFrame, keys: Sequence[str] = KEYS, version: str = "version") -> DataFrame:
    """Newest version of each id."""
    return rows.groupBy(*keys).agg(F.max(version).alias("latest_version"))


def duplicate_ids(rows: DataFrame, keys: Sequence[str] = KEYS, version: str = "version") -> DataFrame:
    """Ids with more than one row, with their newest version and row count."""
    counted = rows.groupBy(*keys).agg(F.max(version).alias("latest_version"), F.count(F.lit(1)).alias("n_rows"))
    return counted.filter("n_rows > 1")


def latest_row_ids(
    rows: DataFrame, keys: Sequence[str] = KEYS, version: str = "version", row_id: str = "row_id"
) -> DataFrame:
    """The largest row id among the newest rows of each id; ids without any version are left out."""
    newest = F.max(F.when(F.col(version).isNotNull(), F.struct(version, row_id)))
    return (
        rows.groupBy(*keys).agg(newest.alias("newest")).filter("newest is not null")
        .select(*keys, F.col(f"newest.{row_id}").alias("kept_row_id"))
    )


def _narrow(rows: DataFrame, keys: Sequence[str], version: str, row_id: str, *more: str) -> DataFrame:
    return rows.select(*dict.fromkeys([*keys, version, row_id, *more]))


def outdated_rows(
    rows: DataFrame, keys: Sequence[str] = KEYS, version: str = "version", row_id: str = "row_id"
) -> DataFrame:
    """Rows strictly older than the newest version of their id."""
    narrow = _narrow(rows, keys, version, row_id)
    latest = latest_versions(narrow, keys, version)
    joined = spread_join(narrow, latest, keys, "inner", [row_id])
    return joined.filter(F.col(version) < F.col("latest_version"))


def duplicate_rows(
    rows: DataFrame, keys: Sequence[str] = KEYS, version: str = "version", row_id: str = "row_id"
) -> DataFrame:
    """Distinct row ids to delete so that each duplicated id keeps one row of its newest version."""
    narrow = _narrow(rows, keys, version, row_id)
    newest = F.max(F.when(F.col(version).isNotNull(), F.struct(version, row_id)))
    groups = (
        narrow.groupBy(*keys).agg(newest.alias("newest"), F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1").select(*keys, F.col(f"newest.{row_id}").alias("kept_row_id"))
    )
    joined = spread_join(narrow, groups, keys, "inner", [row_id])
    dropped = joined.filter(~F.col(row_id).eqNullSafe(F.col("kept_row_id")))
    return dropped.select(*keys, row_id).distinct()


def _beyond_first(
    rows: DataFrame, keys: Sequence[str], version: str, row_id: str, tie_break: Column, more: Sequence[str]
) -> DataFrame:
    """Rows other than the one with the newest version and, within it, the smallest ``tie_break``."""
    narrow = _narrow(rows, keys, version, row_id, *more)
    per_version = narrow.groupBy(*keys, version).agg(F.min(tie_break).alias("first"))
    winners = (
        per_version.groupBy(*keys).agg(F.max(F.struct(version, "first")).alias("winner"))
        .select(*keys, F.col(f"winner.first.{row_id}").alias("kept_row_id"))
    )
    joined = spread_join(narrow, winners, keys, "inner", [row_id])
    return joined.filter(F.col(row_id) != F.col("kept_row_id")).drop("kept_row_id")


def rows_beyond_first(
    rows: DataFrame, keys: Sequence[str] = KEYS, version: str = "version", row_id: str = "row_id"
) -> DataFrame:
    """Rows ranked after the first by version descending, row id ascending."""
    return _beyond_first(rows, keys, version, row_id, F.struct(row_id), [])


def file_rows_beyond_first(
    rows: DataFrame,
    keys: Sequence[str] = KEYS,
    version: str = "version",
    row_id: str = "row_id",
    file_id: str = "file_id",
) -> DataFrame:
    """Rows ranked after the first by version descending, file id ascending with nulls last, row id."""
    order = F.struct(F.col(file_id).isNull().alias("unset"), F.col(file_id), F.col(row_id))
    return _beyond_first(rows, keys, version, row_id, order, [file_id])


def outdated_files(inventory: DataFrame) -> DataFrame:
    """Files of an inventory that are not the newest of their (path, entity); versions compare as text."""
    return rows_beyond_first(inventory, ("path", "entity"), "version", "blob").select("blob", "path", "entity", "version")
