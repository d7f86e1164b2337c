"""Loading staged rows into a store: file ids, diff, append, clearing of outdated versions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.versions import require_version
from strandline.operators.diff import rows_to_append
from strandline.operators.files import require_file_ids, with_file_ids
from strandline.operators.latest import KEYS, outdated_rows
from strandline.operators.rows import union_of_types
from strandline.operators.skew import small
from strandline.plans.store import Store
from strandline.schemas import ENTITY_TYPES, FILE_TYPES, STAGED, version_date
from strandline.session import land
from strandline.sources.staging import has_any_data
from strandline.sources.tables import read_staged

# Pairs of type and version date, and ids, that are spelled out in a filter.
PAIRS, IDS = 5_000, 500


@dataclass(frozen=True)
class LoadResult:
    appended: dict[str, int]
    outdated: dict[str, int]


def staged_rows(preprocessed: DataFrame) -> DataFrame:
    """Preprocessed rows with their version as a timestamp; an unreadable version fails the job."""
    return preprocessed.withColumn("version", require_version(F.col("version")))


def read_exports(spark: SparkSession, out: str) -> DataFrame:
    """The rows a preprocess job exported below ``out``, in the long form; absent types have no rows."""
    folders = {entity_type: f"{out}/metadata/{entity_type}" for entity_type in ENTITY_TYPES}
    tables = {
        entity_type: read_staged(spark, folder, entity_type)
        for entity_type, folder in folders.items() if has_any_data(spark, folder)
    }
    if not tables:
        return spark.createDataFrame([], STAGED)
    found = union_of_types(tables)
    return found if "crc32c" in found.columns else found.withColumn("crc32c", F.lit(None).cast("string"))


def inject_file_ids(staged: DataFrame, store: Store) -> DataFrame:
    """File rows with the ids of their loaded files; raises if one has no file and none elsewhere."""
    is_file = F.col("entity_type").isin(*FILE_TYPES)
    resolved = land(with_file_ids(staged.filter(is_file), store.history()), "file-rows")
    require_file_ids(resolved)
    others = staged.filter(~is_file).withColumn("file_id", F.lit(None).cast("string"))
    return others.unionByName(resolved, allowMissingColumns=True)


def resolve_stored_file_ids(store: Store) -> DataFrame:
    """Live file rows with their file ids looked up again."""
    return with_file_ids(store.live().filter(F.col("entity_type").isin(*FILE_TYPES)), store.history())


def stored_beside(existing: DataFrame, keys: DataFrame) -> DataFrame:
    """Stored rows of the types and version dates of some keys (``entity_type, version``); others cannot have an equal key.

    Up to ``PAIRS`` pairs of type and date are spelled out, so that only their folders are opened. Beyond, the
    folders from each type's first to its last date are, and a semi join leaves out the dates between.
    """
    pairs = keys.select("entity_type", version_date(F.col("version")).alias("version_date")).distinct()
    listed = pairs.limit(PAIRS + 1).collect()
    by_type: dict[str, list] = {}
    for row in listed:
        if row.version_date is not None:
            by_type.setdefault(row.entity_type, []).append(row.version_date)
    if len(listed) <= PAIRS:
        tests = [(F.col("entity_type") == name) & F.col("version_date").isin(sorted(dates)) for name, dates in sorted(by_type.items())]
        return existing.filter(reduce(Column.__or__, tests, F.lit(False)))
    # a few dozen types at most
    spans = pairs.groupBy("entity_type").agg(F.min("version_date").alias("low"), F.max("version_date").alias("high")).collect()
    tests = [(F.col("entity_type") == row.entity_type) & F.col("version_date").between(row.low, row.high) for row in spans]
    return existing.filter(reduce(Column.__or__, tests, F.lit(False))).join(pairs, ["entity_type", "version_date"], "left_semi")


def with_ids(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Stored rows of some ids (``entity_type, entity_id``).

    Up to ``IDS`` ids are spelled out, which the files' Bloom filters answer, so that row groups without them are
    not read; the exact join follows, and more ids are joined alone.
    """
    listed = ids.limit(IDS + 1).collect()
    if len(listed) <= IDS:
        rows = rows.filter(F.col("entity_type").isin(sorted({row.entity_type for row in listed})) & F.col("entity_id").isin(sorted({row.entity_id for row in listed if row.entity_id is not None})))
    return rows.join(small(ids), list(KEYS), "left_semi")


def load(staged: DataFrame, store: Store, against: str = "live") -> LoadResult:
    """Append what the store lacks, then soft-delete older versions in the tables that rows are staged for.

    Only the folders of the staged types and version dates are compared, and only the staged ids are ranked, so
    a load reads in proportion to itself. A load that broke off after its append is completed by the next run of
    the same rows: there is nothing to append then, but older versions are still removed. ``against='raw'`` compares with removed rows too, so those are not appended again.
    """
    if against not in ("live", "raw"):
        raise ValueError(f"against must be live or raw, not {against}")
    keys = land(staged.select(*KEYS, "version"), "staged-keys")
    # a few dozen types at most
    present = sorted(row.entity_type for row in keys.select("entity_type").distinct().collect())
    existing = store.live(present) if against == "live" else store.raw()
    new_rows = land(rows_to_append(staged, stored_beside(existing, keys)), "new-rows")
    # at most one entry per entity type
    appended = {row.entity_type: row["count"] for row in new_rows.groupBy("entity_type").count().collect()}
    if appended:
        store.append(new_rows.drop("area", "crc32c"))
    ids = land(keys.select(*KEYS).distinct(), "staged-ids")
    return LoadResult(appended, clear_outdated(store, present, ids) if present else {})


def clear_outdated(store: Store, entity_types: Sequence[str], ids: DataFrame | None = None) -> dict[str, int]:
    """Soft-delete the rows of some types that are older than the newest version of their id.

    With ``ids`` (``entity_type, entity_id``) only rows of these ids are ranked: as each load clears the ids it
    appends, nothing else can have become outdated.
    """
    rows = store.live(entity_types).select(*KEYS, "version", "row_id")
    old = land(outdated_rows(rows if ids is None else land(with_ids(rows, ids), "ranked")).select("entity_type", "row_id"), "outdated")
    # at most one entry per entity type
    outdated = {row.entity_type: row["count"] for row in old.groupBy("entity_type").count().collect()}
    if outdated:
        store.soft_delete(old)
    return outdated
