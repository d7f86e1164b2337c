"""Data set and snapshot inventories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.names import dataset_name_pattern, snapshot_name_patterns, without_dashes
from strandline.functions.versions import leading_date


def audit_names(names: DataFrame, atlas: str, atlases: Sequence[str]) -> DataFrame:
    """``name`` with its ``form`` (dataset, snapshot, earlier_snapshot or invalid), atlas, environment and id."""
    dataset = dataset_name_pattern(atlas)
    earlier, current = snapshot_name_patterns(atlases)
    name = F.col("name")
    form = (
        F.when(name.rlike(dataset), "dataset").when(name.rlike(current), "snapshot")
        .when(name.rlike(earlier), "earlier_snapshot").otherwise("invalid")
    )
    part = F.split(name, "_")

    def valid(column: Column) -> Column:
        return F.when(F.col("form") != "invalid", column)

    project = F.regexp_extract(name, "([0-9a-f]{32}|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})", 1)
    return names.select("name", form.alias("form")).select(
        "name", "form", valid(F.get(part, F.lit(0))).alias("atlas"), valid(F.get(part, F.lit(1))).alias("environment"),
        valid(F.nullif(project, F.lit(""))).alias("project_id"),
    )


def release_snapshots(snapshots: DataFrame, release: str) -> DataFrame:
    """Snapshots whose name contains ``_{release}``."""
    return snapshots.filter(F.col("name").contains(f"_{release}"))


def with_public_flag(snapshots: DataFrame, policies: DataFrame) -> DataFrame:
    """``public_flag`` Y or N for each snapshot; ``policies`` has ``id`` and ``public``."""
    open_to_all = policies.groupBy("id").agg(F.max("public").alias("public"))
    flag = F.when(F.col("public"), "Y").otherwise("N")
    return snapshots.join(open_to_all, "id", "left").withColumn("public_flag", flag).drop("public")


def snapshot_inventory(snapshots: DataFrame, policies: DataFrame, release: str) -> DataFrame:
    """The release's snapshots with creation date and public flag, sorted by name."""
    flagged = with_public_flag(release_snapshots(snapshots, release), policies)
    return flagged.select(
        "id", "name", "data_project", leading_date(F.col("created_date")).alias("created_day"), "created_date", "public_flag"
    ).orderBy("name")


def released_projects(projects: DataFrame, snapshots: DataFrame, prefix: str, catalog: str) -> DataFrame:
    """Each project with the first snapshot ``{prefix}_{id}`` of a catalog, sorted by project; null if none."""
    compact = projects.select("project_id", without_dashes(F.col("project_id")).alias("compact_id")).distinct()
    named = snapshots.filter(F.col("name").contains(f"_{catalog}_"))
    owner = F.explode(F.array_distinct(F.regexp_extract_all("name", F.lit(f"{prefix}_([0-9a-f]{{32}})"), F.lit(1))))
    first = named.select("name", owner.alias("compact_id")).groupBy("compact_id").agg(F.min("name").alias("snapshot"))
    joined = compact.join(first, "compact_id", "left")
    return joined.select("project_id", "snapshot", F.col("snapshot").isNotNull().alias("found")).orderBy("project_id")
