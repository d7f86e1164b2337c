"""Jobs around a release: manifests from an intake list, clean-up lists, project checks and inventories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strandline.operators import inventory as I
from strandline.operators.latest import outdated_files
from strandline.operators.release import intake_areas, manifests
from strandline.operators.subgraphs import links_of, verify_projects
from strandline.plans.store import Store
from strandline.session import land
from strandline.sinks.writers import replace_table, write_ids, write_manifests, write_tsv
from strandline.sources.manifests import read_intake, read_project_list
from strandline.sources.staging import inventory


class UnverifiedProjects(Exception):
    """Projects of a list are incomplete."""


def write_release_manifests(spark: SparkSession, intake: str, roots: DataFrame, release_tag: str, out: str, public_only: bool = False) -> DataFrame:
    """Manifests of an intake list, below ``out``; the lines (``entry``, ``manifest``) are returned."""
    lines = land(manifests(intake_areas(read_intake(spark, intake), roots), release_tag, public_only), "manifests")
    write_manifests(lines, out)
    return lines


def write_outdated_files(spark: SparkSession, areas: Sequence[str], out: str) -> DataFrame:
    """The list of staged files that a newer version of their entity replaces, one path per line; files are kept."""
    old = land(outdated_files(inventory(spark, areas)[0]), "outdated-files")
    write_ids(old, "blob", out)
    return old


def check_project_list(store: Store, path: str) -> DataFrame:
    """The report of each project of a list; projects without links are not verified."""
    rows = store.live()
    return verify_projects(read_project_list(store.spark, path), links_of(rows), rows)


def require_projects(report: DataFrame) -> None:
    bad = report.filter("not verified").select("project_id").limit(20).collect()
    if bad:
        raise UnverifiedProjects(f"incomplete projects (first 20): {[row.project_id for row in bad]}")


def write_snapshot_inventory(snapshots: DataFrame, policies: DataFrame, release: str, out: str) -> None:
    """The release's snapshots as a tab-separated list."""
    write_tsv(I.snapshot_inventory(snapshots, policies, release), out)


def write_released_projects(projects: DataFrame, snapshots: DataFrame, prefix: str, catalog: str, out: str) -> DataFrame:
    """Each project with its first snapshot in a catalog, as a stored table."""
    return replace_table(I.released_projects(projects, snapshots, prefix, catalog), out)
