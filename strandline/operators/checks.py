"""Problem checks of a data set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.files import null_file_refs
from strandline.operators.latest import duplicate_rows
from strandline.operators.skew import BROADCAST_KEYS, spread_join
from strandline.operators.subgraphs import foreign_items, links_of
from strandline.schemas import LINKS, PROJECT, TOP_LEVEL_DIRS

# The five problem counts.
COUNTS = ("duplicates", "null_file_refs", "dangling_project_refs", "empty_links_count", "empty_projects_count")


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n_rows"))


def empty_table(rows: DataFrame) -> DataFrame:
    """1 if there are no rows, else 0."""
    return rows.agg(F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint").alias("n_problems"))


def dangling_links(links: DataFrame, projects: DataFrame) -> DataFrame:
    """Distinct ids of links whose project is in no project row; only these move where the projects are few enough to be sent."""
    known = projects.select("project_id").distinct()
    if known.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        found = links.select("links_id", "project_id").join(F.broadcast(known), "project_id", "left_anti")
    else:
        found = spread_join(links.select("links_id", "project_id"), known, ["project_id"], "left_anti", ["links_id"])
    return found.select("links_id").distinct()


def problem_rows(rows: DataFrame) -> DataFrame:
    """Rows to remove, with their issue: ``entity_type, issue, row_id``."""
    duplicates = duplicate_rows(rows).select("entity_type", F.lit("duplicates").alias("issue"), "row_id")
    unset = null_file_refs(rows).select("entity_type", F.lit("null_file_refs").alias("issue"), "row_id")
    return duplicates.unionByName(unset)


def problems_by_table(problems: DataFrame) -> DataFrame:
    """Distinct problem rows per table and issue."""
    return problems.groupBy("entity_type", "issue").agg(F.countDistinct("row_id").alias("n_rows"))


_ID = ("entity_type", "entity_id")


def _stored_rows(rows: DataFrame) -> DataFrame:
    """What the checks need of each row: its type and id, whether it has a version, and whether it lacks its file."""
    unset = F.col("file_id").isNull() & ~F.col("descriptor").like('%"drs_uri":%')
    return rows.select(*_ID, F.col("version").isNotNull().alias("dated"), F.coalesce(unset, F.lit(False)).cast("int").alias("unset"))


def _counted(by_id: DataFrame, rows: DataFrame, *more: Column) -> DataFrame:
    """One row of counts from the ids (``entity_type, entity_id, n, dated, n_unset``) of some rows, and ``more`` aggregates."""
    kind, zero = F.col("entity_type"), F.lit(0).cast("bigint")
    # one row of the newest version is kept of each id; where no row has a version, none is
    spare = F.when(F.col("n") > 1, F.when(F.col("dated"), F.col("n") - 1).otherwise(F.col("n"))).otherwise(0)
    sums = {"duplicates": spare, "null_file_refs": F.col("n_unset"), "n_links": F.when(kind == LINKS, F.col("n")), "n_projects": F.when(kind == PROJECT, F.col("n"))}
    found = by_id.agg(*(F.coalesce(F.sum(value).cast("bigint"), zero).alias(name) for name, value in sums.items()), *more)
    links = rows.filter(kind == LINKS).select(F.col("entity_id").alias("links_id"), "project_id")
    dangling = dangling_links(links, rows.filter(kind == PROJECT).select(F.col("entity_id").alias("project_id")))
    empty = {f"empty_{name}_count": F.when(F.col(f"n_{name}") == 0, 1).otherwise(0).cast("bigint") for name in ("links", "projects")}
    counted = found.withColumns({"dangling_project_refs": dangling.agg(F.count(F.lit(1))).scalar(), **empty})
    any_problem = F.lit(False)
    for name in COUNTS:
        any_problem = any_problem | (F.col(name) > 0)
    return counted.withColumn("has_problems", any_problem).drop("n_links", "n_projects")


def problem_counts(rows: DataFrame) -> DataFrame:
    """One row: the five problem counts of a data set, and ``has_problems``.

    Each row is counted by its type and id, before the shuffle as far as it goes, and nothing is stored. Row ids are
    taken to be unique, as an append makes them.
    """
    counts = (F.count(F.lit(1)).alias("n"), F.max("dated").alias("dated"), F.sum("unset").alias("n_unset"))
    return _counted(_stored_rows(rows).groupBy(*_ID).agg(*counts), rows).select(*COUNTS, "has_problems")


def audit(rows: DataFrame) -> DataFrame:
    """``problem_counts`` with a ``fault`` (``unreadable, entity_type, entity_id``) of the rows' own subgraphs, as ``first_fault`` finds one, or null.

    The rows and the nodes that their links name meet in one aggregation, so each key moves once for all checks.
    """
    stored = _stored_rows(rows).withColumns({"unreadable": F.lit(False), "rows": F.lit(1), "named": F.lit(False)})
    none = F.lit(None).cast("boolean")
    named = foreign_items(links_of(rows)).withColumns({"dated": none, "unset": F.lit(0), "rows": F.lit(0), "named": F.lit(True)})
    by_id = stored.unionByName(named).groupBy(*_ID, "unreadable").agg(
        F.sum("rows").alias("n"), F.max("dated").alias("dated"), F.sum("unset").alias("n_unset"), F.max("named").alias("named"))
    # a row without an id holds no entity
    held = (F.col("n") > 0) & F.col("entity_type").isNotNull() & F.col("entity_id").isNotNull()
    fault = F.max(F.when(F.col("named") & ~held, F.struct("unreadable", *_ID))).alias("fault")
    return _counted(by_id, rows, fault).select(*COUNTS, "has_problems", "fault")


def missing_directories(inventory: DataFrame, areas: DataFrame) -> DataFrame:
    """Well-known directories of each area without any file; ``inventory`` has ``area`` and ``top``."""
    wanted = areas.select("area", F.explode(F.array(*[F.lit(d) for d in TOP_LEVEL_DIRS])).alias("top"))
    present = inventory.select("area", "top").distinct()
    return wanted.join(present, ["area", "top"], "left_anti")
