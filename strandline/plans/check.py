"""Checking a store and removing what can be removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.checks import COUNTS, audit, problem_counts, problem_rows
from strandline.operators.subgraphs import (
    SubgraphError, distinct_projects, first_fault, link_problems, links_of, project_set_difference,
)
from strandline.plans.store import Store
from strandline.session import land


class DatasetProblems(Exception):
    """The data set has problems."""


def check(store: Store) -> DataFrame:
    """The five problem counts of the live rows."""
    return problem_counts(store.live())


def require_sound(counts: DataFrame) -> None:
    found = counts.first()
    if found.has_problems:
        raise DatasetProblems({name: found[name] for name in COUNTS})


def remove_problems(store: Store) -> DataFrame:
    """Soft-delete duplicates and null file references; the counts before removal are returned.

    Dangling project references and empty tables need a person and are left alone; the dangling
    count is reported as 0 here, as nothing was done about it.
    """
    before = land(check(store).withColumn("dangling_project_refs", F.lit(0).cast("bigint")), "problem-counts")
    rows = land(problem_rows(store.live()), "problem-rows")
    if not rows.isEmpty():
        store.soft_delete(rows)
    any_problem = F.lit(False)
    for name in COUNTS:
        any_problem = any_problem | (F.col(name) > 0)
    return before.withColumn("has_problems", any_problem)


def require_subgraphs(links: DataFrame, loaded: DataFrame) -> None:
    """Raises if links cannot be read or a node is in no table."""
    fault = first_fault(links, loaded)
    if fault:
        raise _subgraph_error(*fault)


def _subgraph_error(row: dict, unreadable: bool) -> SubgraphError:
    return SubgraphError(f"{'unreadable links' if unreadable else 'entities not loaded'}, first found: {row}")


def require_single_project(rows: DataFrame, project_id: str) -> None:
    """The links are there, name this project only, and all their entities are loaded."""
    links = links_of(rows)
    if links.isEmpty():
        raise SubgraphError(f"no links rows for project {project_id}")
    others = distinct_projects(links).filter(~F.col("project_id").eqNullSafe(F.lit(project_id))).limit(1).collect()
    if others:
        raise SubgraphError(f"links of another project: {others[0].project_id}")
    require_subgraphs(links, rows)


def require_project_loaded(rows: DataFrame, project_id: str) -> None:
    """Like ``require_single_project``, but other projects may be present and are not looked at."""
    links = links_of(rows).filter(F.col("project_id") == project_id)
    if links.isEmpty():
        raise SubgraphError(f"no links rows for project {project_id}")
    require_subgraphs(links, rows)


def require_copy(store: Store, project_id: str) -> DataFrame:
    """A copied data set holds exactly its project, complete subgraphs and no problems; the problem counts are returned.

    Subgraphs and problems are found in one pass over the keys of the store; a fault of the subgraphs is raised first.
    """
    rows = store.live()
    expected = store.spark.createDataFrame([(project_id,)], "project_id string")
    differing = project_set_difference(distinct_projects(links_of(rows)), expected).limit(1).collect()
    if differing:
        raise SubgraphError(f"projects differ, first found: {differing[0].asDict()}")
    audited = land(audit(rows), "audit")
    fault = audited.first().fault
    if fault and fault.unreadable:
        raise _subgraph_error(link_problems(links_of(rows)).first().asDict(), True)
    if fault:
        raise _subgraph_error({"entity_type": fault.entity_type, "entity_id": fault.entity_id}, False)
    counts = audited.drop("fault")
    require_sound(counts)
    return counts
