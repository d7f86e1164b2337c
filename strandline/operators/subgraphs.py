"""Links documents as graph nodes, and whether every node has arrived.

``links`` rows carry ``links_id`` (or ``entity_id``), ``project_id`` and ``content``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.skew import small, spread_join, within_slice
from strandline.schemas import LINKS, LINKS_CONTENT
from strandline.session import land

# The two kinds of link.
PROCESS_LINK = "process_link"
FILE_LINK = "supplementary_file_link"


class SubgraphError(Exception):
    """Links that cannot be read as a subgraph, or nodes that are not loaded."""


def with_links(rows: DataFrame) -> DataFrame:
    """One row per links row with its parsed ``links`` array (null if the content is unreadable)."""
    return rows.select("links_id", "project_id", F.from_json("content", LINKS_CONTENT).getField("links").alias("links"))


def links_of(rows: DataFrame) -> DataFrame:
    """The links rows of the long table."""
    own = rows.filter(F.col("entity_type") == LINKS)
    return own.select(F.col("entity_id").alias("links_id"), "project_id", "content")


NODES = "array<struct<entity_type:string,entity_id:string>>"


def _node(entity_type: Column, entity_id: Column) -> Column:
    return F.array(F.struct(entity_type.alias("entity_type"), entity_id.alias("entity_id")))


def _nodes(pairs: Column) -> Column:
    """An array of (type, id) pairs under the common field names; absent arrays count as empty."""
    return F.coalesce(pairs.cast(NODES), F.array().cast(NODES))


def _any_null(record: Column, fields: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for field in fields:
        found = found | record[field].isNull()
    return found


def _nodes_of_link(link: Column) -> Column:
    process = F.concat(
        _node(link["process_type"], link["process_id"]),
        _nodes(link["inputs"]), _nodes(link["outputs"]), _nodes(link["protocols"]),
    )
    supplementary = F.concat(_nodes(F.array(link["entity"])), _nodes(link["files"]))
    none = F.array().cast(NODES)
    return F.when(link["link_type"] == PROCESS_LINK, process).when(link["link_type"] == FILE_LINK, supplementary).otherwise(none)


def subgraph_nodes(links: DataFrame) -> DataFrame:
    """A row per node mention: ``links_id, project_id, entity_type, entity_id``.

    The links row itself is a node of type ``links``. The arrays are opened in place, in one pass
    over the rows and without a shuffle.
    """
    opened = with_links(links).select("links_id", "project_id", F.posexplode_outer("links").alias("position", "link"))
    own = F.when(F.coalesce(F.col("position"), F.lit(0)) == 0, _node(F.lit(LINKS), F.col("links_id"))).otherwise(F.array().cast(NODES))
    nodes = F.concat(own, F.coalesce(_nodes_of_link(F.col("link")), F.array().cast(NODES)))
    return opened.select("links_id", "project_id", F.explode(nodes).alias("node")).select(
        "links_id", "project_id", "node.entity_type", "node.entity_id"
    )


def _problem_of_link(link: Column, closed: Column) -> Column:
    """Why a link cannot be opened in full, or null."""
    kind = F.coalesce(link["link_type"], F.lit("null"))

    def lacks(items: Column, *fields: str) -> Column:
        """Is the array absent, or any of its items without a field?"""
        return items.isNull() | F.exists(items, lambda x: _any_null(x, fields))

    lacking = (
        F.when(
            kind == PROCESS_LINK,
            _any_null(link, ("process_type", "process_id"))
            | lacks(link["inputs"], "input_type", "input_id")
            | lacks(link["outputs"], "output_type", "output_id")
            | lacks(link["protocols"], "protocol_type", "protocol_id"),
        )
        .when(
            kind == FILE_LINK,
            _any_null(link["entity"], ("entity_type", "entity_id")) | lacks(link["files"], "file_type", "file_id"),
        )
    )
    return (
        F.when(closed, "no links array")
        .when(link.isNull(), None)
        .when(~kind.isin(PROCESS_LINK, FILE_LINK), F.concat(F.lit("unknown link type "), kind))
        .when(lacking, F.concat(F.lit("incomplete "), kind))
    )


def link_problems(links: DataFrame) -> DataFrame:
    """Links rows that cannot be opened in full: ``links_id, project_id, problem``.

    Problems: unreadable content or no links array, an unknown link type, a missing part of a link.
    """
    opened = with_links(links).select("links_id", "project_id", F.explode_outer("links").alias("link"), F.col("links").isNull().alias("closed"))
    problem = _problem_of_link(F.col("link"), F.col("closed"))
    return opened.select("links_id", "project_id", problem.alias("problem")).filter("problem is not null").distinct()


def graph_items(links: DataFrame) -> DataFrame:
    """The nodes of all links, and the problems, in one pass; every document is parsed once.

    ``links_id, project_id`` with ``entity_type, entity_id`` of a node, or else a ``problem``.
    """
    opened = with_links(links).select(
        "links_id", "project_id", F.posexplode_outer("links").alias("position", "link"), F.col("links").isNull().alias("closed"))
    own = F.when(F.coalesce(F.col("position"), F.lit(0)) == 0, _node(F.lit(LINKS), F.col("links_id"))).otherwise(F.array().cast(NODES))
    nodes = F.concat(own, F.coalesce(_nodes_of_link(F.col("link")), F.array().cast(NODES)))
    found = opened.select("links_id", "project_id", nodes.alias("nodes"), _problem_of_link(F.col("link"), F.col("closed")).alias("problem"))
    # a problem is a last item without a node
    last = F.when(F.col("problem").isNotNull(), F.array(F.lit(None).cast("struct<entity_type:string,entity_id:string>"))).otherwise(F.array().cast(NODES))
    items = found.select("links_id", "project_id", "problem", F.posexplode(F.concat("nodes", last)).alias("at", "node"), F.size("nodes").alias("n"))
    is_problem = F.col("at") >= F.col("n")
    return items.select("links_id", "project_id", "node.entity_type", "node.entity_id", F.when(is_problem, F.col("problem")).alias("problem"))


def graph_table(links: DataFrame) -> DataFrame:
    """``graph_items`` as a stored table."""
    return land(graph_items(links), "graph")


def _keyed(items: DataFrame) -> DataFrame:
    """``graph_items`` with keys only: a problem stands for its entity type, its links row for the id."""
    problem = F.col("problem")
    return items.select(
        "project_id", F.when(problem.isNotNull(), problem).otherwise(F.col("entity_type")).alias("entity_type"),
        F.when(problem.isNotNull(), F.col("links_id")).otherwise(F.col("entity_id")).alias("entity_id"), problem.isNotNull().alias("unreadable"))


def _keyed_items(links: DataFrame) -> DataFrame:
    return _keyed(graph_items(links))


def foreign_items(links: DataFrame) -> DataFrame:
    """The keys of all items (``entity_type, entity_id, unreadable``) but the links rows themselves, which are there."""
    own = F.col("problem").isNull() & (F.col("entity_type") == LINKS) & (F.col("entity_id") == F.col("links_id"))
    return _keyed(graph_items(links).filter(~F.coalesce(own, F.lit(False)))).drop("project_id")


def first_fault(links: DataFrame, loaded: DataFrame) -> tuple[dict, bool] | None:
    """An unreadable link (and true), or else an expected entity that no table holds (and false), or else nothing.

    Both come from one pass over the documents and one aggregation of keys, which the tasks begin before the shuffle.
    """
    keys = ["entity_type", "entity_id", "unreadable"]
    stored = loaded.filter("entity_type is not null and entity_id is not null").select(
        "entity_type", "entity_id", F.lit(False).alias("unreadable"), F.lit(True).alias("stored"))
    tagged = _keyed_items(links).select(*keys, F.lit(False).alias("stored")).unionByName(stored)
    open_keys = tagged.groupBy(*keys).agg(F.max("stored").alias("stored")).filter("not stored")
    found = open_keys.orderBy(F.desc("unreadable")).limit(1).collect()
    if not found:
        return None
    if found[0].unreadable:
        return link_problems(links).first().asDict(), True
    return {"entity_type": found[0].entity_type, "entity_id": found[0].entity_id}, False


def nodes_in(graph: DataFrame) -> DataFrame:
    """The nodes of a ``graph_table``, as ``subgraph_nodes`` gives them."""
    return graph.filter("problem is null").drop("problem")


def problems_in(graph: DataFrame) -> DataFrame:
    """The problems of a ``graph_table``, as ``link_problems`` gives them."""
    return graph.filter("problem is not null").select("links_id", "project_id", "problem").distinct()


def expected_entities(nodes: DataFrame) -> DataFrame:
    """Distinct nodes, whatever links name them."""
    return nodes.select("entity_type", "entity_id").distinct()


def missing_entities(nodes: DataFrame, loaded: DataFrame) -> DataFrame:
    """Expected entities no table holds."""
    stored = loaded.select("entity_type", "entity_id").distinct()
    return expected_entities(nodes).join(stored, ["entity_type", "entity_id"], "left_anti")


def _met(wanted: DataFrame, loaded: DataFrame, how: str, projects: DataFrame) -> DataFrame:
    """Distinct entities by project, joined to the loaded ones (``stored`` is true).

    An entity has at most a row for each of the projects, so it can only be heavy where they are more than a slice
    has rows. Else the rows and the loaded entities, in the partitions of their distinct, meet in one shuffle each.
    """
    keys = ["entity_type", "entity_id"]
    stored = loaded.select(*keys).distinct().withColumn("stored", F.lit(True))
    if within_slice(projects.select("project_id")):
        return wanted.join(stored, keys, how)
    return spread_join(land(wanted, "nodes"), stored, keys, how, ["project_id"])


def missing_by_project(nodes: DataFrame, loaded: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """``project_id`` and each entity its subgraphs expect that no table holds.

    ``links`` are the rows of the nodes, whose projects are counted without opening a document.
    """
    wanted = nodes.select("project_id", "entity_type", "entity_id").distinct()
    return _met(wanted, loaded, "left_anti", nodes if links is None else links).select("project_id", "entity_type", "entity_id")


def project_report(links: DataFrame, loaded: DataFrame) -> DataFrame:
    """Per project: links rows, distinct expected entities, missing ones, unreadable links, and ``verified``."""
    found = _met(_keyed_items(links).distinct(), loaded, "left", links)
    zero = F.lit(0).cast("bigint")
    one = F.lit(1).cast("bigint")
    unreadable = F.col("unreadable")
    parts = links.select("project_id", one.alias("n_links"), zero.alias("n_expected"), zero.alias("n_missing"), zero.alias("n_problems")).unionByName(
        found.select(
            "project_id", zero.alias("n_links"), F.when(unreadable, zero).otherwise(one).alias("n_expected"),
            F.when(~unreadable & F.col("stored").isNull(), one).otherwise(zero).alias("n_missing"),
            F.when(unreadable, one).otherwise(zero).alias("n_problems"),
        ))
    names = ["n_links", "n_expected", "n_missing", "n_problems"]
    summed = parts.groupBy("project_id").agg(*[F.sum(n).alias(n) for n in names])
    verified = (F.col("n_missing") == 0) & (F.col("n_problems") == 0)
    return summed.withColumn("verified", verified)


def verify_projects(projects: DataFrame, links: DataFrame, loaded: DataFrame) -> DataFrame:
    """``project_report`` for each project of a list; one without links is not verified.

    Only the links of the list's projects are opened.
    """
    asked = projects.select("project_id").distinct()
    own = links.join(small(asked), "project_id", "left_semi")
    report = asked.join(project_report(own, loaded), "project_id", "left")
    filled = report.fillna(0, ["n_links", "n_expected", "n_missing", "n_problems"])
    return filled.withColumn("verified", F.coalesce(F.col("verified"), F.lit(False)))


def distinct_projects(links: DataFrame) -> DataFrame:
    """Projects the links refer to."""
    return links.select("project_id").distinct()


def project_set_difference(found: DataFrame, expected: DataFrame) -> DataFrame:
    """Projects on one side only: ``project_id, side`` (``unexpected`` or ``absent``); no rows means equal."""
    have, want = found.select("project_id").distinct(), expected.select("project_id").distinct()
    unexpected = have.join(want, "project_id", "left_anti").withColumn("side", F.lit("unexpected"))
    absent = want.join(have, "project_id", "left_anti").withColumn("side", F.lit("absent"))
    return unexpected.unionByName(absent)
