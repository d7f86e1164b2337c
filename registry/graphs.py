"""Subgraphs of links documents."""

from pyspark.sql import functions as F

from registry import query
from registry import frames as R
from strandline.operators import subgraphs

NODES, LOADED = "link_nodes", "loaded"

query("v5_subgraph_nodes", R.with_ctes(NODES, "SELECT links_id, project_id, entity_type, entity_id FROM link_nodes"))(
    lambda s, d: subgraphs.subgraph_nodes(R.links_rows(s, d)))

query("j10_missing_entities", R.with_ctes(NODES, LOADED, """
    SELECT entity_type, entity_id FROM link_nodes EXCEPT SELECT entity_type, entity_id FROM loaded"""))(
    lambda s, d: subgraphs.missing_entities(subgraphs.subgraph_nodes(R.links_rows(s, d)), R.loaded_entities(s, d)))

query("v6_missing_entities_by_project", R.with_ctes(NODES, LOADED, """
    SELECT DISTINCT n.project_id, n.entity_type, n.entity_id FROM link_nodes n
    LEFT JOIN loaded l ON l.entity_type = n.entity_type AND l.entity_id = n.entity_id WHERE l.entity_id IS NULL"""))(
    lambda s, d: subgraphs.missing_by_project(subgraphs.subgraph_nodes(R.links_rows(s, d)), R.loaded_entities(s, d), R.links_rows(s, d)))

REPORT = """
    expected AS (SELECT DISTINCT project_id, entity_type, entity_id FROM link_nodes),
    counts AS (
        SELECT e.project_id, count(*) AS n_expected, count(*) FILTER (WHERE l.entity_id IS NULL) AS n_missing
        FROM expected e LEFT JOIN loaded l ON l.entity_type = e.entity_type AND l.entity_id = e.entity_id GROUP BY ALL),
    mentions AS (SELECT project_id, count(*) AS n_links FROM link_nodes WHERE entity_type = 'links' GROUP BY ALL)"""


@query("v7_single_project", f"""
    {R.with_ctes(NODES, LOADED, '').rstrip()}, whole AS (SELECT DISTINCT entity_type, entity_id FROM link_nodes)
    SELECT 'P' AS project_id, (SELECT count(*) FROM lineitem) AS n_links, count(*) AS n_expected,
           count(*) FILTER (WHERE l.entity_id IS NULL) AS n_missing, CAST(0 AS BIGINT) AS n_problems, false AS verified
    FROM whole w LEFT JOIN loaded l ON l.entity_type = w.entity_type AND l.entity_id = w.entity_id""")
def single_project(s, d):
    # all links belong to one project
    return subgraphs.project_report(R.links_rows(s, d).withColumn("project_id", F.lit("P")), R.loaded_entities(s, d))


@query("v10_projects_of_a_list", R.with_ctes(NODES, LOADED, "").rstrip() + "," + REPORT + """,
    asked AS (SELECT CAST(s_suppkey AS VARCHAR) AS project_id FROM supplier UNION SELECT c_name FROM customer)
    SELECT project_id, coalesce(n_links, 0) AS n_links, coalesce(n_expected, 0) AS n_expected, coalesce(n_missing, 0) AS n_missing,
           CAST(0 AS BIGINT) AS n_problems, coalesce(n_missing = 0, false) AS verified
    FROM asked LEFT JOIN counts USING (project_id) LEFT JOIN mentions USING (project_id)""")
def projects_of_a_list(s, d):
    asked = R.table(s, d, "supplier").select(R.text("s_suppkey").alias("project_id")).unionByName(
        R.table(s, d, "customer").select(F.col("c_name").alias("project_id")))
    return subgraphs.verify_projects(asked, R.links_rows(s, d), R.loaded_entities(s, d))


@query("v5_unreadable_links", """
    SELECT CAST(o_orderkey AS VARCHAR) AS links_id, CASE o_orderstatus WHEN 'P' THEN 'unknown link type odd_link' ELSE 'incomplete process_link' END AS problem
    FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT 'doc' || doc_id, 'no links array' FROM documents""")
def unreadable_links(s, d):
    status = F.col("o_orderstatus")
    start = '{"links":[{"link_type":"process_link","process_type":"process","process_id":"1","inputs":[],"protocols":[]'
    content = (
        F.when(status == "P", F.lit('{"links":[{"link_type":"odd_link"}]}')).when(status == "O", F.lit(start + "}]}"))
        .otherwise(F.lit(start + ',"outputs":[]}]}'))
    )
    links = R.table(s, d, "orders").select(R.text("o_orderkey").alias("links_id"), F.lit("p").alias("project_id"), content.alias("content"))
    texts = R.table(s, d, "documents").select(F.concat(F.lit("doc"), R.text("doc_id")).alias("links_id"), F.lit("p").alias("project_id"), F.col("text").alias("content"))
    return subgraphs.link_problems(links.unionByName(texts)).select("links_id", "problem")
