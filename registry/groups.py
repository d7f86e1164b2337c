"""Aggregates, ranks, set operations and the keep rules."""

from pyspark.sql import functions as F

from registry import query
from registry import frames as R
from strandline.operators import checks, latest, rows
from strandline.operators.release import chunked

E = "entities"

query("a1_latest_version", R.with_ctes(E, """
    SELECT entity_type, entity_id, CAST(version AS VARCHAR) AS latest_version FROM entities e
    WHERE version = (SELECT max(version) FROM entities m WHERE m.entity_type = e.entity_type AND m.entity_id = e.entity_id)
    GROUP BY ALL"""))(
    lambda s, d: latest.latest_versions(R.entities(s, d)).withColumn("latest_version", F.col("latest_version").cast("string")))

query("a2_duplicate_ids", R.with_ctes(E, """
    SELECT entity_type, entity_id, CAST(max(version) AS VARCHAR) AS latest_version, count(*) AS n_rows
    FROM entities GROUP BY ALL HAVING count(*) > 1"""))(
    lambda s, d: latest.duplicate_ids(R.entities(s, d)).withColumn("latest_version", F.col("latest_version").cast("string")))

query("a3_tie_break", R.with_ctes(E, """
    SELECT entity_type, entity_id, row_id AS kept_row_id FROM entities
    QUALIFY row_number() OVER (PARTITION BY entity_type, entity_id ORDER BY version DESC, row_id DESC) = 1"""))(
    lambda s, d: latest.latest_row_ids(R.entities(s, d)))

query("a4_row_count", "SELECT count(*) AS n_rows FROM lineitem")(
    lambda s, d: checks.row_count(R.table(s, d, "lineitem")))

query("a5_empty_table", "SELECT CASE WHEN count(*) = 0 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS n_problems FROM events WHERE value < 0")(
    lambda s, d: checks.empty_table(R.table(s, d, "events").filter("value < 0")))


@query("a12_problem_rows_by_table", R.with_ctes(E, """
    SELECT entity_type, 'duplicates' AS issue, count(*) AS n_rows FROM (
        SELECT entity_type FROM entities QUALIFY row_number() OVER (
            PARTITION BY entity_type, entity_id ORDER BY version DESC, row_id DESC) > 1) GROUP BY ALL
    UNION ALL
    SELECT entity_type, 'null_file_refs', count(*) FROM entities WHERE file_id IS NULL GROUP BY ALL"""))
def problem_rows_by_table(s, d):
    stored = R.entities(s, d).withColumn("descriptor", F.col("content"))
    found = checks.problem_rows(stored)
    # every problem is listed twice, as counts are of distinct rows
    return checks.problems_by_table(found.unionByName(found))


query("a13_distinct_nodes", R.with_ctes("link_nodes", "SELECT DISTINCT entity_type, entity_id FROM link_nodes"))(
    lambda s, d: _nodes(s, d))


def _nodes(s, d):
    from strandline.operators.subgraphs import expected_entities, subgraph_nodes

    return expected_entities(subgraph_nodes(R.links_rows(s, d)))


query("w1_rows_beyond_first", R.with_ctes(E, """
    SELECT entity_type, entity_id, row_id FROM entities
    QUALIFY rank() OVER (PARTITION BY entity_type, entity_id ORDER BY version DESC NULLS LAST, row_id ASC) > 1"""))(
    lambda s, d: latest.rows_beyond_first(R.entities(s, d)).select("entity_type", "entity_id", "row_id"))

query("w2_file_rows_beyond_first", R.with_ctes(E, """
    SELECT entity_type, entity_id, row_id FROM entities
    QUALIFY row_number() OVER (
        PARTITION BY entity_type, entity_id ORDER BY version DESC NULLS LAST, file_id ASC NULLS LAST, row_id ASC) > 1"""))(
    lambda s, d: latest.file_rows_beyond_first(R.entities(s, d)).select("entity_type", "entity_id", "row_id"))


@query("w3_outdated_files", f"""
    WITH files AS (
        SELECT event_type || '/' || user_id || '_' || {R.SQL_VERSION.format('ts')} || '.json' AS blob, event_type AS path,
               CAST(user_id AS VARCHAR) AS entity, {R.SQL_VERSION.format('ts')} || '.json' AS version FROM events)
    SELECT * FROM files f
    WHERE EXISTS (SELECT 1 FROM files g WHERE g.path = f.path AND g.entity = f.entity AND g.version > f.version)""")
def outdated_files(s, d):
    return latest.outdated_files(_inventory(s, d))


def _inventory(s, d):
    version = F.concat(R.version_text(F.col("ts")), F.lit(".json"))
    return R.table(s, d, "events").select(
        F.concat(F.concat_ws("/", "event_type", R.text("user_id")), F.lit("_"), version).alias("blob"),
        F.col("event_type").alias("path"), R.text("user_id").alias("entity"), version.alias("version"))


query("d7_staging_files_to_delete", f"""
    SELECT event_type || '/' || user_id || '_' || {R.SQL_VERSION.format('ts')} || '.json' AS blob FROM events
    QUALIFY ts < max(ts) OVER (PARTITION BY event_type, user_id)""")(
    lambda s, d: latest.outdated_files(_inventory(s, d)).select("blob"))

query("d2_outdated_rows", R.with_ctes(E, """
    SELECT entity_type, entity_id, row_id FROM entities
    QUALIFY version < max(version) OVER (PARTITION BY entity_type, entity_id)"""))(
    lambda s, d: latest.outdated_rows(R.entities(s, d)).select("entity_type", "entity_id", "row_id"))

query("j9_rows_with_latest_version", R.with_ctes(E, """
    SELECT e.row_id, CAST(l.latest AS VARCHAR) AS latest_version FROM entities e
    JOIN (SELECT entity_type, entity_id, max(version) AS latest FROM entities GROUP BY ALL) l
      ON e.entity_type = l.entity_type AND e.entity_id = l.entity_id
    WHERE e.version < l.latest"""))(
    lambda s, d: latest.outdated_rows(R.entities(s, d)).select("row_id", F.col("latest_version").cast("string").alias("latest_version")))

query("d1_duplicate_rows", R.with_ctes(E, """
    SELECT e.entity_type, e.entity_id, e.row_id FROM entities e
    WHERE e.row_id <> (SELECT max(m.row_id) FROM entities m
                       WHERE m.entity_type = e.entity_type AND m.entity_id = e.entity_id
                         AND m.version = (SELECT max(v.version) FROM entities v
                                          WHERE v.entity_type = e.entity_type AND v.entity_id = e.entity_id))"""))(
    lambda s, d: latest.duplicate_rows(R.entities(s, d)))


@query("u1_except_distinct", R.with_ctes(E, """
    SELECT row_id FROM entities
    EXCEPT
    SELECT row_id FROM entities
    QUALIFY row_number() OVER (PARTITION BY entity_type, entity_id ORDER BY version DESC, row_id DESC) = 1"""))
def except_distinct(s, d):
    stored = R.entities(s, d)
    kept = latest.latest_row_ids(stored).select(F.col("kept_row_id").alias("row_id"))
    return rows.without_rows(stored, kept, "row_id")


@query("u3_union_of_types", """
    SELECT 'project' AS entity_type, CAST(c_custkey AS VARCHAR) AS entity_id, c_mktsegment AS content, NULL AS file_id, NULL AS project_id FROM customer
    UNION ALL SELECT 'image_file', CAST(p_partkey AS VARCHAR), p_type, p_brand, NULL FROM part
    UNION ALL SELECT 'links', CAST(o_orderkey AS VARCHAR), o_orderstatus, NULL, CAST(o_custkey AS VARCHAR) FROM orders""")
def union_of_types(s, d):
    tables = {
        "project": R.table(s, d, "customer").select(R.text("c_custkey").alias("project_id"), F.lit("v").alias("version"), F.col("c_mktsegment").alias("content")),
        "image_file": R.table(s, d, "part").select(R.text("p_partkey").alias("image_file_id"), F.lit("v").alias("version"), F.col("p_brand").alias("file_id"), F.col("p_type").alias("content")),
        "links": R.table(s, d, "orders").select(R.text("o_orderkey").alias("links_id"), F.lit("v").alias("version"), R.text("o_custkey").alias("project_id"), F.col("o_orderstatus").alias("content")),
    }
    return rows.union_of_types(tables).select("entity_type", "entity_id", "content", "file_id", "project_id")


query("r1_sorted_projects", "SELECT CAST(c_custkey AS VARCHAR) AS project_id, c_name AS name FROM customer")(
    lambda s, d: R.table(s, d, "customer").select(R.text("c_custkey").alias("project_id"), F.col("c_name").alias("name")).orderBy("project_id"))

query("r2_chunks_of_twenty", """
    SELECT url, CAST((row_number() OVER (ORDER BY url) - 1) // 20 AS INTEGER) AS chunk FROM (SELECT DISTINCT url FROM pages)""")(
    lambda s, d: chunked(R.table(s, d, "pages"), "url").select("url", "chunk"))
