"""Diffs, appends, lookups and dangling references."""

from pyspark.sql import functions as F

from registry import query
from registry import frames as R
from strandline.operators import checks, diff, inventory, rows, subgraphs

KEYS = ("entity_id", "version")


@query("j3_staged_existing_diff", R.with_ctes("staged", "existing", """
    SELECT e.row_id, s.source_row, s.entity_id, s.version, e.entity_id AS existing_entity_id, e.version AS existing_version,
           CASE WHEN e.row_id IS NULL THEN 'new' WHEN s.source_row IS NULL THEN 'gone' ELSE 'same' END AS status
    FROM staged s FULL JOIN existing e ON s.entity_id = e.entity_id AND s.version = e.version"""))
def staged_existing_diff(s, d):
    found = diff.diff(R.staged(s, d), R.existing(s, d), KEYS)
    return found.select("row_id", "source_row", "entity_id", "version", "existing_entity_id", "existing_version", "status")


APPEND_SQL = R.with_ctes("staged", "existing", """
    SELECT source_row, entity_id, version, content FROM staged s
    WHERE entity_id IS NOT NULL AND version IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM existing e WHERE e.entity_id = s.entity_id AND e.version = s.version)""")
COLUMNS = ("source_row", "entity_id", "version", "content")

query("j4_rows_to_append", APPEND_SQL)(
    lambda s, d: diff.rows_to_append(R.staged(s, d), R.existing(s, d), KEYS).select(*COLUMNS))

query("p10_append_predicate", APPEND_SQL)(
    lambda s, d: diff.append_predicate(diff.diff(R.staged(s, d), R.existing(s, d), KEYS), KEYS).select(*COLUMNS))


@query("j8_dangling_project_refs", """
    SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS links_id FROM orders o
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 500)""")
def dangling_project_refs(s, d):
    links = R.table(s, d, "orders").select(R.text("o_orderkey").alias("links_id"), R.text("o_custkey").alias("project_id"))
    projects = R.table(s, d, "customer").filter("c_acctbal > 500").select(R.text("c_custkey").alias("project_id"))
    return checks.dangling_links(links, projects)


@query("j17_lookup_by_id_list", """
    SELECT CAST(o_orderkey AS VARCHAR) AS row_id, CAST(o_custkey AS VARCHAR) AS entity_id FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def lookup_by_id_list(s, d):
    stored = R.table(s, d, "orders").select(R.text("o_orderkey").alias("row_id"), R.text("o_custkey").alias("entity_id"))
    ids = R.table(s, d, "customer").filter("c_mktsegment = 'BUILDING'").select(R.text("c_custkey").alias("entity_id"))
    return rows.rows_with_ids(stored, ids, "entity_id", ["row_id"])


@query("u2_set_difference", """
    SELECT DISTINCT l_partkey AS part FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)""")
def set_difference(s, d):
    expected = R.table(s, d, "lineitem").select(F.col("l_partkey").alias("part"))
    return rows.without_rows(expected, R.table(s, d, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("part")), "part")


@query("u5_project_sets", """
    SELECT CAST(o_custkey AS VARCHAR) AS project_id, 'unexpected' AS side FROM (
        SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0)
    UNION ALL
    SELECT CAST(c_custkey AS VARCHAR), 'absent' FROM (
        SELECT c_custkey FROM customer WHERE c_acctbal > 0 EXCEPT SELECT o_custkey FROM orders)""")
def project_sets(s, d):
    found = R.table(s, d, "orders").select(R.text("o_custkey").alias("project_id"))
    expected = R.table(s, d, "customer").filter("c_acctbal > 0").select(R.text("c_custkey").alias("project_id"))
    return subgraphs.project_set_difference(found, expected)


query("a10_distinct_projects", "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS project_id FROM orders")(
    lambda s, d: subgraphs.distinct_projects(R.table(s, d, "orders").select(R.text("o_custkey").alias("project_id"))))


def _snapshots(s, d):
    """A snapshot per order, named after the digest of its customer, with the order's priority as catalog."""
    digest = F.md5(R.text("o_custkey"))
    catalog = F.lower(F.regexp_replace("o_orderpriority", "[^A-Za-z]", ""))
    created = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return R.table(s, d, "orders").select(
        R.text("o_orderkey").alias("id"),
        F.concat(F.lit("atlas_prod_"), digest, F.lit("__"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), catalog,
                 F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_r"), R.text("o_orderkey")).alias("name"),
        R.text("o_custkey").alias("data_project"), created.alias("created_date"))


SNAPSHOTS = """snapshots AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey,
           'atlas_prod_' || md5(CAST(o_custkey AS VARCHAR)) || '__' || strftime(o_orderdate, '%Y%m%d') || '_'
           || lower(regexp_replace(o_orderpriority, '[^A-Za-z]', '', 'g')) || '_' || strftime(o_orderdate, '%Y%m%d') || '_r' || o_orderkey AS name,
           CAST(o_custkey AS VARCHAR) AS data_project, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_date
    FROM orders)"""


@query("j14_released_projects", f"""
    WITH {SNAPSHOTS}, projects AS (
        SELECT substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) || '-' || substr(md5(CAST(c_custkey AS VARCHAR)), 9) AS project_id,
               md5(CAST(c_custkey AS VARCHAR)) AS compact FROM customer)
    SELECT p.project_id, min(n.name) AS snapshot, min(n.name) IS NOT NULL AS found
    FROM projects p LEFT JOIN snapshots n ON starts_with(n.name, 'atlas_prod_' || p.compact) AND contains(n.name, '_urgent_')
    GROUP BY p.project_id""")
def released_projects(s, d):
    digest = F.md5(R.text("c_custkey"))
    projects = R.table(s, d, "customer").select(F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 32)).alias("project_id"))
    return inventory.released_projects(projects, _snapshots(s, d), "atlas_prod", "urgent")


FLAGGED = f"""
    WITH {SNAPSHOTS}
    SELECT {{}} FROM snapshots n LEFT JOIN customer c ON n.o_custkey = c.c_custkey AND c_acctbal > 1000 {{}}"""


def _policies(s, d):
    return R.table(s, d, "orders").join(R.table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        R.text("o_orderkey").alias("id"), (F.col("c_acctbal") > 1000).alias("public"))


query("j16_public_flag", FLAGGED.format("id, name, CASE WHEN c_custkey IS NULL THEN 'N' ELSE 'Y' END AS public_flag", ""))(
    lambda s, d: inventory.with_public_flag(_snapshots(s, d), _policies(s, d)).select("id", "name", "public_flag"))

query("p19_release_snapshots", f"WITH {SNAPSHOTS} SELECT id, name FROM snapshots WHERE contains(name, '_high')")(
    lambda s, d: inventory.release_snapshots(_snapshots(s, d), "high").select("id", "name"))


@query("k8_inventory_tsv", FLAGGED.format(
    "id, name, data_project, substr(created_date, 1, 10) AS created_day, created_date, CASE WHEN c_custkey IS NULL THEN 'N' ELSE 'Y' END AS public_flag",
    "WHERE contains(name, '_high')"))
def inventory_tsv(s, d):
    from strandline.session import work_path
    from strandline.sinks.writers import write_tsv

    found = inventory.snapshot_inventory(_snapshots(s, d), _policies(s, d), "high")
    path = work_path(s, "inventory")
    write_tsv(found, path)
    return s.read.schema(found.schema).option("sep", "\t").option("header", True).csv(path)


@query("p16_audit_names", f"""
    WITH {SNAPSHOTS}, names AS (
        SELECT name, 'snapshot' AS form, md5(CAST(o_custkey AS VARCHAR)) AS project_id FROM snapshots
        UNION ALL SELECT 'atlas_dev_' || md5(c_name) || '__20200812', 'dataset', md5(c_name) FROM customer
        UNION ALL SELECT 'atlas_prod_20200101_q__20200102', 'invalid', NULL FROM supplier
        UNION ALL SELECT 'atlas_prod_20200101_' || url, 'invalid', NULL FROM pages)
    SELECT name, CASE WHEN form = 'snapshot' AND length(regexp_extract(name, '_r([0-9]+)$', 1)) > 14 THEN 'invalid' ELSE form END AS form,
           CASE WHEN form <> 'invalid' THEN 'atlas' END AS atlas,
           CASE form WHEN 'snapshot' THEN 'prod' WHEN 'dataset' THEN 'dev' END AS environment, project_id FROM names""")
def audit_names(s, d):
    names = (
        _snapshots(s, d).select("name")
        .unionByName(R.table(s, d, "customer").select(F.concat(F.lit("atlas_dev_"), F.md5("c_name"), F.lit("__20200812")).alias("name")))
        .unionByName(R.table(s, d, "supplier").select(F.lit("atlas_prod_20200101_q__20200102").alias("name")))
        .unionByName(R.table(s, d, "pages").select(F.concat(F.lit("atlas_prod_20200101_"), "url").alias("name")))
    )
    return inventory.audit_names(names, "atlas", ["atlas", "lung"])
