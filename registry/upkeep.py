"""Stores: loads, soft deletion, checks and snapshots."""

from pyspark.sql import functions as F

from registry import query
from registry import frames as R
from strandline.operators import checks, latest, subgraphs
from strandline.operators import rows as rows_ops
from strandline.operators.skew import BROADCAST_KEYS
from strandline.plans import check, load, snapshot, upkeep
from strandline.plans.store import Store
from strandline.session import land, work_path
from strandline.sinks.writers import STORED


def _dataset(s, d, version=None):
    """A data set of file rows (events), links (orders) and projects (some of the customers)."""
    null = F.lit(None).cast("string")
    files = R.table(s, d, "events").select(
        F.col("event_type").alias("entity_type"), R.text("user_id").alias("entity_id"), (F.date_trunc("day", "ts").cast("timestamp") if version is None else version).alias("version"),
        F.col("props").alias("content"), null.alias("project_id"),
        F.when(F.col("value") > 20, F.concat(F.lit("f"), R.text("event_id"))).alias("file_id"), F.col("props").alias("descriptor"),
        F.concat(F.lit("e"), F.lpad(R.text("event_id"), 12, "0")).alias("row_id"))
    links = R.table(s, d, "orders").select(
        F.lit("links").alias("entity_type"), R.text("o_orderkey").alias("entity_id"), F.col("o_orderdate").cast("timestamp").alias("version"),
        F.lit("{}").alias("content"), R.text("o_custkey").alias("project_id"), null.alias("file_id"), null.alias("descriptor"),
        F.concat(F.lit("o"), R.text("o_orderkey")).alias("row_id"))
    projects = R.table(s, d, "customer").filter("c_acctbal > 500").select(
        F.lit("project").alias("entity_type"), R.text("c_custkey").alias("entity_id"), F.lit("2024-01-01").cast("timestamp").alias("version"),
        F.lit("{}").alias("content"), null.alias("project_id"), null.alias("file_id"), null.alias("descriptor"),
        F.concat(F.lit("c"), R.text("c_custkey")).alias("row_id"))
    return files.unionByName(links).unionByName(projects)


SQL_COUNTS = """
    SELECT (SELECT count(*) FROM (SELECT 1 FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY CAST(ts AS DATE) DESC, event_id DESC) > 1)) AS duplicates,
           (SELECT count(*) FROM events WHERE value <= 20) AS null_file_refs,
           (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 500)) AS dangling_project_refs,
           CAST(0 AS BIGINT) AS empty_links_count, CAST(0 AS BIGINT) AS empty_projects_count, true AS has_problems"""

query("a9_problem_counts", SQL_COUNTS)(lambda s, d: checks.problem_counts(_dataset(s, d)))


@query("v8_dataset_check", """
    SELECT (SELECT count(*) FROM (SELECT 1 FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY CAST(ts AS DATE) DESC, event_id DESC) > 1)) AS duplicates,
           (SELECT count(*) FROM events WHERE value <= 20) AS null_file_refs, CAST(0 AS BIGINT) AS dangling_project_refs,
           CAST(1 AS BIGINT) AS empty_links_count, CAST(0 AS BIGINT) AS empty_projects_count, true AS has_problems""")
def dataset_check(s, d):
    # without its links
    return checks.problem_counts(_dataset(s, d).filter("entity_type <> 'links'"))


query("j13_tables_with_a_column", """
    SELECT 'documents' AS table_name, count(*) AS n_rows FROM documents UNION ALL SELECT 'labels', count(*) FROM labels""")(
    lambda s, d: _counts_of_tables_with(s, d, "doc_id"))


def _counts_of_tables_with(s, d, column):
    tables = {name: R.table(s, d, name) for name in ("customer", "orders", "lineitem", "events", "documents", "labels", "pages", "conversations")}
    parts = [tables[name].agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name in rows_ops.tables_with_column(tables, column)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


PROJECT_SQL = """
    SELECT CASE WHEN o_orderstatus = 'F' THEN 'project' ELSE 'links' END AS table_name, CAST(o_orderkey AS VARCHAR) AS row_id
    FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus IN ('F', 'O')"""


def _orders_as_rows(s, d):
    """Orders as project rows (F), links rows (O) and others (P); the priority is the project."""
    status = F.col("o_orderstatus")
    return R.table(s, d, "orders").select(
        F.when(status == "F", "project").when(status == "O", "links").otherwise("protocol").alias("entity_type"),
        F.when(status == "O", R.text("o_orderkey")).otherwise(F.col("o_orderpriority")).alias("entity_id"),
        F.when(status == "O", F.col("o_orderpriority")).alias("project_id"), R.text("o_orderkey").alias("row_id"))


query("p13_rows_of_a_project", PROJECT_SQL)(
    lambda s, d: rows_ops.project_rows(_orders_as_rows(s, d), "1-URGENT").select("table_name", "row_id"))

query("d8_removal_of_a_project", """
    SELECT CAST(o_orderkey AS VARCHAR) AS row_id FROM orders WHERE o_orderpriority <> '1-URGENT' OR o_orderstatus = 'P'""")(
    lambda s, d: rows_ops.live_rows(
        _orders_as_rows(s, d), rows_ops.tombstones_for(rows_ops.project_rows(_orders_as_rows(s, d), "1-URGENT"))).select("row_id"))

def _store_of(s, rows):
    """A store that holds the rows, each with its own row id as its content, for the store gives new ones."""
    store = Store(s, work_path(s, "store"))
    store.append(rows.withColumn("content", F.col("row_id")).drop("row_id"))
    return store


def _orders_store(s, d):
    years = F.date_trunc("year", "o_orderdate").cast("timestamp")
    dates = R.table(s, d, "orders").select(R.text("o_orderkey").alias("row_id"), years.alias("version"))
    return _store_of(s, _orders_as_rows(s, d).join(dates, "row_id"))


@query("d8_removal_job", """
    SELECT CAST(o_orderkey AS VARCHAR) AS row_id FROM orders WHERE o_orderpriority <> '1-URGENT' OR o_orderstatus = 'P'""")
def removal_job(s, d):
    """By control files, from the store."""
    store = _orders_store(s, d)
    upkeep.remove_project(store, "1-URGENT", work_path(s, "control"))
    return store.live().select(F.col("content").alias("row_id"))


@query("w1_spare_rows_job", """
    SELECT o_orderpriority AS entity_id, count(*) - 1 AS n_spare, true AS newest_too
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) > 1""")
def spare_rows_job(s, d):
    """All but one row of each id of a table; whether a row of the newest version is left in the store."""
    store = _orders_store(s, d)
    path = work_path(s, "spare")
    upkeep.write_spare_rows(store, "project", path)
    projects = store.live(["project"])
    listed = projects.join(s.read.schema("row_id string").csv(path), "row_id", "left_semi")
    kept = projects.join(listed, "row_id", "left_anti").groupBy("entity_id").agg(F.max("version").alias("kept"))
    newest = projects.groupBy("entity_id").agg(F.max("version").alias("newest"))
    spare = listed.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_spare"))
    return spare.join(kept, "entity_id").join(newest, "entity_id").select("entity_id", "n_spare", (F.col("kept") == F.col("newest")).alias("newest_too"))


@query("j7_export_of_file_ids", f"""
    SELECT {R.SQL_ITEM_ID} AS sequence_file_id, CASE WHEN o_orderstatus = 'F' THEN 'f' || o_orderkey END AS file_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def export_of_file_ids(s, d):
    """Stored file rows, exported with the ids that the load history has for them."""
    store = Store(s, work_path(s, "store"))
    store.append(R.file_rows(s, d).withColumns({"version": F.lit("2024-01-01").cast("timestamp"), "content": F.lit("{}")}))
    store.add_history(R.history(s, d))
    path = work_path(s, "export")
    upkeep.export_file_ids(store, "sequence_file", path)
    return s.read.schema("sequence_file_id string, file_id string").json(path)


@query("d3_soft_delete", R.with_ctes("entities", """
    SELECT entity_type, row_id FROM entities
    QUALIFY version = max(version) OVER (PARTITION BY entity_type, entity_id)"""))
def soft_delete(s, d):
    rows = R.entities(s, d).withColumn("version", F.col("version").cast("timestamp"))
    store = _store_of(s, rows)
    store.soft_delete(latest.outdated_rows(store.live()))
    return store.live().select("entity_type", F.col("content").alias("row_id"))


@query("d4_check_and_remove", """
    SELECT * FROM (SELECT event_type AS entity_type, CAST(event_id AS VARCHAR) AS content_id FROM events
                   QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1 AND value > 20)
    UNION ALL SELECT 'links', CAST(o_orderkey AS VARCHAR) FROM orders
    UNION ALL SELECT 'project', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal > 500""")
def check_and_remove(s, d):
    """Duplicates and null file references go; dangling links stay."""
    rows = _dataset(s, d, F.col("ts").cast("timestamp"))
    store = _store_of(s, rows)
    check.remove_problems(store)
    key = F.regexp_replace("content", "^(o|c|e0*)", "")
    return store.live().select("entity_type", F.when(key == "", "0").otherwise(key).alias("content_id"))


def _events(s, d):
    return R.table(s, d, "events").select(
        F.col("event_type").alias("entity_type"), R.text("user_id").alias("entity_id"), F.col("ts").cast("timestamp").alias("version"),
        F.col("props").alias("content"), F.lit("a").alias("area"), F.lit("c").alias("crc32c"), "value")


def _loaded_store(s, d):
    """A store with all events loaded."""
    store = Store(s, work_path(s, "store"))
    load.load(_events(s, d).drop("value"), store)
    return store


def _later(s, d):
    """The events of a value above 50 a day later."""
    return _events(s, d).filter("value > 50").drop("value").withColumn("version", F.expr("version + interval 1 day"))


_LATER = """SELECT event_type, user_id, ts, props FROM events
    UNION ALL SELECT event_type, user_id, ts + INTERVAL 1 DAY, props FROM events WHERE value > 50"""
SQL_LIVE = f"""
    SELECT event_type AS entity_type, CAST(user_id AS VARCHAR) AS entity_id, {R.SQL_VERSION.format('ts')} AS version, props AS content
    FROM ({_LATER}) QUALIFY ts = max(ts) OVER (PARTITION BY event_type, user_id)"""
LIVE = ("entity_type", "entity_id", "version", "content")


def _live(store):
    return store.live().withColumn("version", R.version_text(F.col("version"))).select(*LIVE)


@query("d5_upsert_load", SQL_LIVE)
def upsert_load(s, d):
    """All events, then later versions of some: only the newest version of each id is live."""
    store = _loaded_store(s, d)
    load.load(_later(s, d), store)
    return _live(store)


@query("d5_load_after_a_break", SQL_LIVE)
def load_after_a_break(s, d):
    """The same where the second load broke off after its append and is run again."""
    store = _loaded_store(s, d)
    store.append(_later(s, d).drop("area", "crc32c"))
    load.load(_later(s, d), store)
    return _live(store)


@query("d5_second_load_appends_nothing", "SELECT count(*) AS n_rows FROM (SELECT DISTINCT event_type, user_id, ts FROM events)")
def second_load(s, d):
    store = _loaded_store(s, d)
    staged = store.raw().drop("row_id", "version_date").withColumns({"area": F.lit("a"), "crc32c": F.lit("c")})
    load.load(staged, store, against="raw")
    return checks.row_count(store.raw())


@query("d6_full_view_snapshot", f"""
    SELECT event_type AS entity_type, CAST(user_id AS VARCHAR) AS entity_id, {R.SQL_VERSION.format('ts')} AS version, props AS content
    FROM events QUALIFY ts = max(ts) OVER (PARTITION BY event_type, user_id)""")
def full_view_snapshot(s, d):
    copy = snapshot.create_snapshot(_loaded_store(s, d), work_path(s, "snapshots"), "atlas_dev___20240101")
    return copy.withColumn("version", R.version_text(F.col("version"))).select(*LIVE)


def _first_of_each(rows, repeated):
    """The rows of ids that occur once as they are, and the smallest content of each repeated one."""
    first = rows.groupBy("entity_type", "entity_id", "project_id").agg(F.min("content").alias("content"))
    if repeated.limit(BROADCAST_KEYS + 1).count() > BROADCAST_KEYS:
        return first
    ids = F.broadcast(repeated)
    return rows.join(ids, "entity_id", "left_anti").select(*rows.columns).unionByName(
        rows.join(ids, "entity_id", "left_semi").groupBy("entity_type", "entity_id", "project_id").agg(F.min("content").alias("content")))


def _linked(s, d, project_id):
    """Links of one project in the long form, one for each id, and the entities that they name."""
    links = R.links_rows(s, d).select(F.lit("links").alias("entity_type"), F.col("links_id").alias("entity_id"), F.lit(project_id).alias("project_id"), "content")
    # only ids are shuffled to find the repeated ones
    repeated = land(links.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("entity_id"), "repeated")
    # stored, as the checks read them several times
    links = land(_first_of_each(links, repeated), "linked", codec=STORED)
    named = subgraphs.expected_entities(subgraphs.subgraph_nodes(subgraphs.links_of(links)).filter("entity_type <> 'links'"))
    return links, land(named.select("entity_type", "entity_id"), "named", codec=STORED)


def _passes(job, *arguments):
    try:
        job(*arguments)
        return True
    except (subgraphs.SubgraphError, check.DatasetProblems):
        return False


@query("v7_require_single_project", R.with_ctes("link_nodes", "loaded", """
    SELECT 'complete' AS given, true AS passes
    UNION ALL SELECT 'loaded', (SELECT count(*) FROM (SELECT entity_type, entity_id FROM link_nodes EXCEPT SELECT entity_type, entity_id FROM loaded)) = 0
    UNION ALL SELECT 'another project', false"""))
def require_single_project(s, d):
    links, named = _linked(s, d, "P")
    complete = links.unionByName(named, allowMissingColumns=True)
    loaded = links.unionByName(R.loaded_entities(s, d), allowMissingColumns=True)
    found = [("complete", _passes(check.require_single_project, complete, "P")), ("loaded", _passes(check.require_single_project, loaded, "P")),
             ("another project", _passes(check.require_single_project, complete, "Q"))]
    return s.createDataFrame(found, "given string, passes boolean")


@query("v11_require_copy", R.with_ctes("link_nodes", "loaded", """
    SELECT 'complete' AS given, (SELECT count(*) > 0 FROM link_nodes) AS passes UNION ALL SELECT 'another project', false UNION ALL SELECT 'doubled', false"""))
def require_copy(s, d):
    links, named = _linked(s, d, "P")
    null = F.lit(None).cast("string")
    project = s.createDataFrame([("project", "P", None, "{}")], "entity_type string, entity_id string, project_id string, content string")
    # links and entities are distinct already, and stored; the project may be among the entities
    others = named.filter("not (entity_type = 'project' and entity_id = 'P')").withColumns({"project_id": null, "content": F.lit("{}")})
    rows = links.unionByName(others).unionByName(project)
    rows = rows.withColumns({"version": F.lit("2024-01-01").cast("timestamp"), "file_id": F.lit("f"), "descriptor": F.lit("{}")})
    store = Store(s, work_path(s, "store"))
    store.append(rows)
    found = [("complete", _passes(check.require_copy, store, "P")), ("another project", _passes(check.require_copy, store, "Q"))]
    store.append(rows)
    found.append(("doubled", _passes(check.require_copy, store, "P")))
    return s.createDataFrame(found, "given string, passes boolean")


@query("v11_copied_dataset", R.with_ctes("link_nodes", "loaded", """
    SELECT (SELECT count(*) FROM (SELECT DISTINCT project_id FROM link_nodes)) - 1 AS other_projects,
           (SELECT count(*) FROM (SELECT entity_type, entity_id FROM link_nodes EXCEPT SELECT entity_type, entity_id FROM loaded)) AS missing,
           CAST(0 AS BIGINT) AS duplicates"""))
def copied_dataset(s, d):
    links = R.links_rows(s, d)
    expected = s.createDataFrame([("1",)], "project_id string")
    others = subgraphs.project_set_difference(subgraphs.distinct_projects(links), expected)
    # stored, as both counts read it, one of them several times
    loaded = land(R.loaded_entities(s, d).distinct(), "loaded")
    missing = subgraphs.missing_entities(subgraphs.subgraph_nodes(links), loaded)
    stored = loaded.withColumns({"version": F.lit(1), "row_id": F.concat_ws("/", "entity_type", "entity_id")})
    count = F.count(F.lit(1))
    return others.agg(count.alias("other_projects")).select(
        "other_projects", missing.agg(count).scalar().alias("missing"), latest.duplicate_rows(stored).agg(count).scalar().alias("duplicates"))
