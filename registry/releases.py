"""Release manifests and release verification."""

from datetime import datetime

from pyspark.sql import functions as F

from registry import query
from registry import frames as R
from registry.names import SQL_UUID, uuid_of
from strandline.operators import release
from strandline.session import land, work_path
from strandline.sinks.writers import write_manifests

CUTOFF = datetime(2024, 1, 20)


def _staged(s, d):
    """Staged entities: the event type is the area, user and props the entity."""
    return R.table(s, d, "events").select(
        F.col("event_type").alias("area"), F.lit("project").alias("entity_type"),
        F.concat_ws("/", R.text("user_id"), F.col("props")).alias("entity_id"), R.version_text(F.col("ts")).alias("version"),
        F.concat(F.lit('{"b": 1, "kind":"'), F.col("event_type"), F.lit('"}')).alias("content"))


def _stored(s, d):
    """Stored entities: those of the views, clicks and purchases."""
    content = F.concat(F.lit('{"kind": "'), F.when(F.col("event_type") == "purchase", "view").otherwise(F.col("event_type")), F.lit('","b":1.0}'))
    return R.table(s, d, "events").filter(F.col("event_type").isin("view", "click", "purchase")).select(
        F.lit("project").alias("entity_type"), F.concat_ws("/", R.text("user_id"), F.col("props")).alias("entity_id"),
        F.col("ts").cast("timestamp").alias("version"), content.alias("content"))


SQL_STAGED = f"""staged AS (
    SELECT event_type AS area, user_id || '/' || props AS entity_id, max(ts) AS ts, arg_max(event_type, ts) AS kind
    FROM events WHERE ts <= TIMESTAMP '2024-01-20' GROUP BY ALL)"""
SQL_COMPARED = SQL_STAGED + """, stored AS (
    SELECT user_id || '/' || props AS entity_id, max(ts) AS ts,
           arg_max(CASE event_type WHEN 'purchase' THEN 'view' ELSE event_type END, ts) AS kind
    FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY ALL),
compared AS (
    SELECT s.area, s.entity_id, s.ts AS staged_ts,
           CASE WHEN t.ts IS NULL THEN 'missing' WHEN s.ts < t.ts THEN 'superseded'
                WHEN s.ts <> t.ts AND s.kind <> t.kind THEN 'both_differ' WHEN s.ts <> t.ts THEN 'version_differs'
                WHEN s.kind <> t.kind THEN 'content_differs' ELSE 'ok' END AS status
    FROM staged s LEFT JOIN stored t ON s.entity_id = t.entity_id)"""

query("p14_release_cutoff", f"""
    SELECT event_type AS area, user_id || '/' || props AS entity_id, {R.SQL_VERSION.format('ts')} AS version
    FROM events WHERE ts <= TIMESTAMP '2024-01-20'""")(
    lambda s, d: release.before_cutoff(_staged(s, d), F.lit(CUTOFF)).select("area", "entity_id", "version"))

query("a11_latest_staged", f"""
    SELECT event_type AS area, user_id || '/' || props AS entity_id, max({R.SQL_VERSION.format('ts')}) AS version FROM events GROUP BY ALL""")(
    lambda s, d: release.latest_staged(_staged(s, d)).select("area", "entity_id", "version"))


def _compared(s, d):
    staged = release.latest_staged(release.before_cutoff(_staged(s, d), F.lit(CUTOFF)))
    return release.compare_entities(staged, release.latest_stored(_stored(s, d)))


query("j12_staged_against_stored", f"WITH {SQL_COMPARED} SELECT area, entity_id, {R.SQL_VERSION.format('staged_ts')} AS version, status FROM compared")(
    lambda s, d: _compared(s, d).select("area", "entity_id", "version", "status"))


def _expected(s, d):
    descriptors = R.table(s, d, "lineitem").join(R.table(s, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_returnflag").alias("area"), R.order_descriptor().alias("descriptor"))
    return release.expected_files(descriptors)


SQL_EXPECTED = """expected AS (
    SELECT DISTINCT l_returnflag AS area, '/v1/' || o_orderkey || '/' || o_custkey || '/' || o_orderpriority AS target_path,
           CAST(o_custkey AS VARCHAR) AS checksum FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

query("j11_missing_files", f"""
    WITH history AS ({R.CTES['history']}), {SQL_EXPECTED}
    SELECT area, target_path, checksum FROM expected
    WHERE (target_path, checksum) NOT IN (SELECT target_path, checksum_crc32c FROM history WHERE state = 'succeeded')""")(
    lambda s, d: release.missing_files(_expected(s, d), R.history(s, d)))

SQL_FILES = f"""history AS ({R.CTES['history']}), {SQL_EXPECTED}, files AS (
    SELECT area, count(*) AS staged, count(h.target_path) AS loaded,
           count(*) FILTER (WHERE h.checksum_crc32c IS DISTINCT FROM e.checksum) AS missing
    FROM expected e LEFT JOIN history h ON h.target_path = e.target_path AND h.state = 'succeeded' GROUP BY area)"""

query("j11_file_report", f"WITH {SQL_FILES} SELECT area, staged, loaded, missing FROM files")(
    lambda s, d: release.file_report(_expected(s, d), R.history(s, d)))


@query("v9_release_verification", f"""
    WITH {SQL_FILES}, {SQL_COMPARED},
    entities AS (SELECT area, count(*) AS n, count(*) FILTER (WHERE status NOT IN ('ok', 'superseded')) AS bad FROM compared GROUP BY area),
    areas AS (SELECT DISTINCT event_type AS area FROM events UNION SELECT DISTINCT l_returnflag FROM lineitem UNION SELECT DISTINCT c_mktsegment FROM customer)
    SELECT area, coalesce(staged, 0) AS staged, coalesce(loaded, 0) AS loaded, coalesce(missing, 0) AS missing, coalesce(n, 0) AS entities,
           coalesce(bad, 0) AS entity_errors, coalesce(missing, 0) > 0 AS has_file_errors, coalesce(bad, 0) > 0 AS has_metadata_errors,
           coalesce(missing, 0) > 0 OR coalesce(bad, 0) > 0 AS has_errors
    FROM areas LEFT JOIN files USING (area) LEFT JOIN entities USING (area)""")
def release_verification(s, d):
    areas = (
        R.table(s, d, "events").select(F.col("event_type").alias("area"))
        .unionByName(R.table(s, d, "lineitem").select(F.col("l_returnflag").alias("area")))
        .unionByName(R.table(s, d, "customer").select(F.col("c_mktsegment").alias("area"))).distinct()
    )
    files = release.file_report(_expected(s, d), R.history(s, d))
    return release.verify_areas(areas, files, release.entity_report(_compared(s, d)))


def _intake(s, d):
    """An intake line per order: the customer's project, its segment as institution in mixed case."""
    joined = R.table(s, d, "orders").join(R.table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("institution"),
        F.concat(F.lit(" "), uuid_of(F.col("c_name")), F.lit(" ")).alias("project_id"),
        F.when(F.col("o_orderstatus") == "P", " NO ").otherwise("Yes").alias("managed_access"))


def _roots(s, d):
    segment = F.col("c_mktsegment")
    return R.table(s, d, "customer").select(segment.alias("institution"), F.concat(F.lit("gs://bucket-"), F.lower(segment), F.lit("/prod")).alias("root")).distinct()


SQL_ENTRIES = f"""entries AS (
    SELECT 'gs://bucket-' || lower(c_mktsegment) || '/prod/' || {SQL_UUID.format('c_name')} AS entry, bool_or(o_orderstatus = 'P') AS public
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)"""

query("u4_area_set", f"WITH {SQL_ENTRIES} SELECT entry, public FROM entries")(
    lambda s, d: release.intake_areas(_intake(s, d), _roots(s, d)))

query("u4_project_ids_with_tag", f"""
    SELECT {SQL_UUID.format('c_name')} || ',r9' AS entry, bool_or(o_orderstatus = 'P') AS public FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")(
    lambda s, d: release.intake_areas(_intake(s, d), _roots(s, d), release_tag="r9", ids_only=True))


@query("k9_manifests", f"""
    WITH {SQL_ENTRIES} SELECT entry, 'r9_' || chr(CAST(97 + (row_number() OVER (ORDER BY entry) - 1) // 20 AS INTEGER)) || '_manifest' AS manifest
    FROM entries WHERE public""")
def manifests(s, d):
    entries = land(release.intake_areas(_intake(s, d), _roots(s, d)), "entries")
    path = work_path(s, "manifests")
    write_manifests(release.manifests(entries, "r9", public_only=True), path)
    return s.read.schema("value string, manifest string").text(path).select(F.col("value").alias("entry"), "manifest")
