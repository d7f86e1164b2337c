"""Load requests, file ids, file checks, and round trips through the file formats."""

from pyspark.sql import functions as F

from registry import query
from registry import frames as R
from strandline import schemas as S
from strandline.operators import files, latest
from strandline.operators import rows as rows_ops
from strandline.session import land, work_path
from strandline.sinks import writers
from strandline.sources import manifests, staging, tables


def _requests(s, d):
    return R.table(s, d, "orders").select(
        F.concat(F.lit("gs://a/data/"), F.col("o_orderpriority")).alias("source_path"), R.order_path().alias("target_path"))


query("j5_files_to_load", R.with_ctes("history", """
    SELECT 'gs://a/data/' || o_orderpriority AS sourcePath, '/v1/' || o_orderkey || '/' || o_custkey || '/' || o_orderpriority AS targetPath
    FROM orders
    WHERE '/v1/' || o_orderkey || '/' || o_custkey || '/' || o_orderpriority NOT IN (SELECT target_path FROM history WHERE state = 'succeeded')"""))(
    lambda s, d: files.files_to_load(_requests(s, d), R.history(s, d)))

IDS_SQL = f"""
    SELECT {R.SQL_ITEM_ID} AS entity_id, CASE WHEN o_orderstatus = 'F' THEN 'f' || o_orderkey END AS file_id
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

query("j6_inject_file_ids", IDS_SQL)(
    lambda s, d: files.with_file_ids(R.file_rows(s, d), R.history(s, d)).select("entity_id", "file_id"))


@query("j7_resolve_stored_file_ids", IDS_SQL)
def resolve_stored(s, d):
    stored = R.file_rows(s, d).withColumn("file_id", F.lit("old"))
    return files.with_file_ids(stored, R.history(s, d)).select("entity_id", "file_id")


query("j6_repeated_loads", """
    SELECT '/v1/' || o_custkey AS target_path, o_orderpriority AS checksum_crc32c, count(*) AS n_loads
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL HAVING count(*) > 1""")(
    lambda s, d: files.repeated_loads(R.table(s, d, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("succeeded").alias("state"),
        F.concat(F.lit("/v1/"), R.text("o_custkey")).alias("target_path"), F.col("o_orderpriority").alias("checksum_crc32c"))))


@query("j15_file_rows_with_load", """
    SELECT CAST(o_custkey AS VARCHAR) AS file_id, CAST(count(*) AS BIGINT) AS n_joined
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def file_rows_with_load(s, d):
    rows = R.table(s, d, "customer").select(R.text("c_custkey").alias("file_id"), F.col("c_name").alias("entity_id"))
    loads = R.table(s, d, "orders").select(R.text("o_custkey").alias("file_id"))
    joined = files.rows_with_load(rows, loads)
    return joined.groupBy("file_id").agg(F.sum("n_loads").alias("n_joined"))


query("p11_rows_without_file", R.with_ctes("document_files", """
    SELECT entity_id FROM document_files WHERE (file_id IS NULL OR file_id = '') AND lang = 'en'"""))(
    lambda s, d: files.rows_without_file(R.document_files(s, d)).select("entity_id"))

query("p12_null_file_refs", R.with_ctes("document_files", """
    SELECT entity_id FROM document_files WHERE file_id IS NULL AND lang <> 'fr'"""))(
    lambda s, d: files.null_file_refs(R.document_files(s, d)).select("entity_id"))

query("p8_not_hosted_elsewhere", R.with_ctes("document_files", """
    SELECT entity_id FROM document_files WHERE lang NOT IN ('fr', 'de')"""))(
    lambda s, d: R.document_files(s, d).filter(~files.hosted_elsewhere(F.col("descriptor"))).select("entity_id"))


def _descriptors(s, d):
    items = R.table(s, d, "lineitem").join(R.table(s, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    body = F.to_json(F.struct(F.concat_ws("/", "l_returnflag", R.text("l_partkey")).alias("file_name"),
                              R.text("o_orderkey").alias("file_id"), R.text("o_custkey").alias("crc32c"),
                              F.when(F.col("o_orderstatus") == "P", "drs://x").alias("drs_uri")))
    return items.select(F.col("o_orderpriority").alias("area"), F.lit("image_file").alias("entity_type"), body.alias("descriptor"))


REQUEST_SQL = """
    WITH r AS (SELECT o_orderpriority AS area, CAST(o_orderkey AS VARCHAR) AS file_id, l_returnflag || '/' || l_partkey AS file_name, o_custkey
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'),
    p AS (SELECT area, file_id, area || '/data/' || file_name AS source_path, '/v1/' || file_id || '/' || o_custkey || '/' || file_name AS target_path FROM r)"""

query("a7_one_request_per_file", REQUEST_SQL + """
    SELECT area, file_id, source_path, target_path FROM p
    QUALIFY row_number() OVER (PARTITION BY area, file_id ORDER BY target_path, source_path) = 1""")(
    lambda s, d: files.load_requests(_descriptors(s, d)).drop("entity_type"))

query("p9_load_request_paths", """
    SELECT o_orderpriority || '/data/' || l_returnflag || '/' || l_partkey AS source_path,
           '/v1/' || o_orderkey || '/' || o_custkey || '/' || l_returnflag || '/' || l_partkey AS target_path
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")(
    lambda s, d: files.with_file_fields(_descriptors(s, d)).select(
        files.source_path(F.col("area"), F.col("file.file_name")).alias("source_path"), "file.target_path"))

query("k2_write_load_requests", REQUEST_SQL + """
    SELECT source_path, target_path FROM p
    QUALIFY row_number() OVER (PARTITION BY area, file_id ORDER BY target_path, source_path) = 1""")(
    lambda s, d: _round_trip_requests(s, d))


def _round_trip_requests(s, d):
    path = work_path(s, "requests")
    writers.write_json_rows(files.load_requests(_descriptors(s, d)).select("source_path", "target_path"), path)
    return tables.read_json_rows(s, path, S.LOAD_REQUESTS)


# --- tables through files --------------------------------------------------------------------------

ENTITY_SQL = f"""
    SELECT CAST(event_id AS VARCHAR) AS project_id, {R.SQL_VERSION.format('ts')} AS version, props AS content FROM events"""


def _project_rows(s, d):
    return R.table(s, d, "events").select(
        R.text("event_id").alias("project_id"), F.col("ts").cast("timestamp").alias("version"), F.col("props").alias("content"))


def _texted(frame):
    return frame.withColumn("version", R.version_text(F.col("version")))


@query("k1_write_json_rows", ENTITY_SQL)
def write_json_rows(s, d):
    path = work_path(s, "project")
    writers.write_json_rows(_project_rows(s, d), path)
    return s.read.schema("project_id string, version string, content string").json(path)


@query("s4_json_scan_with_schema", ENTITY_SQL)
def json_scan(s, d):
    path = work_path(s, "project")
    writers.write_json_rows(_project_rows(s, d), path)
    return _texted(tables.read_json_rows(s, path, S.table_schema("project")))


@query("s5_scan_of_a_type", f"""
    SELECT {R.SQL_ITEM_ID} AS sequence_file_id, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS version, l_returnflag AS content,
           CAST(l_partkey AS VARCHAR) AS crc32c, l_linestatus AS descriptor FROM lineitem""")
def scan_of_a_type(s, d):
    path = work_path(s, "sequence-file")
    rows = R.table(s, d, "lineitem").select(
        R.item_id().alias("sequence_file_id"), F.col("l_shipdate").alias("version"), F.col("l_returnflag").alias("content"),
        R.text("l_partkey").alias("crc32c"), F.col("l_linestatus").alias("descriptor"))
    writers.write_json_rows(rows, path)
    return _texted(tables.read_staged(s, path, "sequence_file"))


@query("s6_live_rows", "SELECT event_type AS entity_type, CAST(event_id AS VARCHAR) AS row_id, props AS content FROM events WHERE value >= 5")
def live(s, d):
    raw = R.entities(s, d).select("entity_type", "row_id", "content")
    removed = R.table(s, d, "events").filter("value < 5").select(F.col("event_type").alias("entity_type"), R.text("event_id").alias("row_id"))
    return rows_ops.live_rows(raw, removed)


@query("k3_replace_table", "SELECT o_orderkey AS id, o_orderstatus AS content FROM orders WHERE o_totalprice > 1000")
def replace_table(s, d):
    orders = R.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("content"), "o_totalprice")
    path = work_path(s, "scratch")
    writers.replace_table(orders.drop("o_totalprice"), path)
    return writers.replace_table(orders.filter("o_totalprice > 1000").drop("o_totalprice"), path)


@query("k4_export_json", "SELECT o_orderkey AS id, o_orderstatus AS content, (SELECT count(*) FROM orders) AS n_exported FROM orders")
def export_json(s, d):
    orders = R.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("content"))
    path = work_path(s, "export")
    n_rows = writers.export_json(land(orders, "export-values"), path)
    return s.read.schema(orders.schema).json(path).withColumn("n_exported", F.lit(n_rows).cast("bigint"))


@query("k5_outdated_ids_csv", R.with_ctes("entities", """
    SELECT row_id FROM entities QUALIFY version < max(version) OVER (PARTITION BY entity_type, entity_id)"""))
def outdated_ids_csv(s, d):
    path = work_path(s, "outdated-ids")
    writers.write_ids(latest.outdated_rows(R.entities(s, d)), "row_id", path)
    return s.read.schema("row_id string").csv(path)


@query("k6_row_id_control_files", R.with_ctes("entities", """
    SELECT entity_type, row_id FROM entities
    QUALIFY row_number() OVER (PARTITION BY entity_type, entity_id ORDER BY version DESC, row_id DESC) > 1"""))
def control_files(s, d):
    path = work_path(s, "row-ids")
    writers.write_row_id_files(latest.duplicate_rows(R.entities(s, d)), path)
    return s.read.schema("row_id string, entity_type string").csv(path).select("entity_type", "row_id")


@query("k10_append_rows", f"""
    SELECT event_type AS entity_type, CAST(event_id AS VARCHAR) AS entity_id, {R.SQL_VERSION.format('ts')} AS version, props AS content,
           strftime(ts, '%Y%m%d') AS version_day FROM events""")
def append_rows(s, d):
    path = work_path(s, "rows")
    rows = R.table(s, d, "events").select(
        F.col("event_type").alias("entity_type"), R.text("event_id").alias("entity_id"), F.col("ts").cast("timestamp").alias("version"),
        F.col("props").alias("content"), F.col("value"))
    writers.append_rows(rows.filter("value < 20").drop("value"), path)
    writers.append_rows(rows.filter("value >= 20").drop("value"), path)
    stored = tables.read_table(s, path, S.ROWS)
    return _texted(stored).select("entity_type", "entity_id", "version", "content", F.date_format("version_date", "yyyyMMdd").alias("version_day"))


# --- staging areas as folders ----------------------------------------------------------------------

_areas: dict[tuple[str, str], str] = {}


def staging_area(s, d):
    """A staging area with a metadata document and a descriptor per supplier, one file each, and an empty file."""
    key = (s.sparkContext.applicationId, d)
    if key not in _areas:
        root = f"{work_path(s, 'area')}/area-1"
        suppliers = R.table(s, d, "supplier")
        metadata = suppliers.select("s_suppkey", "s_name", F.lit("https://schemas.example.org/any").alias("describedBy"))
        descriptors = suppliers.select(F.col("s_name").alias("file_name"), R.text("s_suppkey").alias("file_id"), R.text("s_nationkey").alias("crc32c"))
        for frame, folder in ((metadata, "metadata/project"), (descriptors, "descriptors/sequence_file"), (metadata, "links")):
            writers.write_single_files(frame, f"{root}/{folder}", "entity_1")
        suppliers.filter("s_suppkey < 0").write.option("mapreduce.output.basename", "entity_1").json(f"{root}/metadata/cell_line")
        writers.write_single_files(suppliers.select("s_name"), f"{root}/data", "part", "text")
        _areas[key] = root
    return _areas[key]


@query("s1_match_files", """
    SELECT k.kind, k.entity_type, count(*) AS n_files
    FROM supplier, (VALUES ('metadata', 'project'), ('descriptors', 'sequence_file'), ('links', 'links')) k(kind, entity_type) GROUP BY ALL
    UNION ALL SELECT 'metadata', 'cell_line', 1""")
def match_files(s, d):
    found = staging.match_files(s, [staging_area(s, d), f"{staging_area(s, d)}-absent"])
    return found.groupBy("kind", "entity_type").agg(F.count(F.lit(1)).alias("n_files"))


@query("s2_no_match_warnings", """
    SELECT 'NoMatchWarning' AS warning, CAST(26 + 5 + 1 - 4 AS BIGINT) AS n_warnings, (SELECT count(*) FROM supplier) AS n_suppliers""")
def no_match(s, d):
    from strandline.operators.documents import no_match_warnings

    area = staging_area(s, d)
    found = staging.match_files(s, [area])
    warnings = no_match_warnings(found, s.createDataFrame([(area,)], "area string"))
    counted = warnings.groupBy(F.col("warningType").alias("warning")).agg(F.count(F.lit(1)).alias("n_warnings"))
    n = found.filter("entity_type = 'project'").agg(F.count(F.lit(1)).alias("n")).scalar()
    return counted.withColumn("n_suppliers", n)


@query("s3_read_documents", "SELECT 'project' AS entity_type, s_suppkey, s_name, true AS named FROM supplier")
def read_documents(s, d):
    found = staging.read_documents(s, [staging_area(s, d)], kinds=("metadata",), entity_types=("project",))
    body = F.from_json("value", "s_suppkey bigint, s_name string")
    return found.select("entity_type", body["s_suppkey"].alias("s_suppkey"), body["s_name"].alias("s_name"),
                        F.col("file_name").rlike(r"^entity_1.*\.json$").alias("named"))


@query("s7_has_any_data", "SELECT count(*) > 0 AS has_data, false AS has_data_if_empty FROM supplier")
def has_any_data(s, d):
    area = staging_area(s, d)
    found = [staging.has_any_data(s, f"{area}/metadata/{name}") for name in ("project", "cell_line")]
    return s.createDataFrame([tuple(found)], "has_data boolean, has_data_if_empty boolean")


@query("s8_skip_empty_files", "SELECT 'project' AS entity_type, count(*) AS n_files FROM supplier")
def skip_empty(s, d):
    found = staging.read_documents(s, [staging_area(s, d)], kinds=("metadata",), skip_empty=True)
    return found.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n_files"))


@query("s9_inventory", """
    SELECT t.top, 'entity' AS entity, count(*) + any_value(CASE WHEN t.top = 'metadata' THEN 1 ELSE 0 END) AS n_files
    FROM supplier, (VALUES ('metadata'), ('descriptors'), ('links')) t(top) GROUP BY ALL""")
def inventory(s, d):
    found, _ = staging.inventory(s, [staging_area(s, d)])
    return found.groupBy("top", "entity").agg(F.count(F.lit(1)).alias("n_files"))


@query("s12_descriptor_scan", """
    SELECT s_name AS file_name, CAST(s_suppkey AS VARCHAR) AS file_id, CAST(s_nationkey AS VARCHAR) AS crc32c FROM supplier""")
def descriptor_scan(s, d):
    found = staging.read_descriptors(s, [staging_area(s, d)], S.FILE_TYPES)
    body = F.from_json("descriptor", "file_name string, file_id string, crc32c string")
    return found.select(body["file_name"].alias("file_name"), body["file_id"].alias("file_id"), body["crc32c"].alias("crc32c"))


@query("v4_structural_check", """
    SELECT a.area, t.top FROM (VALUES ('area-1'), ('area-1-absent')) a(area), (VALUES ('data'), ('descriptors'), ('links'), ('metadata')) t(top)
    WHERE a.area <> 'area-1' OR (SELECT count(*) FROM supplier) = 0""")
def structural_check(s, d):
    from strandline.operators.checks import missing_directories

    area = staging_area(s, d)
    asked = s.createDataFrame([(area,), (f"{area}-absent",)], "area string")
    missing = missing_directories(staging.top_level(s, [area, f"{area}-absent"]), asked)
    return missing.select(F.regexp_extract("area", "[^/]*$", 0).alias("area"), "top")


@query("s10_release_manifest", "SELECT regexp_replace(url, '/+$', '') AS area FROM pages")
def release_manifest(s, d):
    path = work_path(s, "manifest")
    R.table(s, d, "pages").select(F.concat(F.lit("  "), "url", F.lit("//")).alias("value")).write.text(path)
    return manifests.read_release_manifest(s, path)


@query("s11_intake_csv", """
    SELECT c_mktsegment AS institution, 'x/' || c_name AS project_id, CASE WHEN c_acctbal > 0 THEN 'Yes' ELSE 'No' END AS managed_access FROM customer""")
def intake_csv(s, d):
    path = work_path(s, "intake")
    answer = F.when(F.col("c_acctbal") > 0, "Yes").otherwise("No")
    lines = F.concat_ws(",", "c_mktsegment", F.concat(F.lit("x/"), F.col("c_name")), answer)
    # each line is followed by a blank one
    R.table(s, d, "customer").select(F.concat(lines, F.lit("\n")).alias("value")).write.text(path)
    return manifests.read_intake(s, path)
