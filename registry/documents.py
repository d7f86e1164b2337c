"""Documents to rows: names, required properties, schema validation, descriptors."""

from pyspark.sql import functions as F

from registry import query
from registry import frames as R
from strandline.functions.messages import error_counts
from strandline.operators import documents as D
from strandline.plans.preprocess import typed_json
from strandline.schemas import ERRORS
from strandline.session import land, work_path
from strandline.sinks.writers import write_errors

NAMES, DESCRIPTORS = "doc_names", "doc_descriptors"


def metadata(s, d):
    return R.staged_documents(s, d).filter("kind = 'metadata'")


def descriptors(s, d):
    return R.staged_documents(s, d).filter("kind = 'descriptors'")


def reported(s, d):
    """All staged documents with their compact text and finding, landed as a table."""
    return land(D.with_report(R.staged_documents(s, d), R.json_schemas(s, d)), "documents", "kind", "entity_type")


query("p1_entity_names", R.with_ctes(NAMES, """
    SELECT file_name, CASE WHEN named THEN CAST(doc_id AS VARCHAR) END AS entity_id, CASE WHEN named THEN CAST(n_chars AS VARCHAR) END AS version
    FROM doc_names"""))(
    lambda s, d: D.with_entity_name(metadata(s, d)).select("file_name", "entity_id", "version"))


def _links_documents(s, d):
    end = F.when(F.col("o_orderstatus") == "P", "_1.json").otherwise(".json")
    name = F.concat(F.concat_ws("_", "o_orderkey", "o_orderpriority", "o_custkey"), end)
    return R.table(s, d, "orders").select(
        F.lit("a").alias("area"), F.lit("links").alias("kind"), F.lit("links").alias("entity_type"), name.alias("file_name"),
        F.concat(F.lit('{"links": [ ],  "status": "'), F.col("o_orderstatus"), F.lit('"}')).alias("value"))


query("p2_links_names", """
    SELECT CAST(o_orderkey AS VARCHAR) AS links_id, o_orderpriority AS version, CAST(o_custkey AS VARCHAR) AS project_id
    FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT NULL, NULL, NULL FROM orders WHERE o_orderstatus = 'P'""")(
    lambda s, d: D.with_links_name(_links_documents(s, d)).select(F.col("entity_id").alias("links_id"), "version", "project_id"))

SQL_TEXT = """'{' || CASE WHEN source <> 'src5' THEN '"describedBy":"https://schemas.example.org/' || source || '",' ELSE '' END
    || '"lang":"' || lang || '","n_chars":' || n_chars || ',"text":' || to_json(text) || '}'"""
SQL_DESCRIPTOR = """'{"describedBy":"https://schemas.example.org/descriptor",' || CASE WHEN has_name THEN '"file_name":"' || source || '",' ELSE '' END
    || '"file_id":"' || n_chars || '"' || CASE WHEN has_crc THEN ',"crc32c":"' || doc_id || '"' ELSE '' END
    || CASE WHEN source = 'src2' THEN ',"drs_uri":"drs://x"' ELSE '' END || '}'"""

query("p3_metadata_rows", R.with_ctes(NAMES, f"""
    SELECT CAST(doc_id AS VARCHAR) AS project_id, CAST(n_chars AS VARCHAR) AS version, {SQL_TEXT} AS content
    FROM doc_names WHERE named AND entity_type = 'project'"""))(
    lambda s, d: typed_json(D.reshape(reported(s, d))[0], "project"))

query("p4_file_rows", R.with_ctes(NAMES, DESCRIPTORS, f"""
    SELECT CAST(doc_id AS VARCHAR) AS sequence_file_id, CAST(n_chars AS VARCHAR) AS version, {SQL_TEXT} AS content,
           CAST(doc_id AS VARCHAR) AS crc32c, {SQL_DESCRIPTOR} AS descriptor
    FROM doc_descriptors WHERE named AND has_crc AND has_name AND entity_type = 'sequence_file'"""))(
    lambda s, d: typed_json(D.reshape(reported(s, d))[0], "sequence_file"))

query("p5_links_rows", """
    SELECT '{"links":[],"status":"' || o_orderstatus || '"}' AS content, CAST(o_orderkey AS VARCHAR) AS links_id,
           o_orderpriority AS version, CAST(o_custkey AS VARCHAR) AS project_id
    FROM orders WHERE o_orderstatus <> 'P'""")(
    lambda s, d: typed_json(D.links_rows(D.with_links_name(
        D.with_report(_links_documents(s, d), R.json_schemas(s, d)))), "links"))

MISSING = "'MissingPropertyError' AS \"errorType\""

query("p6_missing_described_by", R.with_ctes(NAMES, f"""
    SELECT {MISSING}, area || '/metadata/' || entity_type || '/' || file_name AS "filePath", file_name AS "fileName",
           'File has no describedBy property.' AS message
    FROM doc_names WHERE source = 'src5'"""))(
    lambda s, d: D.property_errors(D.with_missing_property(metadata(s, d), "describedBy")))

query("p7_incomplete_descriptors", R.with_ctes(NAMES, DESCRIPTORS, f"""
    SELECT {MISSING}, area || '/descriptors/' || entity_type || '/' || file_name AS "filePath", file_name AS "fileName",
           'File has no ' || CASE WHEN has_crc THEN 'file_name' ELSE 'crc32c' END || ' property.' AS message
    FROM doc_descriptors WHERE NOT (has_crc AND has_name)"""))(
    lambda s, d: D.complete_descriptors(descriptors(s, d))[1])

MISMATCHES = """
    SELECT 'FileMismatchError' AS "errorType", area || '/descriptors/' || entity_type || '/' || file_name AS "filePath", file_name AS "fileName",
           'File is present in metadata/' || entity_type || ' but not in descriptors/' || entity_type || '.' AS message
    FROM doc_names WHERE lang IN ('de', 'es') AND doc_id NOT IN (SELECT doc_id FROM doc_descriptors WHERE has_crc AND has_name)
    UNION ALL
    SELECT 'FileMismatchError', 'area-de/metadata/sequence_file/page' || page_id || '_1.json', 'page' || page_id || '_1.json',
           'File is present in descriptors/sequence_file but not in metadata/sequence_file.'
    FROM pages"""


@query("j1_metadata_without_descriptor", R.with_ctes(NAMES, DESCRIPTORS, MISMATCHES))
def mismatches(s, d):
    files = metadata(s, d).filter(F.col("entity_type").isin("sequence_file", "image_file")).withColumnRenamed("value", "content")
    complete = D.complete_descriptors(descriptors(s, d))[0].withColumnRenamed("value", "content")
    return D.match_descriptors(files, complete)[1]


FINDING = """CASE WHEN source = 'src5' THEN NULL
    WHEN source = 'src1' THEN 'No schema found at https://schemas.example.org/src1'
    WHEN source = 'src2' THEN 'Schema not loaded properly for schema at https://schemas.example.org/src2'
    WHEN lang = 'es' THEN 'Data in file does not conform to schema from https://schemas.example.org/' || source || '; #/lang: es is not a valid enum value'
    END"""
FINDINGS = R.with_ctes(NAMES, f"SELECT file_name, {FINDING} AS finding FROM doc_names")

query("v1_schema_validation", FINDINGS)(
    lambda s, d: D.with_report(metadata(s, d), R.json_schemas(s, d)).select("file_name", "finding"))

query("j2_documents_with_joined_schema", FINDINGS)(
    lambda s, d: D.with_report(metadata(s, d), R.json_schemas(s, d), registry_limit=0).select("file_name", "finding"))

query("v2_validation_keeps_documents", R.with_ctes(NAMES, f"""
    SELECT area, entity_type, file_name, md5({SQL_TEXT}) AS digest FROM doc_names"""))(
    lambda s, d: D.with_report(metadata(s, d), R.json_schemas(s, d)).select("area", "entity_type", "file_name", F.md5("content").alias("digest")))

query("a6_distinct_schema_urls", """
    SELECT DISTINCT 'https://schemas.example.org/' || source AS url FROM documents WHERE source <> 'src5'""")(
    lambda s, d: D.schema_urls(metadata(s, d)))

ALL_ERRORS = f"""
    {MISMATCHES}
    UNION ALL
    SELECT 'MissingPropertyError', area || '/metadata/' || entity_type || '/' || file_name, file_name, 'File has no describedBy property.'
    FROM doc_names WHERE source = 'src5'
    UNION ALL
    SELECT 'MissingPropertyError', area || '/descriptors/' || entity_type || '/' || file_name, file_name,
           'File has no ' || CASE WHEN has_crc THEN 'file_name' ELSE 'crc32c' END || ' property.'
    FROM doc_descriptors WHERE NOT (has_crc AND has_name)
    UNION ALL
    SELECT 'SchemaValidationError', area || '/metadata/' || entity_type || '/' || file_name, file_name, {FINDING}
    FROM doc_names WHERE {FINDING} IS NOT NULL
    UNION ALL
    SELECT 'SchemaValidationError', area || '/descriptors/' || entity_type || '/' || file_name, file_name, 'No schema found at https://schemas.example.org/descriptor'
    FROM doc_descriptors WHERE has_crc AND has_name
    UNION ALL
    SELECT 'SchemaValidationError', 'area-de/descriptors/sequence_file/page' || page_id || '_1.json', 'page' || page_id || '_1.json',
           'No schema found at https://schemas.example.org/descriptor' FROM pages
    UNION ALL
    SELECT 'NoRegexPatternMatchError', area || '/metadata/' || entity_type || '/' || file_name, file_name,
           'Error when finding entity id and version from file name.'
    FROM doc_names WHERE NOT named AND (lang IN ('en', 'fr') OR doc_id IN (SELECT doc_id FROM doc_descriptors WHERE has_crc AND has_name))"""


@query("k7_error_log", R.with_ctes(NAMES, DESCRIPTORS, ALL_ERRORS))
def error_log(s, d):
    path = work_path(s, "errors")
    write_errors(D.reshape(reported(s, d))[2], path)
    return s.read.schema(ERRORS).json(path)


query("a8_error_counts", R.with_ctes(NAMES, DESCRIPTORS, f"""
    SELECT "errorType", count(*) AS n_errors FROM ({ALL_ERRORS}) GROUP BY ALL"""))(
    lambda s, d: error_counts(D.reshape(reported(s, d))[2]))


@query("v3_fail_on_errors", R.with_ctes(NAMES, DESCRIPTORS, f"""
    SELECT count(*) AS n_errors, count(*) > 0 AS fails FROM ({ALL_ERRORS})"""))
def fail_on_errors(s, d):
    from strandline.plans.preprocess import DocumentErrors, require_no_errors

    found = land(D.reshape(reported(s, d))[2], "errors")
    try:
        require_no_errors(found)
        fails = False
    except DocumentErrors:
        fails = True
    return found.agg(F.count(F.lit(1)).alias("n_errors")).withColumn("fails", F.lit(fails))
