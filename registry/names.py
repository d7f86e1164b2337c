"""Scalar functions on whole columns."""

from pyspark.sql import functions as F

from registry import query
from registry import frames as R
from strandline.operators import files
from strandline.functions import jsons, names, versions

query("f1_compact_json", """
    SELECT doc_id, '{"doc_id":' || doc_id || ',"b":[true,null,1,2],"text":' || to_json(text) || ',"a":{"lang":"' || lang || '"}}' AS content FROM documents""")(
    lambda s, d: R.table(s, d, "documents").select("doc_id", jsons.compact(F.concat(
        F.lit('{\n  "doc_id" : '), R.text("doc_id"), F.lit(',\n  "b" : [ true, null, 1 , 2 ],\t"text": '),
        F.get(F.split(F.to_json(F.struct("text")), '^\\{"text":', 2), F.lit(1)).substr(F.lit(1), F.length(F.to_json(F.struct("text"))) - 9),
        F.lit(' ,  "a" : { "lang" : "'), F.col("lang"), F.lit('" } }'))).alias("content")))


def _nested(s, d):
    return R.table(s, d, "events").select("event_id", F.concat(
        F.lit('{"x":'), F.col("props"), F.lit(',"n":'), R.text("user_id"), F.lit(',"s":"[{'), F.col("event_type"), F.lit('","list":[1],"none":null,"yes":true}')).alias("doc"))


@query("f2_json_scalars", """
    SELECT event_id, NULL AS x, CAST(user_id AS VARCHAR) AS n, '[{' || event_type AS s, NULL AS list, NULL AS none, 'true' AS yes, NULL AS absent,
           json_extract_string(props, '$.k') AS k FROM events""")
def json_scalars(s, d):
    doc = F.col("doc")
    paths = {n: f"$.{n}" for n in ("x", "n", "s", "list", "none", "yes", "absent")} | {"k": "$.x.k"}
    return _nested(s, d).select("event_id", *[jsons.scalar(doc, path).alias(n) for n, path in paths.items()])


query("f3_string_concat", "SELECT '/v1/' || o_orderkey || '/' || o_custkey || '/' || o_orderpriority AS target_path FROM orders")(
    lambda s, d: R.table(s, d, "orders").select(files.target_path(R.text("o_orderkey"), R.text("o_custkey"), F.col("o_orderpriority")).alias("target_path")))

query("f4_not_like", "SELECT doc_id FROM documents WHERE text NOT LIKE '%the%'")(
    lambda s, d: R.table(s, d, "documents").filter(~F.col("text").like("%the%")).select("doc_id"))


@query("f5_parse_versions", """
    SELECT event_id, CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')
        WHEN 'purchase' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '000Z' WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000000Z' END AS version
    FROM events""")
def parse_versions(s, d):
    ts, kind = F.col("ts"), F.col("event_type")
    text = (
        F.when(kind == "click", R.version_text(ts)).when(kind == "purchase", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(kind == "view", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == "error", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS")).otherwise(F.date_format(ts, "yyyy-MM-dd"))
    )
    return R.table(s, d, "events").select("event_id", versions.format_version(versions.parse_version(text)).alias("version"))


query("f6_date_stamps", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS stamp FROM orders")(
    lambda s, d: R.table(s, d, "orders").select("o_orderkey", versions.date_stamp(F.col("o_orderdate")).alias("stamp")))

query("f7_base_names", "SELECT page_id, regexp_extract(url, '[^/]*$') AS name FROM pages")(
    lambda s, d: R.table(s, d, "pages").select("page_id", names.base_name(F.col("url")).alias("name")))

SQL_UUID = "substr(md5({0}), 1, 8) || '-' || substr(md5({0}), 9, 4) || '-4' || substr(md5({0}), 14, 3) || '-8' || substr(md5({0}), 18, 3) || '-' || substr(md5({0}), 21, 12)"


def uuid_of(column):
    digest = F.md5(column)
    part = lambda start, n: F.substring(digest, start, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-4"), part(14, 3), F.lit("-8"), part(18, 3), F.lit("-"), part(21, 12))


query("f8_without_dashes", f"SELECT c_custkey, replace({SQL_UUID.format('c_name')}, '-', '') AS compact_id FROM customer")(
    lambda s, d: R.table(s, d, "customer").select("c_custkey", names.without_dashes(uuid_of(F.col("c_name"))).alias("compact_id")))


@query("f9_json_equality", "SELECT event_id, value <= 50 AS same FROM events")
def json_equality(s, d):
    k = R.text("user_id")
    left = F.concat(F.lit('{"user":'), k, F.lit('.0,"event":"'), F.col("event_type"), F.lit('","p":'), F.col("props"), F.lit("}"))
    kind = F.when(F.col("value") <= 50, F.col("event_type")).otherwise("other")
    right = F.concat(F.lit('{ "p": '), F.col("props"), F.lit(', "event":"'), kind, F.lit('", "user": '), k, F.lit(" }"))
    return R.table(s, d, "events").select("event_id", jsons.same_json(left, right).alias("same"))


query("f10_case_and_trim", "SELECT c_custkey, upper(c_name) AS upper_name, lower(c_mktsegment) AS lower_segment, c_name AS trimmed FROM customer")(
    lambda s, d: R.table(s, d, "customer").select(
        "c_custkey", F.upper("c_name").alias("upper_name"), F.lower("c_mktsegment").alias("lower_segment"),
        F.trim(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("trimmed")))

query("f11_leading_date", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")(
    lambda s, d: R.table(s, d, "events").select("event_id", versions.leading_date(R.version_text(F.col("ts"))).alias("day")))


@query("p15_project_ids_in_paths", f"""
    SELECT c_custkey, CASE WHEN c_acctbal BETWEEN 0 AND 5000 THEN {SQL_UUID.format('c_name')} END AS project_id FROM customer""")
def project_ids(s, d):
    one = uuid_of(F.col("c_name"))
    path = (
        F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("gs://x/"), one, F.lit("/"), uuid_of(F.col("c_mktsegment"))))
        .when(F.col("c_acctbal") < 0, F.lit("gs://x/none")).otherwise(F.concat(F.lit("gs://x/"), one, F.lit("//end")))
    )
    return R.table(s, d, "customer").select("c_custkey", names.project_id_in(path).alias("project_id"))


@query("p17_clean_paths", "SELECT page_id, 'gs://' || regexp_replace(url, '/+$', '') AS path FROM pages WHERE starts_with(url, 'https')")
def clean_paths(s, d):
    scheme = F.when(F.col("url").startswith("https"), "gs://").otherwise("s3://")
    path = names.clean_path(F.concat(F.lit(" /"), scheme, F.col("url"), F.lit("// ")))
    return R.table(s, d, "pages").select("page_id", path.alias("path")).filter(names.is_bucket_path(F.col("path")))


@query("d9_dataset_and_snapshot_names", f"""
    WITH p AS (SELECT o_orderkey, replace({SQL_UUID.format('CAST(o_custkey AS VARCHAR)')}, '-', '') AS id, strftime(o_orderdate, '%Y%m%d') AS day,
                      CASE WHEN o_orderstatus = 'F' THEN '' ELSE '_q' || lower(o_orderstatus) END AS q FROM orders)
    SELECT o_orderkey, 'atlas_prod_' || id || '__' || day || q AS dataset, 'atlas_prod_' || id || '__' || day || q || '___' || day || q AS full_view,
           'atlas_prod_' || id || '__' || day || q || '_' || day || '_r1' AS snapshot FROM p""")
def dataset_names(s, d):
    atlas, env, tag = F.lit("atlas"), F.lit("prod"), F.lit("r1")
    qualifier = F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("q"), F.lower("o_orderstatus")))
    project, moment = uuid_of(R.text("o_custkey")), F.col("o_orderdate")
    named = R.table(s, d, "orders").withColumn("dataset", names.dataset_name(atlas, env, project, moment, qualifier))
    return named.select(
        "o_orderkey", "dataset", names.full_view_name(F.col("dataset"), moment, qualifier).alias("full_view"),
        names.project_snapshot_name(atlas, env, project, F.col("dataset"), moment, qualifier, tag).alias("snapshot"))
