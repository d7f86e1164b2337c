"""The roles the given tables play, as DataFrames and as SQL.

Frames read their tables whole; `existing` plays a store that holds two of the event types. The SQL text of a role is a common table expression of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def text(name: str) -> Column:
    return F.col(name).cast("string")


def version_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


SQL_VERSION = "strftime({}, '%Y-%m-%dT%H:%M:%S.%fZ')"


def with_ctes(*names_then_body: str) -> str:
    *names, body = names_then_body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + body


# Stored rows: the event type is the table, the user the id, the day the version, so versions tie often.
def entities(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("event_type").alias("entity_type"), text("user_id").alias("entity_id"), F.col("ts").cast("date").alias("version"),
        text("event_id").alias("row_id"), F.when(F.col("value") > 20, F.concat(F.lit("f"), text("event_id"))).alias("file_id"),
        F.col("props").alias("content"),
    )


# The same rows with the full timestamp as version text.
def timed_entities(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("event_type").alias("entity_type"), text("user_id").alias("entity_id"), version_text(F.col("ts")).alias("version"),
        text("event_id").alias("row_id"), F.col("props").alias("content"),
    )


# Staged rows: id and hour, several rows per key; some ids are null.
def staged(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.when(F.col("value") < 90, text("user_id")).alias("entity_id"),
        F.date_format("ts", "yyyy-MM-dd HH").alias("version"), text("event_id").alias("source_row"), F.col("props").alias("content"),
    )


# Stored keys to compare with: those of two of the event types.
def existing(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").filter(F.col("event_type").isin("purchase", "signup")).select(
        text("user_id").alias("entity_id"), F.date_format("ts", "yyyy-MM-dd HH").alias("version"), text("event_id").alias("row_id"),
    )


# File load history: one load per order.
def history(spark: SparkSession, d: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, d, "orders").select(
        F.when(status == "P", "failed").otherwise("succeeded").alias("state"), order_path().alias("target_path"),
        F.when(status == "O", "stale").otherwise(text("o_custkey")).alias("checksum_crc32c"),
        F.concat(F.lit("f"), text("o_orderkey")).alias("file_id"),
    )


def order_path() -> Column:
    return F.concat(F.lit("/v1/"), text("o_orderkey"), F.lit("/"), text("o_custkey"), F.lit("/"), F.col("o_orderpriority"))


def order_descriptor() -> Column:
    return F.to_json(F.struct(
        F.col("o_orderpriority").alias("file_name"), text("o_orderkey").alias("file_id"), text("o_custkey").alias("crc32c"),
    ))


# File rows: each line item has the file of its order.
def file_rows(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return items.select(F.lit("sequence_file").alias("entity_type"), item_id().alias("entity_id"), order_descriptor().alias("descriptor"))


def item_id() -> Column:
    return F.concat_ws("-", text("l_orderkey"), text("l_partkey"), text("l_suppkey"), text("l_linenumber"))


SQL_ITEM_ID = "l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber"


# File rows that may lack a file: labelled documents have one; some descriptors point elsewhere.
def document_files(spark: SparkSession, d: str) -> DataFrame:
    documents, labels = table(spark, d, "documents"), table(spark, d, "labels")
    lang = F.col("lang")
    descriptor = (
        F.when(lang == "fr", F.concat(F.lit('{"drs_uri":"drs://'), text("doc_id"), F.lit('"}')))
        .when(lang == "de", F.concat(F.lit('{"drs_uri" : "drs://'), text("doc_id"), F.lit('"}')))
        .when(lang == "es", F.concat(F.lit('{"note":"see drs_uri","id":'), text("doc_id"), F.lit("}")))
        .otherwise(F.concat(F.lit('{"id":'), text("doc_id"), F.lit("}")))
    )
    file_id = F.when(F.col("toxic") == 1, "").otherwise(F.when(F.col("quality").isNotNull(), F.concat(F.lit("f"), text("doc_id"))))
    return documents.join(labels, "doc_id", "left").select(
        F.lit("image_file").alias("entity_type"), text("doc_id").alias("entity_id"), text("doc_id").alias("row_id"),
        file_id.alias("file_id"), descriptor.alias("descriptor"), "lang",
    )


# Documents of a staging area, derived from the texts: metadata for all, descriptors for labelled ones
# of the file types, and descriptors nothing belongs to from the pages.
def staged_documents(spark: SparkSession, d: str) -> DataFrame:
    source = F.col("source")
    end = F.when(source == "src7", "_x.json").when(source == "src3", "__.json").when(source == "src4", "").otherwise(".json")
    name = F.when(source == "src9", F.concat(text("doc_id"), end)).otherwise(F.concat(text("doc_id"), F.lit("_"), text("n_chars"), end))
    entity_type = (
        F.when(F.col("lang") == "en", "project").when(F.col("lang") == "de", "sequence_file")
        .when(F.col("lang") == "fr", "cell_line").otherwise("image_file")
    )
    url = F.when(source != "src5", F.concat(F.lit("https://schemas.example.org/"), source))
    documents = table(spark, d, "documents")
    metadata = documents.select(
        F.concat(F.lit("area-"), F.col("lang")).alias("area"), F.lit("metadata").alias("kind"), entity_type.alias("entity_type"),
        name.alias("file_name"),
        F.to_json(F.struct(url.alias("describedBy"), "lang", "n_chars", "text")).alias("value"),
    )
    has_crc, has_name = source != "src10", ~source.isin("src11", "src10")
    described = documents.join(table(spark, d, "labels"), "doc_id", "left_semi").filter(F.col("lang").isin("de", "es"))
    descriptors = described.select(
        F.concat(F.lit("area-"), F.col("lang")).alias("area"), F.lit("descriptors").alias("kind"), entity_type.alias("entity_type"),
        name.alias("file_name"),
        F.to_json(F.struct(
            F.lit("https://schemas.example.org/descriptor").alias("describedBy"),
            F.when(has_name, source).alias("file_name"), text("n_chars").alias("file_id"),
            F.when(has_crc, text("doc_id")).alias("crc32c"), F.when(source == "src2", "drs://x").alias("drs_uri"),
        )).alias("value"),
    )
    stray = table(spark, d, "pages").select(
        F.lit("area-de").alias("area"), F.lit("descriptors").alias("kind"), F.lit("sequence_file").alias("entity_type"),
        F.concat(F.lit("page"), text("page_id"), F.lit("_1.json")).alias("file_name"),
        F.to_json(F.struct(
            F.lit("https://schemas.example.org/descriptor").alias("describedBy"), F.col("url").alias("file_name"),
            text("page_id").alias("file_id"), F.lit("c").alias("crc32c"),
        )).alias("value"),
    )
    return metadata.unionByName(descriptors).unionByName(stray)


# JSON schemas: one per source but src1; the one of src2 is not JSON.
def json_schemas(spark: SparkSession, d: str) -> DataFrame:
    source = F.col("source")
    good = F.lit(
        '{"type":"object","required":["lang"],"properties":{"lang":{"type":"string","enum":["en","fr","de"]},'
        '"n_chars":{"type":"integer"}}}'
    )
    per_source = table(spark, d, "documents").select("source").distinct().filter(source != "src1")
    return per_source.select(
        F.concat(F.lit("https://schemas.example.org/"), source).alias("url"),
        F.when(source == "src2", "{not json").otherwise(good).alias("schema_text"),
    )


# Links: one links document per line item, of either kind by its status.
def links_rows(spark: SparkSession, d: str) -> DataFrame:
    pair = lambda kind, value, t, i: F.struct(F.lit(kind).alias(t), value.alias(i))
    processes = F.col("l_linestatus") == "F"

    def only(condition: Column, value: Column) -> Column:
        return F.when(condition, value)

    link = F.struct(
        F.when(processes, "process_link").otherwise("supplementary_file_link").alias("link_type"),
        only(processes, F.lit("process")).alias("process_type"), only(processes, text("l_orderkey")).alias("process_id"),
        only(processes, F.array(pair("cell_line", text("l_partkey"), "input_type", "input_id"))).alias("inputs"),
        only(processes, F.array(pair("analysis_file", item_id(), "output_type", "output_id"))).alias("outputs"),
        only(processes, F.array(pair("protocol", F.col("l_returnflag"), "protocol_type", "protocol_id"))).alias("protocols"),
        only(~processes, pair("project", text("l_suppkey"), "entity_type", "entity_id")).alias("entity"),
        only(~processes, F.array(pair("supplementary_file", text("l_partkey"), "file_type", "file_id"))).alias("files"),
    )
    content = F.to_json(F.struct(F.lit("links").alias("schema_type"), F.array(link).alias("links")))
    return table(spark, d, "lineitem").select(item_id().alias("links_id"), text("l_suppkey").alias("project_id"), content.alias("content"))


# Entities that have arrived: part of the parts, suppliers and orders, all links and output files.
def loaded_entities(spark: SparkSession, d: str) -> DataFrame:
    def kind(name: str, frame: DataFrame, value: Column) -> DataFrame:
        return frame.select(F.lit(name).alias("entity_type"), value.alias("entity_id"))

    part, items = table(spark, d, "part"), table(spark, d, "lineitem")
    return (
        kind("cell_line", part.filter("p_size <= 25"), text("p_partkey"))
        .unionByName(kind("supplementary_file", part.filter("p_size > 10"), text("p_partkey")))
        .unionByName(kind("project", table(spark, d, "supplier").filter("s_acctbal > 0"), text("s_suppkey")))
        .unionByName(kind("process", table(spark, d, "orders").filter("o_orderstatus <> 'P'"), text("o_orderkey")))
        .unionByName(kind("protocol", items.filter("l_returnflag <> 'R'"), F.col("l_returnflag")))
        .unionByName(kind("analysis_file", items, item_id()))
        .unionByName(kind("links", items, item_id()))
    )


CTES = {
    "entities": """
        SELECT event_type AS entity_type, CAST(user_id AS VARCHAR) AS entity_id, CAST(ts AS DATE) AS version,
               CAST(event_id AS VARCHAR) AS row_id, CASE WHEN value > 20 THEN 'f' || event_id END AS file_id, props AS content
        FROM events""",
    "timed_entities": f"""
        SELECT event_type AS entity_type, CAST(user_id AS VARCHAR) AS entity_id, {SQL_VERSION.format('ts')} AS version,
               CAST(event_id AS VARCHAR) AS row_id, props AS content
        FROM events""",
    "staged": """
        SELECT CASE WHEN value < 90 THEN CAST(user_id AS VARCHAR) END AS entity_id, strftime(ts, '%Y-%m-%d %H') AS version,
               CAST(event_id AS VARCHAR) AS source_row, props AS content
        FROM events""",
    "existing": """
        SELECT CAST(user_id AS VARCHAR) AS entity_id, strftime(ts, '%Y-%m-%d %H') AS version, CAST(event_id AS VARCHAR) AS row_id
        FROM events WHERE event_type IN ('purchase', 'signup')""",
    "history": """
        SELECT CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'succeeded' END AS state,
               '/v1/' || o_orderkey || '/' || o_custkey || '/' || o_orderpriority AS target_path,
               CASE WHEN o_orderstatus = 'O' THEN 'stale' ELSE CAST(o_custkey AS VARCHAR) END AS checksum_crc32c,
               'f' || o_orderkey AS file_id
        FROM orders""",
    "document_files": """
        SELECT CAST(d.doc_id AS VARCHAR) AS entity_id, lang,
               CASE WHEN toxic = 1 THEN '' WHEN quality IS NOT NULL THEN 'f' || d.doc_id END AS file_id
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "doc_names": """
        SELECT doc_id, source, lang, n_chars, text,
               CASE lang WHEN 'en' THEN 'project' WHEN 'de' THEN 'sequence_file' WHEN 'fr' THEN 'cell_line' ELSE 'image_file' END AS entity_type,
               'area-' || lang AS area,
               CASE WHEN source = 'src9' THEN CAST(doc_id AS VARCHAR) ELSE doc_id || '_' || n_chars END
               || CASE source WHEN 'src7' THEN '_x.json' WHEN 'src3' THEN '__.json' WHEN 'src4' THEN '' ELSE '.json' END AS file_name,
               source NOT IN ('src7', 'src9') AS named
        FROM documents""",
    "doc_descriptors": """
        SELECT n.*, source <> 'src10' AS has_crc, source NOT IN ('src10', 'src11') AS has_name
        FROM doc_names n WHERE lang IN ('de', 'es') AND doc_id IN (SELECT doc_id FROM labels)""",
    "link_nodes": f"""
        SELECT links_id, project_id, u.entity_type, u.entity_id FROM (
            SELECT {SQL_ITEM_ID} AS links_id, CAST(l_suppkey AS VARCHAR) AS project_id, * FROM lineitem) i,
        LATERAL (
            SELECT 'links' AS entity_type, i.links_id AS entity_id
            UNION ALL SELECT 'process', CAST(i.l_orderkey AS VARCHAR) WHERE i.l_linestatus = 'F'
            UNION ALL SELECT 'cell_line', CAST(i.l_partkey AS VARCHAR) WHERE i.l_linestatus = 'F'
            UNION ALL SELECT 'analysis_file', i.links_id WHERE i.l_linestatus = 'F'
            UNION ALL SELECT 'protocol', i.l_returnflag WHERE i.l_linestatus = 'F'
            UNION ALL SELECT 'project', CAST(i.l_suppkey AS VARCHAR) WHERE i.l_linestatus <> 'F'
            UNION ALL SELECT 'supplementary_file', CAST(i.l_partkey AS VARCHAR) WHERE i.l_linestatus <> 'F') u""",
    "loaded": f"""
        SELECT 'cell_line' AS entity_type, CAST(p_partkey AS VARCHAR) AS entity_id FROM part WHERE p_size <= 25
        UNION SELECT 'supplementary_file', CAST(p_partkey AS VARCHAR) FROM part WHERE p_size > 10
        UNION SELECT 'project', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal > 0
        UNION SELECT 'process', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus <> 'P'
        UNION SELECT 'protocol', l_returnflag FROM lineitem WHERE l_returnflag <> 'R'
        UNION SELECT 'analysis_file', {SQL_ITEM_ID} FROM lineitem
        UNION SELECT 'links', {SQL_ITEM_ID} FROM lineitem""",
}
