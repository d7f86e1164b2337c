"""From staged documents to table rows, load requests, errors and warnings.

``documents`` has the columns of ``schemas.DOCUMENTS``: area, kind (metadata, descriptors or links),
entity type, file name and raw text. All entity types go through one plan.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import messages as M
from strandline.functions.jsons import compact_text, digest_of, is_string_property, read_document, scalar
from strandline.functions.names import name_parts
from strandline.functions.schema_check import BadSchema, violations
from strandline.operators.files import FILE_FIELDS, load_requests, with_file_fields, without_request
from strandline.operators.skew import spread_join
from strandline.schemas import FILE_TYPES, LINKS, NON_FILE_TYPES

FILE_KEY = ("area", "entity_type", "file_name")
# A schema registry up to this many bytes is held by every Python worker; a larger one is joined.
REGISTRY_LIMIT = 32 * 1024 * 1024
# Parsed schemas a task remembers.
SCHEMAS_HELD = 1000


def expected_documents(documents: DataFrame) -> DataFrame:
    """Documents of the known entity types in the places they belong."""
    kind, entity_type = F.col("kind"), F.col("entity_type")
    return documents.filter(
        ((kind == "metadata") & entity_type.isin(*NON_FILE_TYPES, *FILE_TYPES))
        | ((kind == "descriptors") & entity_type.isin(*FILE_TYPES))
        | ((kind == "links") & (entity_type == LINKS))
    )


def document_path_column() -> Column:
    return M.document_path(F.col("area"), F.col("kind"), F.col("entity_type"), F.col("file_name"))


# --- names -----------------------------------------------------------------------------------------


def with_entity_name(documents: DataFrame) -> DataFrame:
    """``entity_id`` and ``version`` from the file name; both null unless it has exactly two parts."""
    parts = name_parts(F.col("file_name"))
    named = F.size(parts) == 2
    return documents.withColumns(
        {"entity_id": F.when(named, parts[0]), "version": F.when(named, F.get(parts, F.lit(1)))}
    )


def with_links_name(documents: DataFrame) -> DataFrame:
    """``entity_id``, ``version`` and ``project_id`` from a links file name of exactly three parts."""
    parts = name_parts(F.col("file_name"))
    named = F.size(parts) == 3
    return documents.withColumns(
        {
            "entity_id": F.when(named, parts[0]),
            "version": F.when(named, F.get(parts, F.lit(1))),
            "project_id": F.when(named, F.get(parts, F.lit(2))),
        }
    )


def name_errors(named: DataFrame) -> DataFrame:
    """Errors for documents whose name could not be split; ``named`` comes from a ``with_*_name``."""
    text = F.when(F.col("kind") == "links", M.TEXT_LINKS_NAME).otherwise(M.TEXT_ENTITY_NAME)
    return M.errors(named.filter(F.col("entity_id").isNull()), M.NAME_MISMATCH, document_path_column(), text)


# --- required properties ---------------------------------------------------------------------------


def with_missing_property(documents: DataFrame, *names: str, text: str = "value") -> DataFrame:
    """``missing``: the first of ``names`` that is not a string property of the document, or null.

    Documents that went through ``with_report`` carry the names of their string properties; others are parsed.
    """
    reported = "strings" in documents.columns
    reason: Column = F.lit(None).cast("string")
    for name in reversed(names):
        held = F.coalesce(F.array_contains("strings", name), F.lit(False)) if reported else is_string_property(F.col(text), name)
        reason = F.when(~held, F.lit(name)).otherwise(reason)
    return documents.withColumn("missing", reason)


def property_errors(checked: DataFrame) -> DataFrame:
    text = F.format_string(M.TEXT_MISSING_PROPERTY, F.col("missing"))
    return M.errors(checked.filter("missing is not null"), M.MISSING_PROPERTY, document_path_column(), text)


def complete_descriptors(documents: DataFrame, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """Descriptors with a checksum and a file name, and the errors of the others (one per file)."""
    checked = with_missing_property(documents, "crc32c", "file_name", text=text)
    return checked.filter("missing is null").drop("missing"), property_errors(checked)


# --- schema validation -----------------------------------------------------------------------------


def _scalar_text(value: object) -> str | None:
    """A scalar as text; null for JSON null, objects and arrays."""
    if value is None or isinstance(value, (dict, list)):
        return None
    return value if isinstance(value, str) else compact_text(value)


def _report_column(value: Column, schema_text: Column, registry: object) -> Column:
    """Struct of the compact document, its findings and its string properties; parses each document once."""

    loaded: dict[str, object] = {}
    not_json, not_found, not_loaded, violation = M.TEXT_NOT_JSON, M.TEXT_SCHEMA_NOT_FOUND, M.TEXT_SCHEMA_NOT_LOADED, M.TEXT_VIOLATION

    def schema_for(name: str, text: str | None):
        known = registry.value if registry is not None else None
        source = known.get(name) if known is not None else text
        if source is None:
            return None, not_found % name
        if name not in loaded:
            if len(loaded) >= SCHEMAS_HELD:
                loaded.clear()
            try:
                loaded[name] = json.loads(source)
            except ValueError:
                loaded[name] = None
        schema = loaded[name]
        return schema, None if isinstance(schema, (dict, bool)) else not_loaded % name

    def examine(raw: str | None, text: str | None):
        try:
            document = read_document(raw)
            content = compact_text(document)
        except (TypeError, ValueError):
            return None, not_json, None, None, *[None] * len(FILE_FIELDS), False
        properties = document if isinstance(document, dict) else {}
        strings = [key for key, held in properties.items() if isinstance(held, str)]
        digest = digest_of(document)
        named = *(_scalar_text(properties.get(key)) for key in FILE_FIELDS), "drs_uri" in properties
        if "describedBy" not in strings:
            return content, None, strings, digest, *named
        name = document["describedBy"]
        schema, problem = schema_for(name, text)
        if problem is None:
            try:
                found = ",".join(violations(document, schema))
                problem = violation % (name, found) if found else None
            except BadSchema:
                problem = not_loaded % name
        return content, problem, strings, digest, *named

    @F.pandas_udf(f"content string, finding string, strings array<string>, content_digest string, {', '.join(f'{name} string' for name in FILE_FIELDS)}, hosted boolean")
    def report(values: pd.Series, texts: pd.Series) -> pd.DataFrame:
        def clean(series: pd.Series) -> pd.Series:
            return series.astype(object).where(series.notna(), None)

        rows = [examine(*row) for row in zip(clean(values), clean(texts))]
        return pd.DataFrame(rows, columns=["content", "finding", "strings", "content_digest", *FILE_FIELDS, "hosted"])

    return report(value, schema_text)


def with_report(documents: DataFrame, schemas: DataFrame, registry_limit: int = REGISTRY_LIMIT) -> DataFrame:
    """``value`` replaced by ``content`` (compact text, null if not JSON), ``finding`` (message or null) and
    ``strings`` (names of the top-level string properties), ``content_digest``, and ``named``: a descriptor's fields as
    ``files.with_file_fields`` takes them, and whether its file is hosted elsewhere.

    Documents without a ``describedBy`` string have no schema to be checked against. One action
    measures the schema table: if its text fits ``registry_limit`` every worker gets all of it,
    else the schema text is joined to the documents by url.
    """
    spark = documents.sparkSession
    known = schemas.filter("url is not null").groupBy("url").agg(F.max("schema_text").alias("schema_text"))
    size = known.agg(F.sum(F.octet_length("url") + F.octet_length("schema_text"))).first()[0] or 0
    no_text = F.lit(None).cast("string")
    if size <= registry_limit:
        registry = spark.sparkContext.broadcast({row.url: row.schema_text for row in known.toLocalIterator()})
        source = documents
        report = _report_column(F.col("value"), no_text, registry)
    else:
        # whether the property is a string shows when the document is parsed
        keyed = documents.withColumn("url", F.get_json_object("value", "$.describedBy"))
        source = spread_join(keyed, known, ["url"], "left", ["area", "file_name"])
        report = _report_column(F.col("value"), F.col("schema_text"), None)
    columns = [F.col(name) for name in documents.columns if name != "value"]
    reported = source.select(*columns, report.alias("report"))
    named = F.struct(*(F.col(f"report.{name}").alias(name) for name in (*FILE_FIELDS, "hosted"))).alias("named")
    return reported.select(*columns, "report.content", "report.finding", "report.strings", "report.content_digest", named)


def schema_errors(reported: DataFrame) -> DataFrame:
    return M.errors(
        reported.filter("finding is not null"), M.SCHEMA_VIOLATION, document_path_column(), F.col("finding")
    )


def schema_urls(documents: DataFrame) -> DataFrame:
    """Distinct schema urls the documents name."""
    named = documents.filter(is_string_property(F.col("value"), "describedBy"))
    return named.select(scalar(F.col("value"), "$.describedBy").alias("url")).distinct()


# --- metadata and descriptors ----------------------------------------------------------------------


def match_descriptors(metadata: DataFrame, descriptors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """File metadata joined to its descriptor by file name, and an error for each side without the other.

    ``metadata`` and ``descriptors`` hold a ``content`` column; pairs carry ``content`` and ``descriptor``.
    """
    carried = [name for name in ("named",) if name in descriptors.columns]
    described = descriptors.select(*FILE_KEY, F.col("content").alias("descriptor"), *carried)
    metadata = metadata.drop(*carried)
    keys = list(FILE_KEY)
    # both inputs of the inner join come straight from a shuffle, so adaptive execution can split a
    # heavy name on either side; the unmatched names need the key columns only
    pairs = metadata.join(described, keys, "inner")
    metadata_names, descriptor_names = metadata.select(*keys), described.select(*keys)
    alone = metadata_names.join(descriptor_names.distinct(), keys, "left_anti")
    unpaired = descriptor_names.join(metadata_names.distinct(), keys, "left_anti")
    entity_type = F.col("entity_type")
    no_descriptor = M.errors(
        alone, M.FILE_MISMATCH,
        M.document_path(F.col("area"), F.lit("descriptors"), entity_type, F.col("file_name")),
        F.format_string(M.TEXT_NO_DESCRIPTOR, entity_type, entity_type),
    )
    no_metadata = M.errors(
        unpaired, M.FILE_MISMATCH,
        M.document_path(F.col("area"), F.lit("metadata"), entity_type, F.col("file_name")),
        F.format_string(M.TEXT_NO_METADATA, entity_type, entity_type),
    )
    return pairs, no_descriptor.unionByName(no_metadata)


# --- table rows ------------------------------------------------------------------------------------

STAGED = ("area", "entity_type", "entity_id", "version", "content", "content_digest", "project_id", "crc32c", "descriptor")


def _staged(named: DataFrame, **extra: Column) -> DataFrame:
    null = F.lit(None).cast("string")
    return named.filter("entity_id is not null").select(
        *[extra[name].alias(name) if name in extra else null.alias(name) if name not in named.columns else F.col(name)
          for name in STAGED]
    )


def metadata_rows(named: DataFrame) -> DataFrame:
    """Rows of the types without files."""
    return _staged(named)


def file_rows(named_pairs: DataFrame) -> DataFrame:
    """Rows of the file types; the checksum comes from the descriptor."""
    return _staged(with_file_fields(named_pairs), crc32c=F.col("file.crc32c"))


def links_rows(named: DataFrame) -> DataFrame:
    return _staged(named)


# --- the whole step --------------------------------------------------------------------------------


def reshape(reported: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows, load requests and errors of documents that went through ``with_report``.

    Validation only reports: rows are made from documents that break their schema too. Incomplete
    descriptors are dropped, so their metadata is reported as unmatched as well.
    """
    readable = reported.filter("content is not null")
    kind, is_file = F.col("kind"), F.col("entity_type").isin(*FILE_TYPES)
    metadata = readable.filter(kind == "metadata")
    descriptors, descriptor_errors = complete_descriptors(readable.filter(kind == "descriptors"), text="content")
    pairs, mismatches = match_descriptors(metadata.filter(is_file), descriptors)
    named_metadata = with_entity_name(metadata.filter(~is_file))
    named_pairs = with_entity_name(pairs)
    named_links = with_links_name(readable.filter(kind == "links"))

    rows = metadata_rows(named_metadata).unionByName(file_rows(named_pairs)).unionByName(links_rows(named_links))
    described = descriptors.select(*FILE_KEY, "kind", F.col("content").alias("descriptor"), "named")
    requests = load_requests(described)
    # a descriptor that was dropped as incomplete is not validated
    validated = with_missing_property(
        reported.filter((kind != "descriptors") | F.col("content").isNull()).unionByName(descriptors),
        "describedBy", text="content",
    )
    errors = (
        property_errors(validated.filter("content is not null"))
        .unionByName(schema_errors(validated))
        .unionByName(descriptor_errors)
        .unionByName(property_errors(without_request(described).withColumn("missing", F.lit("file_id"))))
        .unionByName(mismatches)
        .unionByName(name_errors(named_metadata))
        .unionByName(name_errors(named_pairs))
        .unionByName(name_errors(named_links))
    )
    return rows, requests, errors


def no_match_warnings(documents: DataFrame, areas: DataFrame) -> DataFrame:
    """A warning for each expected file pattern of each area that no document matches."""
    places = [("metadata", t) for t in NON_FILE_TYPES + FILE_TYPES] + [("descriptors", t) for t in FILE_TYPES]
    places.append(("links", LINKS))
    expected = areas.select(
        "area",
        F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(t).alias("entity_type")) for k, t in places])).alias("p"),
    ).select("area", "p.kind", "p.entity_type")
    present = documents.select("area", "kind", "entity_type").distinct()
    silent = expected.join(present, ["area", "kind", "entity_type"], "left_anti")
    pattern = M.document_path(F.col("area"), F.col("kind"), F.col("entity_type"), F.lit("**.json"))
    return silent.select(
        F.lit(M.NO_MATCH).alias("warningType"), F.format_string(M.TEXT_NO_MATCH, pattern).alias("message")
    )
