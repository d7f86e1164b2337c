"""From a staging area to newline-JSON rows, load requests, errors and warnings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.messages import error_counts
from strandline.operators import documents as D
from strandline.schemas import id_column, is_file_type
from strandline.session import land, land_batches
from strandline.sinks.writers import write_errors, write_json_rows
from strandline.sources.staging import document_batches


class DocumentErrors(Exception):
    """The batch was written but had errors."""


@dataclass(frozen=True)
class Preprocessed:
    rows: DataFrame
    requests: DataFrame
    errors: DataFrame
    warnings: DataFrame


def preprocess(spark: SparkSession, areas: Sequence[str], schemas: DataFrame) -> Preprocessed:
    """Read, check and reshape the documents of staging areas.

    The documents' small files are listed in a catalogue and opened once, in batches of bounded size: their
    compact text and findings are landed as a Parquet table in the shared folder, and everything else is derived
    from that table. Rows and requests are landed too, by type, as exports and loads read them several times.
    """
    columns = ("area", "kind", "entity_type", "file_name", "value")
    batches = (D.with_report(D.expected_documents(batch).select(*columns), schemas) for batch in document_batches(spark, areas))
    reported = land_batches(batches, "documents", "kind", "entity_type")
    rows, requests, errors = D.reshape(reported)
    named = spark.createDataFrame([(area.rstrip("/"),) for area in areas], "area string")
    warnings = D.no_match_warnings(reported, named)
    return Preprocessed(land(rows, "rows", "entity_type"), land(requests, "requests", "entity_type"), errors, warnings)


def typed_json(rows: DataFrame, entity_type: str) -> DataFrame:
    """Preprocessed rows of one type with that type's columns and order."""
    key = id_column(entity_type)
    own = rows.filter(F.col("entity_type") == entity_type)
    entity_id = F.col("entity_id").alias(key)
    if entity_type == "links":
        return own.select("content", entity_id, "version", "project_id")
    if is_file_type(entity_type):
        return own.select(entity_id, "version", "content", "crc32c", "descriptor")
    return own.select(entity_id, "version", "content")


def _types_in(frame: DataFrame) -> list[str]:
    """Entity types with rows; there are a few dozen at most."""
    return sorted(row.entity_type for row in frame.select("entity_type").distinct().collect())


def write_outputs(result: Preprocessed, out: str) -> None:
    """``metadata/{type}``, ``data-transfer-requests/{type}``, ``errors`` and ``warnings`` below ``out``.

    Each type's export reads its own folder of the landed rows; types without rows get no export.
    """
    for entity_type in _types_in(result.rows):
        write_json_rows(typed_json(result.rows, entity_type), f"{out}/metadata/{entity_type}")
    for entity_type in _types_in(result.requests):
        own = result.requests.filter(F.col("entity_type") == entity_type).select("source_path", "target_path")
        write_json_rows(own, f"{out}/data-transfer-requests/{entity_type}")
    write_errors(result.errors, f"{out}/errors")
    write_json_rows(result.warnings, f"{out}/warnings")


def require_no_errors(errors: DataFrame) -> None:
    """Raises if there are errors; call it after the outputs are written."""
    counts = {row.errorType: row.n_errors for row in error_counts(errors).collect()}
    if counts:
        raise DocumentErrors(f"errors by type: {counts}")


def run(spark: SparkSession, areas: Sequence[str], schemas: DataFrame, out: str) -> Preprocessed:
    """Preprocess, write everything, then fail if any document had an error."""
    result = preprocess(spark, areas, schemas)
    write_outputs(result, out)
    require_no_errors(spark.read.schema(result.errors.schema).json(f"{out}/errors"))
    return result
