"""Error and warning records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.names import base_name

# Record types and message texts.
NO_MATCH = "NoMatchWarning"
FILE_MISMATCH = "FileMismatchError"
NAME_MISMATCH = "NoRegexPatternMatchError"
MISSING_PROPERTY = "MissingPropertyError"
SCHEMA_VIOLATION = "SchemaValidationError"
TEXT_NO_MATCH = "%s had no matches"
TEXT_NO_DESCRIPTOR = "File is present in metadata/%s but not in descriptors/%s."
TEXT_NO_METADATA = "File is present in descriptors/%s but not in metadata/%s."
TEXT_ENTITY_NAME = "Error when finding entity id and version from file name."
TEXT_LINKS_NAME = "Error when finding links id, version, and project id from file."
TEXT_MISSING_PROPERTY = "File has no %s property."
TEXT_SCHEMA_NOT_LOADED = "Schema not loaded properly for schema at %s"
TEXT_SCHEMA_NOT_FOUND = "No schema found at %s"
TEXT_NOT_JSON = "Unable to parse data into json for file"
TEXT_VIOLATION = "Data in file does not conform to schema from %s; %s"


def document_path(area: Column, kind: Column, entity_type: Column, file_name: Column) -> Column:
    """Where the documents of an entity type are expected; links have no directory per type."""
    folder = F.when(kind == "links", kind).otherwise(F.concat_ws("/", kind, entity_type))
    return F.concat_ws("/", area, folder, file_name)


def errors(frame: DataFrame, error_type: Column | str, path: Column, message: Column) -> DataFrame:
    kind = F.lit(error_type) if isinstance(error_type, str) else error_type
    return frame.select(
        kind.alias("errorType"), path.alias("filePath"), base_name(path).alias("fileName"), message.alias("message")
    )


def error_counts(found: DataFrame) -> DataFrame:
    """Number of errors by type."""
    return found.groupBy("errorType").agg(F.count(F.lit(1)).alias("n_errors"))
