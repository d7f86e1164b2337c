"""Entity types and table shapes.

All operators work on one long table, ``rows``, keyed by ``entity_type``; ``typed_view`` gives the
table of a single type with its own id column, ``long_view`` goes the other way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The entity types, their directories and the load path root.
NON_FILE_TYPES = (
    "aggregate_generation_protocol",
    "analysis_process",
    "analysis_protocol",
    "cell_line",
    "cell_suspension",
    "collection_protocol",
    "differentiation_protocol",
    "dissociation_protocol",
    "donor_organism",
    "enrichment_protocol",
    "imaged_specimen",
    "imaging_preparation_protocol",
    "imaging_protocol",
    "ipsc_induction_protocol",
    "library_preparation_protocol",
    "organoid",
    "process",
    "project",
    "protocol",
    "sequencing_protocol",
    "specimen_from_organism",
)
FILE_TYPES = (
    "analysis_file",
    "image_file",
    "reference_file",
    "sequence_file",
    "supplementary_file",
)
LINKS = "links"
PROJECT = "project"
ENTITY_TYPES = NON_FILE_TYPES + FILE_TYPES + (LINKS,)
TOP_LEVEL_DIRS = ("data", "descriptors", "links", "metadata")
TARGET_ROOT = "/v1"
LOADED = "succeeded"


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_S, _TS = T.StringType(), T.TimestampType()

# the long table of all entity types, as stored
ROWS = _struct(
    ("entity_id", _S, False),
    ("version", _TS, False),
    ("content", _S, True),
    ("project_id", _S, True),
    ("file_id", _S, True),
    ("descriptor", _S, True),
    # stands in for the content in comparisons, see functions.jsons.digest_of
    ("content_digest", _S, True),
    ("row_id", _S, False),
    ("entity_type", _S, False),
    ("version_date", T.DateType(), False),
)
# staged rows of all types, before they have a row id
STAGED = _struct(
    ("entity_type", _S, False),
    ("entity_id", _S, True),
    ("version", _TS, True),
    ("content", _S, True),
    ("project_id", _S, True),
    ("file_id", _S, True),
    ("descriptor", _S, True),
    ("crc32c", _S, True),
)
DOCUMENTS = _struct(
    ("area", _S, False),
    ("kind", _S, False),
    ("entity_type", _S, False),
    ("file_name", _S, False),
    ("value", _S, True),
)
# files of staging areas
CATALOGUE = _struct(
    ("area", _S, False),
    ("top", _S, True),
    ("entity_type", _S, True),
    ("file_name", _S, False),
    ("file_path", _S, False),
    ("file_size", T.LongType(), False),
)
LOAD_HISTORY = _struct(
    ("state", _S, True),
    ("target_path", _S, True),
    ("checksum_crc32c", _S, True),
    ("file_id", _S, True),
)
LOAD_REQUESTS = _struct(("source_path", _S, True), ("target_path", _S, True))
# removed rows, with the file and the place there that hold them
TOMBSTONES = _struct(("row_id", _S, False), ("__file", _S, False), ("__place", T.LongType(), False), ("entity_type", _S, False))
JSON_SCHEMAS = _struct(("url", _S, False), ("schema_text", _S, True))
ERRORS = _struct(
    ("errorType", _S, False), ("filePath", _S, False), ("fileName", _S, False), ("message", _S, False)
)
WARNINGS = _struct(("warningType", _S, False), ("message", _S, False))
INTAKE = _struct(("institution", _S, True), ("project_id", _S, True), ("managed_access", _S, True))
PROJECT_LIST = _struct(("project_id", _S, True), ("dataset_qualifier", _S, True))

LINKS_CONTENT = T.StructType(
    [
        T.StructField(
            "links",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("link_type", _S),
                        T.StructField("process_type", _S),
                        T.StructField("process_id", _S),
                        T.StructField("inputs", T.ArrayType(_struct(("input_type", _S, True), ("input_id", _S, True)))),
                        T.StructField("outputs", T.ArrayType(_struct(("output_type", _S, True), ("output_id", _S, True)))),
                        T.StructField("protocols", T.ArrayType(_struct(("protocol_type", _S, True), ("protocol_id", _S, True)))),
                        T.StructField("entity", _struct(("entity_type", _S, True), ("entity_id", _S, True))),
                        T.StructField("files", T.ArrayType(_struct(("file_type", _S, True), ("file_id", _S, True)))),
                    ]
                )
            ),
        )
    ]
)


def id_column(entity_type: str) -> str:
    return f"{entity_type}_id"


def is_file_type(entity_type: str) -> bool:
    return entity_type in FILE_TYPES


def table_schema(entity_type: str) -> T.StructType:
    """Columns of the stored table of one type, without the row id."""
    if entity_type not in ENTITY_TYPES:
        raise ValueError(f"unknown entity type {entity_type}")
    key = (id_column(entity_type), _S, False)
    if entity_type == LINKS:
        return _struct(key, ("version", _TS, False), ("project_id", _S, False), ("content", _S, True))
    if is_file_type(entity_type):
        return _struct(
            key, ("version", _TS, False), ("file_id", _S, True), ("content", _S, False), ("descriptor", _S, False)
        )
    return _struct(key, ("version", _TS, False), ("content", _S, False))


def staged_schema(entity_type: str) -> T.StructType:
    """Columns of a staged newline-JSON file of one type; file types carry a checksum and no file id yet."""
    if not is_file_type(entity_type):
        return table_schema(entity_type)
    return _struct(
        (id_column(entity_type), _S, False),
        ("version", _TS, False),
        ("content", _S, False),
        ("crc32c", _S, False),
        ("descriptor", _S, False),
    )


def version_date(version: Column) -> Column:
    return F.to_date(version)


def typed_view(rows: DataFrame, entity_type: str, *extra: str) -> DataFrame:
    """The rows of one type under that type's own column names, plus ``extra`` columns such as ``row_id``."""
    wanted = table_schema(entity_type).fieldNames()
    key = id_column(entity_type)
    return rows.filter(F.col("entity_type") == entity_type).select(
        *[F.col("entity_id").alias(key) if name == key else F.col(name) for name in wanted], *extra
    )


def long_view(table: DataFrame, entity_type: str) -> DataFrame:
    """The table of one type in the long form; columns the type lacks are null."""
    key = id_column(entity_type)
    # the project table's own id column is also called project_id, but only links refer to a project
    present = set(table.columns) - {key}
    null = F.lit(None).cast("string")
    optional = [n for n in ("content", "project_id", "file_id", "descriptor")]
    columns = [F.lit(entity_type).alias("entity_type"), F.col(key).alias("entity_id"), F.col("version")]
    columns += [F.col(n) if n in present else null.alias(n) for n in optional]
    columns += [F.col(n) for n in ("row_id", "crc32c") if n in present]
    return table.select(*columns)
