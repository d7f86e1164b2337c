"""Parsing and building of file names, paths and data set names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions.versions import date_stamp

# The version-4 UUID pattern, and the shapes of data set names, of snapshot names and of earlier ones.
UUID_V4 = "(?i)([a-f0-9]{8}-?[a-f0-9]{4}-?4[a-f0-9]{3}-?[89ab][a-f0-9]{3}-?[a-f0-9]{12})"
DATASET_NAME = r"^%s_(dev|prod|staging)_([0-9a-f]{32})?__(\d{4})(\d{2})(\d{2})(?:_([a-zA-Z][a-zA-Z0-9]{0,15}))?$"
SNAPSHOT_NAME = (
    r"^(%s)_(dev|prod|staging)_([0-9a-f]{32})?__(\d{4})(\d{2})(\d{2})(?:_([a-zA-Z][a-zA-Z0-9]{0,15}))?"
    r"_(\d{4})(\d{2})(\d{2})(?:_([a-zA-Z][a-zA-Z0-9]{0,15}))?$"
)
EARLIER_SNAPSHOT_NAME = (
    r"^(%s)_(dev|prod|staging)_(\d{4})(\d{2})(\d{2})(_[a-zA-Z][a-zA-Z0-9]{0,13})?_([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})?"
    r"__(\d{4})(\d{2})(\d{2})(?:_([a-zA-Z][a-zA-Z0-9]{0,13}))?$"
)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "[^/]*$", 0)


def parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def name_parts(file_name: Column) -> Column:
    """Underscore-separated parts of a ``.json`` name; empty parts at the end do not count."""
    stem = F.regexp_replace(file_name, r"\.json$", "")
    return F.split(F.regexp_replace(stem, "_+$", ""), "_")


def without_dashes(text: Column) -> Column:
    return F.replace(text, F.lit("-"), F.lit(""))


def project_id_in(text: Column) -> Column:
    """The only version-4 UUID in a text; null when there is none or more than one."""
    found = F.regexp_extract_all(text, F.lit(UUID_V4), F.lit(1))
    return F.when(F.size(found) == 1, F.element_at(found, 1))


def require_project_id_in(text: Column) -> Column:
    complaint = F.raise_error(F.concat(F.lit("expected exactly one project UUID in "), F.coalesce(text, F.lit("null"))))
    return F.coalesce(project_id_in(text), complaint.cast("string"))


def stripped(text: Column) -> Column:
    """A text without outer white space of any kind."""
    return F.regexp_replace(text, r"^(?U)\s+|(?U)\s+$", "")


def clean_path(path: Column) -> Column:
    """Outer white space and slashes removed."""
    return F.regexp_replace(stripped(path), "^/+|/+$", "")


def clean_area_line(line: Column) -> Column:
    """A manifest line without its trailing newline and slash characters and without outer blanks."""
    return stripped(F.regexp_replace(line, r"[\n/]+$", ""))


def is_bucket_path(path: Column) -> Column:
    return path.startswith("gs://")


def dataset_name_pattern(atlas: str) -> str:
    return DATASET_NAME % atlas


def snapshot_name_patterns(atlases: Sequence[str]) -> tuple[str, str]:
    """The earlier and the current snapshot name pattern."""
    names = "|".join(atlases)
    return EARLIER_SNAPSHOT_NAME % names, SNAPSHOT_NAME % names


def _suffix(qualifier: Column) -> Column:
    blank = F.coalesce(qualifier, F.lit("")) == ""
    return F.when(blank, F.lit("")).otherwise(F.concat(F.lit("_"), qualifier))


def dataset_name(atlas: Column, env: Column, project_id: Column, created: Column, qualifier: Column) -> Column:
    """``{atlas}_{env}_{id}__{created}[_qualifier]``."""
    head = F.concat_ws("_", atlas, env, without_dashes(project_id))
    return F.concat(head, F.lit("__"), date_stamp(created), _suffix(qualifier))


def full_view_name(dataset: Column, moment: Column, tag: Column) -> Column:
    """``{dataset}___{date}[_tag]``."""
    return F.concat(dataset, F.lit("___"), date_stamp(moment), _suffix(tag))


def project_snapshot_name(
    atlas: Column, env: Column, project_id: Column, source_dataset: Column, moment: Column,
    dataset_qualifier: Column, tag: Column,
) -> Column:
    """``{atlas}_{env}_{id}__{created}[_q]_{date}[_tag]``, created and q taken from the source data set's name."""
    tail = F.split(F.element_at(F.split(source_dataset, "__"), 2), "_")
    has_qualifier = F.coalesce(dataset_qualifier, F.lit("")) != ""
    created = F.when(has_qualifier, F.concat_ws("_", tail[0], F.get(tail, 1))).otherwise(tail[0])
    head = F.concat_ws("_", atlas, env, without_dashes(project_id))
    return F.concat(head, F.lit("__"), created, F.lit("_"), date_stamp(moment), _suffix(tag))
