"""Release manifests and the check that everything staged has been loaded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.jsons import fingerprint
from strandline.functions.names import clean_path, is_bucket_path, project_id_in, require_project_id_in, stripped
from strandline.functions.versions import require_version
from strandline.operators.files import loaded_history, with_file_fields
from strandline.operators.skew import spread_join
from strandline.session import pin

# Fixed value: staging areas per manifest.
CHUNK_SIZE = 20
ENTITY = ("entity_type", "entity_id")


# --- manifests -------------------------------------------------------------------------------------


def intake_areas(intake: DataFrame, roots: DataFrame, release_tag: str | None = None, ids_only: bool = False) -> DataFrame:
    """Distinct manifest entries with their ``public`` mark; ``roots`` maps an institution to its root path.

    The entry is the area's path, or the project id alone, plus the release tag if one is given. It is
    public if any of its lines answers no to managed access. Unknown institutions, texts without
    exactly one project UUID and paths outside a bucket fail the job.
    """
    lines = intake.select(
        F.upper(stripped(F.col("institution"))).alias("institution"),
        stripped(F.col("project_id")).alias("project_text"),
        F.lower(stripped(F.col("managed_access"))).alias("managed_access"),
    )
    # every line must name one project, also where the text itself becomes the entry
    checked = lines.withColumn("found_id", require_project_id_in(F.col("project_text")))
    if ids_only:
        keyed = checked.filter("found_id is not null").withColumn("entry", F.col("project_text"))
    else:
        placed = checked.join(roots.select("institution", "root"), "institution", "left")
        unknown = F.raise_error(F.concat(F.lit("unknown institution "), F.coalesce("institution", F.lit("null"))))
        path = clean_path(F.concat(F.coalesce(F.col("root"), unknown.cast("string")), F.lit("/"), F.col("found_id")))
        outside = F.raise_error(F.concat(F.lit("not a bucket path: "), path)).cast("string")
        keyed = placed.withColumn("entry", F.when(is_bucket_path(path), path).otherwise(outside))
    if release_tag:
        keyed = keyed.withColumn("entry", F.concat("entry", F.lit(f",{release_tag}")))
    public = F.max((F.col("managed_access") == "no").cast("int")) == 1
    return keyed.groupBy("entry").agg(public.alias("public"))


def numbered(keys: DataFrame, column: str) -> DataFrame:
    """Distinct values with their position in sort order, from 0.

    The values are range-partitioned and pinned, so each task numbers its own range; the ranges'
    offsets come from one small table with a row per range.
    """
    ranged = keys.select(column).distinct().repartitionByRange(column).withColumn("range_no", F.spark_partition_id())
    fixed = pin(ranged)
    sizes = fixed.groupBy("range_no").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("range_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("range_no").orderBy(column)) - 1
    # one row per shuffle partition, so small enough to broadcast
    placed = fixed.join(F.broadcast(offsets), "range_no")
    return placed.select(column, (F.col("offset") + within).alias("position"))


def chunked(keys: DataFrame, column: str, size: int = CHUNK_SIZE) -> DataFrame:
    """Values in sort order cut into groups of ``size``, labelled a, b, c and so on."""
    chunk = F.floor(F.col("position") / size).cast("int")
    # labels go on through the code points after z
    label = F.decode(F.unhex(F.lpad(F.hex(F.lit(ord("a")) + chunk), 8, "0")), "UTF-32")
    return numbered(keys, column).select(column, chunk.alias("chunk"), label.alias("qualifier"))


def manifests(entries: DataFrame, release_tag: str, public_only: bool = False) -> DataFrame:
    """Manifest lines: ``entry`` and the name of the manifest it belongs to."""
    chosen = entries.filter("public") if public_only else entries
    name = F.concat(F.lit(f"{release_tag}_"), F.col("qualifier"), F.lit("_manifest"))
    return chunked(chosen, "entry").select("entry", name.alias("manifest"))


def areas_without_project(areas: DataFrame) -> DataFrame:
    """Areas whose path does not hold exactly one project UUID."""
    return areas.filter(project_id_in(F.col("area")).isNull())


# --- files -----------------------------------------------------------------------------------------


def expected_files(descriptors: DataFrame) -> DataFrame:
    """Distinct target path and checksum of each area; ``descriptors`` has ``area`` and ``descriptor``."""
    named = with_file_fields(descriptors.select("area", "descriptor"))
    return named.select("area", "file.target_path", F.col("file.crc32c").alias("checksum")).distinct()


def _loads(history: DataFrame) -> DataFrame:
    return loaded_history(history).select("target_path", F.col("checksum_crc32c").alias("checksum")).distinct()


def missing_files(expected: DataFrame, history: DataFrame) -> DataFrame:
    """Expected files that were not loaded with their path and checksum."""
    return spread_join(expected, _loads(history), ["target_path", "checksum"], "left_anti", ["area"])


def file_report(expected: DataFrame, history: DataFrame) -> DataFrame:
    """Per area: files ``staged``, distinct loads at their paths (``loaded``), and files ``missing``."""
    loads = _loads(history).withColumnRenamed("checksum", "loaded_checksum")
    joined = spread_join(expected, loads, ["target_path"], "left", ["area", "checksum"])
    per_file = joined.groupBy("area", "target_path", "checksum").agg(
        F.max(F.coalesce(F.col("loaded_checksum") == F.col("checksum"), F.lit(False)).cast("int")).alias("found")
    )
    staged = per_file.groupBy("area").agg(
        F.count(F.lit(1)).alias("staged"), F.lit(0).cast("bigint").alias("loaded"), F.sum(1 - F.col("found")).alias("missing")
    )
    at_paths = joined.filter("loaded_checksum is not null").select("area", "target_path", "loaded_checksum").distinct()
    zero = F.lit(0).cast("bigint")
    loaded = at_paths.groupBy("area").agg(F.count(F.lit(1)).alias("loaded")).select(
        "area", zero.alias("staged"), "loaded", zero.alias("missing")
    )
    sums = [F.sum(name).alias(name) for name in ("staged", "loaded", "missing")]
    return staged.unionByName(loaded).groupBy("area").agg(*sums)


# --- entities --------------------------------------------------------------------------------------


def before_cutoff(staged: DataFrame, cutoff: Column) -> DataFrame:
    """Staged entities whose version is not later than the release cutoff."""
    return staged.withColumn("version_ts", require_version(F.col("version"))).filter(F.col("version_ts") <= cutoff)


def _print(rows: DataFrame) -> Column:
    return (F.col("content_digest") if "content_digest" in rows.columns else fingerprint(F.col("content"))).alias("print")


def latest_staged(staged: DataFrame, by: Sequence[str] = ("area", *ENTITY)) -> DataFrame:
    """Of each staged entity the row with the largest version text, and its content's fingerprint.

    The fingerprint replaces the content before anything is shuffled; ``content_digest`` stands for it where the
    rows have that, which must then hold for staged and stored rows alike.
    """
    narrow = staged.select(*by, "version", _print(staged))
    newest = F.max(F.struct("version", "print")).alias("newest")
    return narrow.groupBy(*by).agg(newest).select(*by, "newest.version", "newest.print")


def latest_stored(rows: DataFrame) -> DataFrame:
    """Of each stored entity the newest version and its content's fingerprint, as in ``latest_staged``."""
    narrow = rows.select(*ENTITY, "version", _print(rows))
    newest = F.max(F.struct("version", "print")).alias("newest")
    return narrow.groupBy(*ENTITY).agg(newest).select(
        *ENTITY, F.col("newest.version").alias("stored_version"), F.col("newest.print").alias("stored_print")
    )


def compare_entities(staged: DataFrame, stored: DataFrame) -> DataFrame:
    """Each staged entity with a ``status`` against the store.

    ``missing``; ``superseded`` (the store has a newer version, which is fine); ``version_differs``;
    ``content_differs``; ``both_differ``; ``ok``. ``staged`` and ``stored`` come from ``latest_*``.
    """
    joined = spread_join(staged, stored, ENTITY, "left", [n for n in staged.columns if n not in ENTITY])
    version = require_version(F.col("version"))
    other_version = version != F.col("stored_version")
    other_content = ~F.col("print").eqNullSafe(F.col("stored_print"))
    status = (
        F.when(F.col("stored_version").isNull(), "missing")
        .when(version < F.col("stored_version"), "superseded")
        .when(other_version & other_content, "both_differ")
        .when(other_version, "version_differs")
        .when(other_content, "content_differs")
        .otherwise("ok")
    )
    return joined.withColumn("status", status).drop("print", "stored_print")


def entity_report(compared: DataFrame) -> DataFrame:
    """Per area: entities expected and entities in error."""
    bad = ~F.col("status").isin("ok", "superseded")
    return compared.groupBy("area").agg(
        F.count(F.lit(1)).alias("entities"), F.sum(bad.cast("bigint")).alias("entity_errors")
    )


def verify_areas(areas: DataFrame, files: DataFrame, entities: DataFrame) -> DataFrame:
    """Per area of a manifest: file and metadata counts, the two error flags and ``has_errors``."""
    counts = ["staged", "loaded", "missing", "entities", "entity_errors"]
    zero = F.lit(0).cast("bigint")
    parts = (
        areas.select("area", *[zero.alias(c) for c in counts]).distinct()
        .unionByName(files.select("area", *counts[:3], *[zero.alias(c) for c in counts[3:]]))
        .unionByName(entities.select("area", *[zero.alias(c) for c in counts[:3]], *counts[3:]))
    )
    summed = parts.groupBy("area").agg(*[F.sum(c).alias(c) for c in counts])
    flagged = summed.withColumns(
        {"has_file_errors": F.col("missing") > 0, "has_metadata_errors": F.col("entity_errors") > 0}
    )
    return flagged.withColumn("has_errors", F.col("has_file_errors") | F.col("has_metadata_errors"))
