"""Verification of a release: every staged file and document of a manifest's areas has arrived."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.jsons import content_digest
from strandline.operators import release as R
from strandline.operators.documents import expected_documents
from strandline.operators.skew import small
from strandline.plans.store import Store
from strandline.schemas import FILE_TYPES
from strandline.session import land
from strandline.sources.manifests import read_release_manifest
from strandline.sources.staging import read_descriptors, read_documents


class ReleaseErrors(Exception):
    """Areas of the release are not completely loaded."""


def staged_entities(spark: SparkSession, areas: list[str]) -> DataFrame:
    """Id, version and digest of the metadata and links documents of the areas."""
    documents = expected_documents(read_documents(spark, areas, kinds=("metadata", "links")))
    parts = F.split("file_name", "_")
    version = F.replace(F.get(parts, F.lit(1)), F.lit(".json"), F.lit(""))
    return documents.select(
        "area", "entity_type", F.get(parts, F.lit(0)).alias("entity_id"), version.alias("version"),
        content_digest(F.col("value")).alias("content_digest"),
    )


def verify(store: Store, manifest: str, cutoff: datetime) -> DataFrame:
    """Per area: counts, file and metadata error flags. All areas go through one plan."""
    spark = store.spark
    listed = read_release_manifest(spark, manifest).filter("area <> ''").distinct()
    # paths to read must be known when the scan is planned; a manifest is a hand-written list
    areas = sorted({row.area.rstrip("/") for row in listed.toLocalIterator()})
    named = spark.createDataFrame([(area,) for area in areas], "area string")
    expected = land(R.expected_files(read_descriptors(spark, areas, FILE_TYPES)), "expected-files")
    files = R.file_report(expected, store.history())
    staged = land(R.latest_staged(R.before_cutoff(staged_entities(spark, areas), F.lit(cutoff))), "staged-entities")
    # stored rows have their digest, so no stored content is read
    types = sorted(row.entity_type for row in staged.select("entity_type").distinct().collect())  # a few dozen
    wanted = small(staged.select(*R.ENTITY).distinct())
    stored = store.live(types).select(*R.ENTITY, "version", "content_digest").join(wanted, list(R.ENTITY), "left_semi")
    compared = R.compare_entities(staged, R.latest_stored(stored))
    return R.verify_areas(named, files, R.entity_report(compared))


def require_complete(report: DataFrame) -> None:
    bad = report.filter("has_errors").select("area").limit(20).collect()
    if bad:
        raise ReleaseErrors(f"areas with errors (first 20): {[row.area for row in bad]}")
