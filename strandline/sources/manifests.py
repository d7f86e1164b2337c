"""Line- and CSV-based inputs of a release."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.names import clean_area_line
from strandline.schemas import INTAKE, PROJECT_LIST


def read_release_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One staging area per line, as ``area``."""
    return spark.read.text(path).select(clean_area_line(F.col("value")).alias("area"))


def read_intake(spark: SparkSession, path: str) -> DataFrame:
    """Lines of institution, project id and managed access; blank lines are skipped, other widths fail the job."""
    return spark.read.schema(INTAKE).option("mode", "FAILFAST").csv(path)


def read_project_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of project id and data set qualifier."""
    return spark.read.schema(PROJECT_LIST).option("mode", "FAILFAST").csv(path)
