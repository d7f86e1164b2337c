"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the jobs are written for; all can be changed on a live session.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # a look-up of this many ids is answered by the files' Bloom filters
    "spark.sql.parquet.pushdown.inFilterThreshold": "500",
    # staging areas hold one small document per file: pack many of them into a task
    "spark.sql.files.openCostInBytes": "262144",
    # rows hold whole documents: bound the batches that reach Python workers
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.execution.arrow.useLargeVarTypes": "true",
}


def build_session(app: str = "strandline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    """Versions are UTC instants and partition dates derive from them, so other zones are refused."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, found {zone}")


_shipped: list[SparkContext] = []


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per context, so that it need not be installed there."""
    context = spark.sparkContext
    if any(known is context for known in _shipped):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="strandline-"), "strandline-package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.append(context)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder from ``spark.checkpoint.dir``; a fresh local one only where unset, and only on one machine."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if current is None and configured is None and not context.master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share; the master is {context.master}")
    if current is None:
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="strandline-"))
        current = context.getCheckpointDir()
    return configured or current


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for an intermediate table."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


# Paths of the tables landed by this process, in order.
LANDED: list[str] = []


def remove_landed(spark: SparkSession, paths: list[str]) -> None:
    """Delete landed tables that nothing reads any more."""
    for path in paths:
        location = spark._jvm.org.apache.hadoop.fs.Path(path)
        location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)
        LANDED.remove(path)


def pin(frame: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint so later stages read one stable result."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def land(frame: DataFrame, label: str, *partition_cols: str, codec: str | None = None) -> DataFrame:
    """Write an intermediate table to the shared folder, by Spark's default codec or another, and read it back."""
    spark = frame.sparkSession
    path = work_path(spark, label)
    writer = frame.write.mode("overwrite")
    if codec:
        writer = writer.option("compression", codec)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    LANDED.append(path)
    return spark.read.schema(frame.schema).parquet(path).select(*frame.columns)


def land_batches(frames: Iterable[DataFrame], label: str, *partition_cols: str) -> DataFrame:
    """Write frames of one schema into one intermediate table, one after the other, and read it back; there must be one at least."""
    path, first = "", None
    for frame in frames:
        path = path or work_path(frame.sparkSession, label)
        first = first or frame
        writer = frame.write.mode("append")
        (writer.partitionBy(*partition_cols) if partition_cols else writer).parquet(path)
    LANDED.append(path)
    return first.sparkSession.read.schema(first.schema).parquet(path).select(*first.columns)
