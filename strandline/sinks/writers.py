"""Output tables, exports and control files."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable
from functools import partial

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from strandline.functions.jsons import content_digest
from strandline.functions.versions import format_version
from strandline.schemas import ROWS, TOMBSTONES, version_date


FILES_PER_TASK = 2000  # of those that hold a single row
STORED = "zstd"  # codec of stored rows: digests are hexadecimal, which it halves and Spark's default leaves as long


def _json_ready(frame: DataFrame) -> DataFrame:
    """Timestamps in the version format, so that an export reads back unchanged."""
    return frame.select(
        *[format_version(F.col(n)).alias(n) if t in ("timestamp", "timestamp_ntz") else F.col(n) for n, t in frame.dtypes]
    )


def write_json_rows(frame: DataFrame, path: str) -> None:
    """Newline-JSON, replacing what is there."""
    _json_ready(frame).write.mode("overwrite").json(path)


def replace_table(frame: DataFrame, path: str) -> DataFrame:
    """The result replaces the table at ``path``; the stored table is returned."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def export_json(table: DataFrame, path: str) -> int:
    """Newline-JSON export of a stored table; nothing is written for a table without rows."""
    n_rows = table.count()
    if n_rows:
        write_json_rows(table, path)
    return n_rows


def write_ids(ids: DataFrame, column: str, path: str) -> None:
    """One id per line, without a header, replacing what is there."""
    ids.select(column).write.mode("overwrite").option("header", False).csv(path)


def write_row_id_files(rows: DataFrame, path: str) -> None:
    """A control file of row ids for each table."""
    rows.select("entity_type", "row_id").distinct().write.mode("overwrite").partitionBy("entity_type").option(
        "header", False
    ).csv(path)


def write_errors(errors: DataFrame, path: str) -> None:
    errors.write.mode("overwrite").json(path)


def write_tsv(frame: DataFrame, path: str, sort_by: str = "name") -> None:
    """Tab-separated with a header, the files in sort order."""
    frame.orderBy(sort_by).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def _write_each(folder: str, name: str, ending: str, rows: Iterable[Row]) -> None:
    part = TaskContext.get().partitionId()
    for place, row in enumerate(rows):
        with open(f"{folder}/{name}-{part:05d}-{place:05d}{ending}", "w", encoding="utf-8", newline="") as file:
            file.write(row.value + "\n")


def write_single_files(frame: DataFrame, folder: str, name: str, kind: str = "json") -> None:
    """A file for each row, spread over tasks, in a new folder: ``json``, or ``text`` of the one column; names begin with ``name``.

    On a local or mounted file system the tasks open the files themselves: there Hadoop starts a process
    (``chmod``) for each file and each checksum, some ten milliseconds a file. Rows are in a fixed order, so a task
    that runs again writes the same files.
    """
    spark = frame.sparkSession
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place = location.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(location).toUri()
    n = max(1, -(-frame.count() // FILES_PER_TASK))
    spread = frame.repartition(n, *frame.columns).sortWithinPartitions(*frame.columns)
    if place.getScheme() != "file":
        spread.write.option("maxRecordsPerFile", 1).option("mapreduce.output.basename", name).format(kind).save(folder)
        return
    value = F.to_json(F.struct("*")) if kind == "json" else F.coalesce(frame.columns[0], F.lit(""))
    os.makedirs(place.getPath())
    spread.select(value.alias("value")).foreachPartition(partial(_write_each, place.getPath(), name, ".json" if kind == "json" else ".txt"))


def write_manifests(lines: DataFrame, path: str) -> None:
    """One folder per manifest with one file of plain lines; ``lines`` has ``entry`` and ``manifest``."""
    lines.select("entry", "manifest").repartition("manifest").write.mode("overwrite").partitionBy("manifest").text(path)


def _row_id() -> Column:
    """A UUID of version 8 for each row: 60 bits that are random for each append, then the writing task and the row's number there.

    A task that runs again gives the same ids; those of neighbours differ in a digit or two, so they take little room.
    """
    prefix = uuid.uuid4().hex[:15]
    number = F.lower(F.hex(F.monotonically_increasing_id() + F.lit(-(1 << 63))))  # the highest bit is the variant's
    return F.concat(F.lit(f"{prefix[:8]}-{prefix[8:12]}-8{prefix[12:]}-"), F.substring(number, 1, 4), F.lit("-"), F.substring(number, 5, 12))


def append_rows(rows: DataFrame, path: str) -> None:
    """Append rows to the long table, partitioned by entity type and version date.

    Rows get their row id here, in the writing tasks, which count them up (see ``_row_id``). The rebalance hint gathers the rows of a
    partition into few files and lets adaptive execution split a partition that holds too much. The content's
    digest, where the rows have none yet, and what else they lack is made there too: digests are random, so a
    shuffle does not compress them.
    """
    dated = rows.withColumn("version_date", version_date(F.col("version")))
    placed = dated.hint("rebalance", "entity_type", "version_date")
    if "content_digest" not in rows.columns:
        placed = placed.withColumn("content_digest", content_digest(F.col("content")))
    missing = [f for f in ROWS if f.name not in (*placed.columns, "row_id")]
    complete = placed.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else placed
    # sorted by id within a folder, and with a Bloom filter of ids, so that a look-up of few ids skips row groups
    ordered = complete.sortWithinPartitions("entity_type", "version_date", "entity_id")
    with_id = ordered.withColumn("row_id", _row_id()).select(*ROWS.fieldNames())
    bloom = {"parquet.bloom.filter.enabled#entity_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    with_id.write.options(**bloom, compression=STORED).mode("append").partitionBy("entity_type", "version_date").parquet(path)


def append_tombstones(tombstones: DataFrame, path: str) -> None:
    """Tombstones lie in a folder per type, so reading one type's live rows reads only its own."""
    tombstones.select(*TOMBSTONES.fieldNames()).write.mode("append").partitionBy("entity_type").parquet(path)


def copy_by_type(rows: DataFrame, path: str, columns: Iterable[str] | None = None) -> None:
    """All rows as one table with a folder per entity type.

    Rows stay in the tasks that read them: a store lies by type already, so each task has few types, and no
    content crosses the network.
    """
    chosen = rows.select(*columns) if columns else rows
    chosen.write.mode("overwrite").partitionBy("entity_type").parquet(path)
