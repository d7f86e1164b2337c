"""Staging areas: folders with ``data/``, ``descriptors/``, ``links/`` and ``metadata/``."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from strandline.functions.names import base_name, parent
from strandline.schemas import CATALOGUE, DOCUMENTS, LINKS, TOP_LEVEL_DIRS
from strandline.session import land_batches
from strandline.sources.catalogue import WALKERS, build_catalogue, file_batches, scan_batches

KINDS = ("metadata", "descriptors", "links")
TASK_FILES = 1000  # files that one task opens itself
OPEN_BYTES = 8 << 20  # texts that such a task holds at once, beyond the last one


def _existing(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Those of the paths that exist; asks the file system, reads nothing."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    kept = []
    for path in paths:
        location = jvm.org.apache.hadoop.fs.Path(path)
        if location.getFileSystem(conf).exists(location):
            kept.append(path)
    return kept


def moment(spark: SparkSession, path: str) -> int:
    """When a file was written, in milliseconds."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(location).getModificationTime()


def _qualified(spark: SparkSession, path: str) -> str:
    """The path as file listings spell it, scheme included."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(location).toString()


def _decoded(file_path: Column) -> Column:
    """File paths come percent-encoded; a plus sign in them stands for itself."""
    return F.url_decode(F.replace(file_path, F.lit("+"), F.lit("%2B")))


def _placed(spark: SparkSession, areas: Sequence[str], path: Column, tops: Sequence[str]) -> tuple[Column, Column]:
    """The area a file path lies in, as given by the caller, and the rest of the path below the area."""
    names = {_qualified(spark, area).rstrip("/"): area.rstrip("/") for area in areas}
    lookup = F.create_map(*[F.lit(text) for pair in names.items() for text in pair])
    # cut before each top-level folder name; the area is the first cut that gives a known area
    pieces = F.split(path, f"/(?=(?:{'|'.join(tops)})(?:/|$))")
    cuts = F.sequence(F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(1)))
    heads = F.transform(cuts, lambda n: F.concat_ws("/", F.slice(pieces, F.lit(1), n)))
    head = F.get(F.filter(heads, lambda text: lookup[text].isNotNull()), F.lit(0))
    return F.coalesce(lookup[head], lookup[parent(path)]), F.substring(path, F.length(head) + 2, F.length(path))


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCUMENTS).withColumns({"file_path": F.lit("").cast("string"), "file_size": F.lit(0).cast("bigint")})


def _documents_in(catalogue: DataFrame, kinds: Sequence[str], entity_types: Sequence[str] | None) -> DataFrame:
    """The catalogue's ``.json`` files of some kinds and types; a file that lies in no folder of a type is none."""
    found = catalogue.filter(F.col("top").isin(*kinds) & F.col("entity_type").isNotNull() & F.col("file_name").endswith(".json"))
    return found if entity_types is None else found.filter((F.col("top") == LINKS) | F.col("entity_type").isin(*entity_types))


def _scan(spark: SparkSession, areas: Sequence[str], paths: Sequence[str]) -> DataFrame:
    """The documents in some folders or files, as ``read_documents`` gives them."""
    texts = spark.read.text(list(paths), wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.json")
    scan = texts.select(_decoded(F.col("_metadata.file_path")).alias("file_path"), F.col("_metadata.file_size").alias("file_size"), "value")
    area, below = _placed(spark, areas, F.col("file_path"), KINDS)
    located = scan.select(area.alias("area"), F.split(below, "/").alias("steps"), "file_path", "file_size", "value")
    kind = F.col("steps")[0]
    # metadata and descriptors have a folder per type; a file lying beside those folders has no type
    folder = F.when(F.size("steps") > 2, F.col("steps")[1])
    return located.select(
        "area", kind.alias("kind"), F.when(kind == "links", F.lit(LINKS)).otherwise(folder).alias("entity_type"),
        base_name(F.col("file_path")).alias("file_name"), "value", "file_path", "file_size",
    ).filter("entity_type is not null")


def _read_here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of the catalogue with the bytes of their files."""
    for batch in batches:
        start, values, size = 0, [], 0
        for place, path in enumerate(batch.column("file_path").to_pylist(), 1):
            with open(path.removeprefix("file:"), "rb") as file:
                values.append(file.read())
            size += len(values[-1])
            if size > OPEN_BYTES or place == batch.num_rows:
                read = pa.array(values, pa.large_binary())
                yield pa.RecordBatch.from_arrays([*batch.slice(start, place - start).columns, read], [*batch.schema.names, "read"])
                start, values, size = place, [], 0


def _scan_here(spark: SparkSession, files: Sequence[Row]) -> DataFrame:
    """The documents in files of a local or mounted file system, opened by the tasks; as ``_scan`` gives them.

    Spark's scan of paths takes about a millisecond a file to list them and as long again to open one.
    """
    listed = spark.createDataFrame(spark.sparkContext.parallelize(files, max(1, -(-len(files) // TASK_FILES))), CATALOGUE)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CATALOGUE)
    return listed.mapInArrow(_read_here, f"{fields}, read binary").select(
        "area", F.col("top").alias("kind"), "entity_type", "file_name", F.col("read").cast("string").alias("value"), "file_path", "file_size")


def document_batches(
    spark: SparkSession,
    areas: Sequence[str],
    kinds: Sequence[str] = KINDS,
    entity_types: Sequence[str] | None = None,
    catalogue: DataFrame | None = None,
    skip_empty: bool = False,
    limit: int | None = None,
) -> Iterator[DataFrame]:
    """The documents of the areas in frames of at most ``limit`` files each (``catalogue.READ_BATCH``), the zero-byte ones apart."""
    listed = build_catalogue(spark, areas, kinds, entity_types) if catalogue is None else catalogue
    wanted = _documents_in(listed, kinds, entity_types)
    filled = wanted.filter("file_size > 0")
    if all(_qualified(spark, area).startswith("file:") for area in areas):
        for files in file_batches(filled, limit):
            yield _scan_here(spark, files)
    else:
        for paths in scan_batches(filled, limit):
            yield _scan(spark, areas, paths)
    if not skip_empty:
        # Spark leaves them out of every scan
        yield wanted.filter("file_size = 0").select(
            "area", F.col("top").alias("kind"), "entity_type", "file_name", F.lit("").alias("value"), "file_path", "file_size")


def read_documents(
    spark: SparkSession,
    areas: Sequence[str],
    kinds: Sequence[str] = KINDS,
    entity_types: Sequence[str] | None = None,
    catalogue: DataFrame | None = None,
    skip_empty: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """All ``.json`` documents of the areas: the ``DOCUMENTS`` columns plus path and size.

    Absent folders give no rows. Zero-byte files, which Spark leaves out of every scan, are rows with an empty text
    unless ``skip_empty`` is set. ``entity_types`` narrows the scan to the folders of those types. The files are
    those of a ``catalogue`` of the areas, which is made if none is given. Up to ``limit`` of them are one scan,
    which reads when the frame is used; beyond that they are read batch by batch into a table, so that the driver
    holds the paths of one batch only.
    """
    batches = document_batches(spark, areas, kinds, entity_types, catalogue, skip_empty, limit)
    scans = list(islice(batches, 2 if skip_empty else 3))
    if len(scans) > (1 if skip_empty else 2):
        return land_batches(chain(scans, batches), "scanned")
    return reduce(DataFrame.unionByName, scans, _nothing(spark))


def match_files(spark: SparkSession, areas: Sequence[str], kinds: Sequence[str] = KINDS, catalogue: DataFrame | None = None) -> DataFrame:
    """Documents by area, kind and entity type, zero-byte ones too; no file is opened."""
    listed = build_catalogue(spark, areas, kinds) if catalogue is None else catalogue
    return _documents_in(listed, kinds, None).select("area", F.col("top").alias("kind"), "entity_type", "file_name", "file_path", "file_size")


def read_descriptors(spark: SparkSession, areas: Sequence[str], entity_types: Sequence[str], catalogue: DataFrame | None = None) -> DataFrame:
    """Descriptors of the given file types in all areas."""
    found = read_documents(spark, areas, kinds=("descriptors",), entity_types=entity_types, catalogue=catalogue)
    return found.select("area", "entity_type", "file_name", F.col("value").alias("descriptor"))


def has_file(spark: SparkSession, path: str, at_least: int = 0) -> bool:
    """Is there a file of at least so many bytes below the path? Stops listing at the first one."""
    if not _existing(spark, [path]):
        return False
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(location, True)
    while files.hasNext():
        if files.next().getLen() >= at_least:
            return True
    return False


def has_any_data(spark: SparkSession, path: str) -> bool:
    """Is any file below the path longer than zero bytes?"""
    return has_file(spark, path, at_least=1)


def inventory(spark: SparkSession, areas: Sequence[str], catalogue: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Files outside ``data/`` as ``area, top, blob, path, entity, version``, and the ones with other names.

    Entity and version are the first two underscore-separated parts of the file name, so the version
    of a plain name still ends in ``.json``. Names without an underscore go to the second frame.
    """
    listed = build_catalogue(spark, areas) if catalogue is None else catalogue
    parts = F.split("file_name", "_")
    files = listed.select(
        "area", "top", F.col("file_path").alias("blob"), parent(F.col("file_path")).alias("path"),
        F.get(parts, F.lit(0)).alias("entity"), F.get(parts, F.lit(1)).alias("version"),
    )
    return files.filter("version is not null"), files.filter("version is null")


def top_level(spark: SparkSession, areas: Sequence[str], catalogue: DataFrame | None = None) -> DataFrame:
    """``area`` and each of the well-known folders that holds a file.

    With a ``catalogue`` only ``data``, which it leaves out, is looked at. Listing a folder stops at its first
    file, and folders are listed by several threads.
    """
    tops = TOP_LEVEL_DIRS if catalogue is None else [top for top in TOP_LEVEL_DIRS if top not in KINDS]
    asked = [(area, top) for area in areas for top in tops]
    with ThreadPoolExecutor(WALKERS) as pool:
        held = pool.map(lambda place: has_file(spark, "/".join((place[0].rstrip("/"), place[1]))), asked)
        found = spark.createDataFrame([place for place, is_held in zip(asked, held, strict=True) if is_held], "area string, top string")
    if catalogue is None:
        return found
    return found.unionByName(catalogue.filter(F.col("top").isin(*KINDS)).select("area", "top").distinct())
