"""A stored list of the files of staging areas, made in bounded batches; scans and checks start from it.

Folders are listed through the file system's iterators, which fetch page by page, by several threads of the
driver; local or mounted ones by the operating system's, without a call into the JVM for each file. Whenever a batch of files is full it is appended to the stored table, so the driver never holds more than
one batch, however many files an area or a single folder has. Names that Spark's scans hide (with a leading
underscore or dot) are left out here too, so that a list and a scan of the same folder agree.
"""

from __future__ import annotations

import os
import threading
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Row as SparkRow
from pyspark.sql import functions as F

from strandline.schemas import CATALOGUE, LINKS
from strandline.session import LANDED, work_path

LIST_BATCH = 50_000  # files whose names the driver holds while listing
READ_BATCH = 50_000  # files that one scan opens; its file index is the driver's
WALKERS = 8  # folders listed at the same time

Row = tuple[str, str | None, str | None, str, str, int]


def hidden(name: str) -> bool:
    """Is this a name that Spark's scans pass over?"""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


class _Batches:
    """Gathers rows of any thread and appends each full batch to the table."""

    def __init__(self, spark: SparkSession, path: str, size: int):
        self.spark, self.path, self.size = spark, path, size
        self.rows: list[Row] = []
        self.lock = threading.Lock()
        self.write([])  # a table without rows can be read as well

    def add(self, row: Row) -> None:
        with self.lock:
            self.rows.append(row)
            if len(self.rows) >= self.size:
                self.flush()

    def flush(self) -> None:
        if self.rows:
            self.write(self.rows)
            self.rows = []

    def write(self, rows: list[Row]) -> None:
        self.spark.createDataFrame(rows, CATALOGUE).coalesce(1).write.mode("append").parquet(self.path)


def _absent(error: Py4JJavaError) -> bool:
    return error.java_exception.getClass().getSimpleName() == "FileNotFoundException"


def _listed_here(folder: str, path: str) -> Iterator[tuple[str, str, bool, int]]:
    """The same for a folder of the driver's own file system."""
    try:
        with os.scandir(path) as entries:
            for entry in entries:
                try:
                    is_folder = entry.is_dir()
                    size = 0 if is_folder else entry.stat().st_size
                except FileNotFoundError:  # removed meanwhile, or a link to nothing
                    continue
                yield entry.name, f"{folder}/{entry.name}", is_folder, size
    except FileNotFoundError:
        return


def _listed(spark: SparkSession, path: str) -> Iterator[tuple[str, str, bool, int]]:
    """Name, path, whether a folder, and size of what lies in a folder, page by page; an absent folder holds nothing."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    whole = system.makeQualified(location)
    if whole.toUri().getScheme() == "file" and not os.path.isfile(whole.toUri().getPath()):
        yield from _listed_here(whole.toString().rstrip("/"), whole.toUri().getPath())
        return
    try:
        found = system.listStatusIterator(location)
        more = found.hasNext()
    except Py4JJavaError as error:
        if _absent(error):
            return
        raise
    while more:
        status = found.next()
        place = status.getPath()
        yield place.getName(), place.toString(), status.isDirectory(), status.getLen()
        more = found.hasNext()


def _walk(visits: Iterable[tuple], visit: Callable[..., Iterator[tuple]], walkers: int) -> None:
    """Call `visit` for each of the visits and for those that it finds, in a bounded number of threads."""
    todo: deque[Future] = deque()
    with ThreadPoolExecutor(walkers) as pool:

        def run(*where: object) -> None:
            for further in visit(*where):
                todo.append(pool.submit(run, *further))

        for where in visits:
            todo.append(pool.submit(run, *where))
        while todo:
            todo.popleft().result()


def build_catalogue(
    spark: SparkSession, areas: Sequence[str], tops: Sequence[str] | None = None, entity_types: Sequence[str] | None = None,
    path: str | None = None, batch: int = LIST_BATCH, walkers: int = WALKERS,
) -> DataFrame:
    """The ``CATALOGUE`` table of all files below the areas, stored at ``path`` or in the shared folder.

    ``tops`` names the top-level folders to list, by default all but ``data``, which holds by far the most files
    and is of no use here; ``entity_types`` narrows those below them, but not links. ``top`` is null for a file
    directly in an area, ``entity_type`` for one that lies in no folder of a type. Absent areas have no files.
    """
    where = path or work_path(spark, "catalogue")
    found = _Batches(spark, where, batch)
    types = set(entity_types) if entity_types is not None else None

    def visit(area: str, folder: str, steps: tuple[str, ...]) -> Iterator[tuple]:
        for name, place, is_folder, size in _listed(spark, folder):
            if hidden(name):
                continue
            if is_folder:
                if not steps and (name == "data" if tops is None else name not in tops):
                    continue
                if len(steps) == 1 and types is not None and steps[0] != LINKS and name not in types:
                    continue
                yield area, place, (*steps, name)
            elif steps or tops is None:
                # below metadata and descriptors there is a folder per type; links have the one type
                kind = LINKS if steps[:1] == (LINKS,) else steps[1] if len(steps) > 1 else None
                if types is None or kind == LINKS or kind in types:
                    found.add((area, steps[0] if steps else None, kind, name, place, size))

    _walk([(area, area, ()) for area in dict.fromkeys(area.rstrip("/") for area in areas)], visit, walkers)
    found.flush()
    if path is None:
        LANDED.append(where)
    return spark.read.schema(CATALOGUE).parquet(where)


def file_batches(files: DataFrame, limit: int | None = None) -> Iterator[list[SparkRow]]:
    """Files to open, batch by batch, with at most ``limit`` files each; the driver holds one batch of them."""
    limit = READ_BATCH if limit is None else limit
    rows = files.select(*CATALOGUE.fieldNames()).orderBy("file_path").toLocalIterator()
    while run := list(islice(rows, limit)):
        yield run


def scan_batches(files: DataFrame, limit: int | None = None) -> Iterator[list[str]]:
    """Paths to scan, batch by batch, with at most ``limit`` files each.

    Folders of a type (or of links) are scanned whole while they have few files, together up to the limit; a
    larger one is read file by file in runs of paths. The driver holds one batch of paths, and the counts of the
    folders are streamed.
    """
    limit = READ_BATCH if limit is None else limit
    typed = F.when(F.col("top") == LINKS, F.col("top")).otherwise(F.concat_ws("/", "top", "entity_type"))
    rooted = files.withColumn("folder", F.concat_ws("/", "area", typed))
    held: list[str] = []
    n_held = 0
    counts = rooted.groupBy("folder").agg(F.count(F.lit(1)).alias("n")).orderBy("folder")
    for row in counts.toLocalIterator():
        if row.n > limit:
            run: list[str] = []
            for file in rooted.filter(F.col("folder") == row.folder).select("file_path").orderBy("file_path").toLocalIterator():
                run.append(file.file_path)
                if len(run) == limit:
                    yield run
                    run = []
            if run:
                yield run
            continue
        if n_held + row.n > limit:
            yield held
            held, n_held = [], 0
        held.append(row.folder)
        n_held += row.n
    if held:
        yield held
