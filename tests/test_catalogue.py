"""The staging catalogue: bounded batches, one rule for hidden files, scans and checks that start from it."""

import json
import os

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.checks import missing_directories
from strandline.operators.documents import no_match_warnings
from strandline.schemas import JSON_SCHEMAS
from strandline.sinks import writers
from strandline.sources import catalogue as C
from strandline.sources import staging
from tests.conftest import values
from tests.staging import SCHEMAS, V1, links, process_link, schema, write_area


@pytest.fixture
def area(folder, put):
    write_area(put)
    for i in range(11):
        put(f"area/metadata/cell_line/more{i:02}_{V1}.json", {"describedBy": schema("any"), "n": i})
        put(f"area/links/more{i:02}_{V1}_proj1.json", links(process_link()))
    put(f"area/links/sub/deep_{V1}_proj1.json", links())
    put(f"area/metadata/cell_line/void_{V1}.json", "")
    put("area/metadata/stray_1.json", {})
    put("area/metadata/cell_line/notes.txt", "not a document")
    for name in ("_hidden_1.json", ".hidden_1.json"):
        put(f"area/metadata/project/{name}", {"a": 1})
        put(f"area/metadata/cell_line/{name}", "")
        put(f"area/metadata/_folder/{name}x", {})
    return f"{folder}/area"


def test_batches_are_bounded_and_hold_every_file(spark, area, monkeypatch):
    sizes = []
    write = C._Batches.write
    monkeypatch.setattr(C._Batches, "write", lambda self, rows: (sizes.append(len(rows)), write(self, rows)))
    found = C.build_catalogue(spark, [area, f"{area}/", f"{area}-absent"], batch=4)
    whole = C.build_catalogue(spark, [area], walkers=1)
    assert max(sizes[:-2]) == 4 and values(found) == values(whole) and found.count() == 35
    assert values(found.filter("top is null or entity_type is null"), "top", "entity_type", "file_name") == [("metadata", None, "stray_1.json")]
    assert found.filter("file_name like '%hidden%' or top = 'data'").count() == 0
    assert values(found.filter("file_path like '%/sub/%'"), "top", "entity_type", "file_size") == [("links", "links", len(json.dumps(links(), indent=2)))]
    narrowed = C.build_catalogue(spark, [area], ("metadata", "links"), ["project"])
    assert values(narrowed.groupBy("top", "entity_type").count()) == [("links", "links", 13), ("metadata", "project", 1)]


def test_scans_of_any_limit_read_the_same(spark, area):
    want = values(staging.read_documents(spark, [area]))
    assert len(want) == 33 and sum(row[4] == "" for row in want) == 1
    for limit in (4, 20):
        batches = list(staging.document_batches(spark, [area], limit=limit))
        assert all(batch.count() <= limit for batch in batches)
        assert values(staging.read_documents(spark, [area], limit=limit)) == want
    catalogue = C.build_catalogue(spark, [area])
    assert values(staging.read_documents(spark, [area], catalogue=catalogue)) == want
    assert values(staging.read_documents(spark, [area], skip_empty=True, limit=7)) == [row for row in want if row[4] != ""]
    assert values(staging.match_files(spark, [area])) == sorted(row[:4] + row[5:] for row in want)


def test_listing_and_checks_open_no_document(spark, area, monkeypatch):
    def unread(*_: object) -> DataFrame:
        raise AssertionError("a document is opened")

    monkeypatch.setattr(staging, "_scan", unread)
    catalogue = C.build_catalogue(spark, [area])
    asked = spark.createDataFrame([(area,), (f"{area}-absent",)], "area string")
    warnings = no_match_warnings(staging.match_files(spark, [area], catalogue=catalogue), asked)
    assert warnings.filter(F.col("message").contains(f"{area}/")).count() == 32 - 9
    files, unnamed = staging.inventory(spark, [area], catalogue)
    assert (files.count(), unnamed.count()) == (34, 1)
    tops = staging.top_level(spark, [area, f"{area}-absent"], catalogue)
    assert values(tops) == values(staging.top_level(spark, [area, f"{area}-absent"]))
    assert missing_directories(tops, asked).count() == 4


def test_preprocessing_in_batches(spark, area, monkeypatch):
    from strandline.plans import preprocess as P

    known = spark.createDataFrame(SCHEMAS, JSON_SCHEMAS)
    whole = P.preprocess(spark, [area], known)
    monkeypatch.setattr(C, "READ_BATCH", 4)
    parts = P.preprocess(spark, [area], known)
    for name in ("rows", "requests", "errors", "warnings"):
        assert values(getattr(parts, name)) == values(getattr(whole, name)), name


def test_local_files_are_listed_and_read_without_the_jvm(spark, area, monkeypatch):
    """A call into the JVM, or a path in a scan, for each file took a millisecond or more."""
    want = values(staging.read_documents(spark, [area]))
    files = C.build_catalogue(spark, [area], ("metadata", "descriptors", "links")).filter("file_size > 0")
    scanned = values(staging._scan(spark, [area], [row.file_path for row in staging._documents_in(files, staging.KINDS, None).collect()]))
    assert sorted(scanned) == [row for row in want if row[4] != ""]

    def refused(*_: object, **__: object) -> DataFrame:
        raise AssertionError("files are scanned path by path")

    monkeypatch.setattr(staging, "_scan", refused)
    monkeypatch.setattr(staging, "TASK_FILES", 3)
    monkeypatch.setattr(staging, "OPEN_BYTES", 10)
    assert values(staging.read_documents(spark, [area], limit=7)) == want


def test_single_files_are_spread_over_tasks(spark, folder, monkeypatch):
    monkeypatch.setattr(writers, "FILES_PER_TASK", 4)
    writers.write_single_files(spark.range(21).selectExpr("id", "if(id = 3, null, 'é') AS name"), f"{folder}/single", "entity_1")
    names = os.listdir(f"{folder}/single")
    assert len(names) == 21 and len({name.split("-")[1] for name in names}) > 1 and all(name.startswith("entity_1-") for name in names)
    assert values(spark.read.json(f"{folder}/single")) == values(spark.range(21).selectExpr("id", "if(id = 3, null, 'é') AS name"))
