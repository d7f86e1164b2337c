"""Loads from staged documents into a store, end to end."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import values
from staging import SCHEMAS, V1, V2, descriptor, schema, write_area
from strandline.operators.files import NullFileIdError
from strandline.operators.rows import project_rows, rows_with_ids, tables_with_column, union_of_types, without_rows
from strandline.plans import check as C
from strandline.plans import preprocess as P
from strandline.plans import release as V
from strandline.plans.load import inject_file_ids, load, resolve_stored_file_ids, staged_rows
from strandline.plans.snapshot import create_snapshot, valid_snapshot_name
from strandline.plans.store import Store
from strandline.schemas import JSON_SCHEMAS, typed_view


def staged(spark, area, store, with_history=True):
    schemas = spark.createDataFrame(SCHEMAS, JSON_SCHEMAS)
    result = P.preprocess(spark, [area], schemas)
    if with_history:
        done = result.requests.select(
            F.lit("succeeded").alias("state"), "target_path", F.lit("c1").alias("checksum_crc32c"),
            F.concat(F.lit("id-of-"), "file_id").alias("file_id"))
        store.add_history(done)
    return inject_file_ids(staged_rows(result.rows), store)


def test_load_reload_and_newer_version(spark, folder, put):
    write_area(put)
    store = Store(spark, f"{folder}/store")
    first = load(staged(spark, f"{folder}/area", store), store)
    assert first.appended == {t: 1 for t in (
        "project", "analysis_process", "cell_line", "analysis_protocol", "analysis_file", "supplementary_file", "links")}
    assert first.outdated == {}
    live = store.live()
    assert values(live.filter("entity_type = 'analysis_file'"), "file_id") == [("id-of-fid1",)]
    assert values(live.filter("entity_type = 'supplementary_file'"), "file_id") == [(None,)]
    assert live.select("row_id").distinct().count() == 7
    assert typed_view(live, "analysis_file").columns == ["analysis_file_id", "version", "file_id", "content", "descriptor"]

    again = load(staged(spark, f"{folder}/area", store, with_history=False), store)
    assert again.appended == {} and store.raw().count() == 7

    put(f"update/metadata/project/proj1_{V2}.json", {"describedBy": schema("any"), "title": "new"})
    newer = load(staged(spark, f"{folder}/update", store), store)
    assert newer.appended == {"project": 1} and newer.outdated == {"project": 1}
    assert values(store.live().filter("entity_type = 'project'"), "version") == [(datetime(2021, 8, 6, 14, 35, 6, 273000),)]
    assert store.raw().count() == 8 and store.live().count() == 7

    # an old version is loaded again against live rows, not against all rows
    old = staged(spark, f"{folder}/area", store, with_history=False).cache()
    assert load(old, store, against="raw").appended == {}
    assert load(old, store, against="live").appended == {"project": 1}
    assert values(store.live().filter("entity_type = 'project'"), "version") == [(datetime(2021, 8, 6, 14, 35, 6, 273000),)]

    # checks, copies and snapshots of the loaded store
    counts = C.require_copy(store, "proj1").first()
    assert not counts.has_problems
    name = "atlas_dev_" + "a" * 32 + "__20210101_20210202"
    assert valid_snapshot_name(name, ["atlas"]) and not valid_snapshot_name("atlas_dev_20201120_q__20210701_r", ["atlas"])
    copy = create_snapshot(store, f"{folder}/snapshots", name, ["atlas"])
    assert copy.count() == 7
    with pytest.raises(ValueError):
        create_snapshot(store, f"{folder}/snapshots", "bad", ["atlas"])
    assert resolve_stored_file_ids(store).filter("file_id = 'id-of-fid1'").count() == 1

    # rows of the project, and their removal
    own = project_rows(store.live(), "proj1")
    assert values(own, "table_name") == [("links",), ("project",)]
    store.soft_delete(own)
    counts = C.check(store).first()
    assert (counts.empty_links_count, counts.empty_projects_count, counts.has_problems) == (1, 1, True)


def test_load_from_exports_and_control_file(spark, folder, put):
    from strandline.plans.load import read_exports
    from strandline.sinks.writers import write_ids

    write_area(put)
    store = Store(spark, f"{folder}/store")
    direct = staged(spark, f"{folder}/area", store)
    P.run(spark, [f"{folder}/area"], spark.createDataFrame(SCHEMAS, JSON_SCHEMAS), f"{folder}/out")
    columns = ("entity_type", "entity_id", "version", "content", "project_id", "file_id", "descriptor")
    exported = inject_file_ids(read_exports(spark, f"{folder}/out"), store)
    assert values(exported, *columns) == values(direct, *columns)
    assert read_exports(spark, f"{folder}/nothing").count() == 0
    load(exported, store)
    write_ids(store.raw().filter("entity_type = 'links'"), "row_id", f"{folder}/links-ids")
    store.soft_delete_listed(f"{folder}/links-ids", "links")
    assert store.live().count() == 6 and store.live().filter("entity_type = 'links'").count() == 0


def test_null_file_id_aborts(spark, folder, put):
    write_area(put)
    store = Store(spark, f"{folder}/store")
    with pytest.raises(NullFileIdError):
        staged(spark, f"{folder}/area", store, with_history=False)
    assert store.raw().count() == 0


def test_release_verification(spark, folder, put):
    write_area(put)
    store = Store(spark, f"{folder}/store")
    load(staged(spark, f"{folder}/area", store), store)
    put(f"late/metadata/project/proj1_{V1}.json", {"title": "Ærø", "describedBy": schema("any")})
    put("late/metadata/cell_line/new1_2030-01-01T00:00:00Z.json", {"a": 1})
    put(f"broken/metadata/project/proj1_{V2}.json", {"describedBy": schema("any"), "title": "Ærø"})
    put(f"broken/metadata/cell_line/cell1_{V1}.json", {"describedBy": schema("any"), "cells": [1]})
    put(f"broken/descriptors/image_file/i_{V1}.json", descriptor("fid1", "a/b.csv", "c2"))
    put(f"broken/descriptors/image_file/j_{V1}.json", descriptor("fid1", "a/b.csv"))
    manifest = put("manifest.csv", "".join(f"{folder}/{a}/ \n" for a in ("area", "late", "broken", "empty")))
    report = V.verify(store, manifest, datetime(2022, 1, 1))
    assert values(report, "area", "staged", "loaded", "missing", "entities", "entity_errors", "has_errors") == sorted([
        (f"{folder}/area", 2, 1, 1, 7, 0, True),
        (f"{folder}/late", 0, 0, 0, 1, 0, False),
        (f"{folder}/broken", 2, 1, 1, 2, 2, True),
        (f"{folder}/empty", 0, 0, 0, 0, 0, False),
    ])
    with pytest.raises(V.ReleaseErrors):
        V.require_complete(report)


def test_problem_removal(spark, folder):
    store = Store(spark, f"{folder}/store")
    version = F.lit("2021-01-01T00:00:00Z").cast("timestamp")
    rows = spark.createDataFrame([
        ("project", "p1", None, None, None), ("project", "p1", None, None, None), ("project", "p1", None, None, None),
        ("links", "l1", "p1", None, None), ("links", "l2", "gone", None, None),
        ("sequence_file", "s1", None, None, "{}"), ("sequence_file", "s2", None, "f", "{}"), ("sequence_file", "s3", None, None, '{"drs_uri":1}'),
    ], "entity_type string, entity_id string, project_id string, file_id string, descriptor string")
    store.append(rows.withColumns({"version": version, "content": F.lit("{}")}))
    names = ["duplicates", "null_file_refs", "dangling_project_refs", "empty_links_count", "empty_projects_count", "has_problems"]
    assert values(C.check(store), *names) == [(2, 1, 1, 0, 0, True)]
    with pytest.raises(C.DatasetProblems):
        C.require_sound(C.check(store))
    assert values(C.remove_problems(store), *names) == [(2, 1, 0, 0, 0, True)]
    assert values(C.check(store), *names) == [(0, 0, 1, 0, 0, True)]
    assert store.live().count() == 5


def test_session_zone_is_checked(spark, folder):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError):
            Store(spark, folder)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_union_of_types_and_small_selections(spark):
    project = spark.createDataFrame([("p", "2021", "{}")], "project_id string, version string, content string")
    files = spark.createDataFrame([("s", "2021", "f", "{}", "{}")],
                                  "sequence_file_id string, version string, file_id string, content string, descriptor string")
    both = union_of_types({"project": project, "sequence_file": files})
    assert values(both, "entity_type", "entity_id", "project_id", "file_id") == [("project", "p", None, None), ("sequence_file", "s", None, "f")]
    assert tables_with_column({"project": project, "sequence_file": files}, "file_id") == ["sequence_file"]
    with pytest.raises(ValueError):
        union_of_types({"unknown": project})
    ids = spark.createDataFrame([("p",), ("zz",)], "entity_id string")
    assert values(rows_with_ids(both, ids, "entity_id", ["entity_type"]), "entity_id") == [("p",)]
    assert values(without_rows(both, ids, "entity_id")) == [("s",)]


def test_a_load_that_broke_off_after_its_append_is_completed(spark, folder, put):
    write_area(put)
    store = Store(spark, f"{folder}/store")
    load(staged(spark, f"{folder}/area", store), store)
    put(f"area/metadata/project/proj1_{V2}.json", {"describedBy": schema("any"), "title": "later"})
    again = staged(spark, f"{folder}/area", store)
    new_rows = again.filter(f"entity_type = 'project' and version = timestamp '{V2}'").drop("area", "crc32c")
    store.append(new_rows)  # and here it broke off
    assert store.live().filter("entity_type = 'project'").count() == 2
    result = load(again, store)
    assert result.appended == {} and result.outdated == {"project": 1}
    assert [row.content for row in store.live().filter("entity_type = 'project'").collect()] == [f'{{"describedBy":"{schema("any")}","title":"later"}}']


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from strandline.session import shared_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default)))
