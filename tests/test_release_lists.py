"""Jobs around a release, end to end on small inputs."""

import pytest

from conftest import values
from staging import V1, V2, links, process_link, write_area
from strandline.plans import release_lists as L
from strandline.plans.load import load
from strandline.plans.store import Store
from test_load import staged

UUIDS = [f"0b1c2d3e-4f50-4a6b-9c7d-{i:012x}" for i in range(3)]


def test_intake_to_manifests(spark, folder, put):
    roots = spark.createDataFrame([("EBI", "gs://one/prod")], "institution string, root string")
    path = put("intake.csv", "".join(f"ebi,{u},{'no' if i else 'yes'}\n" for i, u in enumerate(UUIDS)))
    lines = L.write_release_manifests(spark, path, roots, "r7", f"{folder}/out", public_only=True)
    assert values(lines) == [(f"gs://one/prod/{u}", "r7_a_manifest") for u in UUIDS[1:]]
    assert values(spark.read.text(f"{folder}/out/manifest=r7_a_manifest")) == [(f"gs://one/prod/{u}",) for u in UUIDS[1:]]


def test_outdated_files(spark, folder, put):
    write_area(put)
    put(f"area/metadata/project/proj1_{V2}.json", {})
    old = L.write_outdated_files(spark, [f"{folder}/area"], f"{folder}/old")
    assert [row.blob.split("/")[-1] for row in old.collect()] == [f"proj1_{V1}.json"]
    assert values(spark.read.text(f"{folder}/old")) == values(old, "blob")


def test_project_list(spark, folder, put):
    write_area(put)
    put(f"area/links/links2_{V1}_proj2.json", links(process_link(inputs=("gone",))))
    store = Store(spark, f"{folder}/store")
    load(staged(spark, f"{folder}/area", store), store)
    report = L.check_project_list(store, put("list.csv", "proj1,q\nproj2,\nproj3,\n"))
    assert values(report, "project_id", "n_missing", "verified") == [("proj1", 0, True), ("proj2", 1, False), ("proj3", 0, False)]
    with pytest.raises(L.UnverifiedProjects, match="proj2"):
        L.require_projects(report)
    L.require_projects(report.filter("project_id = 'proj1'"))


def test_inventories(spark, folder):
    names = [f"atlas_prod_{UUIDS[0].replace('-', '')}__20200101_20210101_r7", "other_r6"]
    snapshots = spark.createDataFrame([(str(i), n, "p", "2021-01-01T00:00:00Z") for i, n in enumerate(names)], "id string, name string, data_project string, created_date string")
    policies = spark.createDataFrame([("0", True)], "id string, public boolean")
    L.write_snapshot_inventory(snapshots, policies, "r7", f"{folder}/list")
    assert values(spark.read.option("sep", "\t").option("header", True).csv(f"{folder}/list"), "name", "public_flag") == [(names[0], "Y")]
    projects = spark.createDataFrame([(u,) for u in UUIDS[:2]], "project_id string")
    found = L.write_released_projects(projects, snapshots.withColumnRenamed("name", "n").selectExpr("id", "concat(n, '_r7_') as name"), "atlas_prod", "r7", f"{folder}/table")
    assert values(found, "project_id", "found") == [(UUIDS[0], True), (UUIDS[1], False)]
