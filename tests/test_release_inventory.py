import pytest

from conftest import values
from strandline.operators import checks, inventory, release
from strandline.sinks import writers
from strandline.sources.manifests import read_intake, read_project_list, read_release_manifest
from strandline.sources.tables import read_json_rows, read_new_rows, read_staged

UUIDS = [f"0b1c2d3e-4f50-4a6b-9c7d-{i:012x}" for i in range(50)]


@pytest.fixture
def roots(spark):
    return spark.createDataFrame([("EBI", "gs://one/prod"), ("LATTICE", "gs://two/staging")], "institution string, root string")


def test_intake(spark, put, roots):
    path = put("intake.csv", f"ebi , {UUIDS[0]},Yes\n\nEBI,x/{UUIDS[0]}/y, NO\nLattice,{UUIDS[1]},yes\n")
    lines = read_intake(spark, path)
    assert lines.count() == 3
    assert values(release.intake_areas(lines, roots), "entry", "public") == [
        (f"gs://one/prod/{UUIDS[0]}", True), (f"gs://two/staging/{UUIDS[1]}", False)]
    tagged = release.intake_areas(lines, roots, release_tag="r1", ids_only=True)
    assert values(tagged, "entry") == [(f"{UUIDS[0]},r1",), (f"{UUIDS[1]},r1",), (f"x/{UUIDS[0]}/y,r1",)]


def test_intake_with_white_space_of_all_kinds(spark, put, roots):
    path = put("intake.csv", f"EBI\t, {UUIDS[0]}\t,no\t\n\u00a0lattice,\t{UUIDS[1]},\tYES\n")
    assert values(release.intake_areas(read_intake(spark, path), roots), "entry", "public") == [
        (f"gs://one/prod/{UUIDS[0]}", True), (f"gs://two/staging/{UUIDS[1]}", False)]


@pytest.mark.parametrize("line,complaint", [
    (f"nowhere,{UUIDS[0]},no", "unknown institution"), ("EBI,none,no", "exactly one project UUID"),
    (f"EBI,{UUIDS[0]}", "(?i)malformed"), (f"EBI,{UUIDS[0]},no,more", "(?i)malformed"),
])
def test_bad_intake_fails(spark, put, roots, line, complaint):
    with pytest.raises(Exception, match=complaint):
        release.intake_areas(read_intake(spark, put("intake.csv", line + "\n")), roots).collect()


def test_manifests_of_twenty(spark, folder):
    entries = spark.createDataFrame([(u, i < 30) for i, u in enumerate(UUIDS)], "entry string, public boolean")
    everything = {}
    for entry, manifest in values(release.manifests(entries.unionByName(entries), "r1")):
        everything.setdefault(manifest, []).append(entry)
    assert everything == {"r1_a_manifest": UUIDS[:20], "r1_b_manifest": UUIDS[20:40], "r1_c_manifest": UUIDS[40:]}
    writers.write_manifests(release.manifests(entries, "r1", public_only=True), f"{folder}/m")
    assert spark.read.text(f"{folder}/m/manifest=r1_b_manifest").count() == 10


def test_positions_span_many_ranges(spark):
    keys = spark.range(5000).selectExpr("cast(id % 3000 as string) as k").repartition(7)
    expected = {k: i for i, k in enumerate(sorted(str(i) for i in range(3000)))}
    assert {row.k: row.position for row in release.numbered(keys, "k").collect()} == expected


def test_manifest_and_project_list(spark, put):
    assert values(read_release_manifest(spark, put("m.csv", "gs://a/b/\ngs://a/c\n"))) == [("gs://a/b",), ("gs://a/c",)]
    assert values(read_project_list(spark, put("p.csv", "p1,q\np2,\n"))) == [("p1", "q"), ("p2", None)]
    areas = spark.createDataFrame([(f"gs://a/{UUIDS[0]}",), ("gs://a/x",)], "area string")
    assert values(release.areas_without_project(areas)) == [("gs://a/x",)]


def test_snapshot_inventory(spark, folder):
    snapshots = spark.createDataFrame([
        ("2", "atlas_prod_b_r25", "g", "2023-01-02T03:04:05Z"), ("1", "atlas_prod_a_r25", "g", "2023-01-01T03:04:05Z"),
        ("3", "atlas_prod_c_r26", "g", "2023-01-03T03:04:05Z")], "id string, name string, data_project string, created_date string")
    policies = spark.createDataFrame([("1", True), ("2", False)], "id string, public boolean")
    found = inventory.snapshot_inventory(snapshots, policies, "r25")
    assert [(r.id, r.created_day, r.public_flag) for r in found.collect()] == [("1", "2023-01-01", "Y"), ("2", "2023-01-02", "N")]
    writers.write_tsv(found, f"{folder}/t")
    back = spark.read.option("sep", "\t").option("header", True).csv(f"{folder}/t")
    assert values(back, "name") == [("atlas_prod_a_r25",), ("atlas_prod_b_r25",)]


def test_released_projects(spark):
    projects = spark.createDataFrame([(u,) for u in UUIDS[:3]], "project_id string")
    name = lambda i, catalog: f"atlas_prod_{UUIDS[i].replace('-', '')}__20200101_{catalog}_20210101"
    snapshots = spark.createDataFrame([(name(0, "r2"),), (name(0, "r2") + "_later",), (name(1, "r1"),)], "name string")
    assert values(inventory.released_projects(projects, snapshots, "atlas_prod", "r2"), "project_id", "snapshot", "found") == [
        (UUIDS[0], name(0, "r2"), True), (UUIDS[1], None, False), (UUIDS[2], None, False)]


def test_missing_directories(spark):
    found = spark.createDataFrame([("a", "data"), ("a", "links"), ("b", "data")], "area string, top string")
    areas = spark.createDataFrame([("a",), ("c",)], "area string")
    assert values(checks.missing_directories(found, areas)) == sorted(
        [("a", "descriptors"), ("a", "metadata"), *[("c", t) for t in ("data", "descriptors", "links", "metadata")]])


def test_required_values_and_malformed_lines(spark, put):
    good = put("good.json", '{"project_id":"12","version":"2021-01-01T00:00:00.5Z","content":"{}"}\n')
    row = read_staged(spark, good, "project").first()
    assert (row.project_id, str(row.version)) == ("12", "2021-01-01 00:00:00.500000")
    with pytest.raises(Exception, match="required value content"):
        read_staged(spark, put("missing.json", '{"project_id":"1","version":"2021-01-01T00:00:00Z"}\n'), "project").collect()
    with pytest.raises(Exception, match="(?i)malformed"):
        read_staged(spark, put("bad.json", '{"project_id":\n'), "project").collect()
    with pytest.raises(Exception):
        read_staged(spark, put("version.json", '{"project_id":"1","version":"yesterday","content":"{}"}\n'), "project").collect()
    files = put("file.json", '{"image_file_id":"1","version":"2021-01-01T00:00:00Z","content":"{}","descriptor":"{}"}\n')
    assert read_new_rows(spark, files, "image_file").first().file_id is None
    with pytest.raises(Exception, match="required value crc32c"):
        read_staged(spark, files, "image_file").collect()


def test_exports(spark, folder):
    frame = spark.createDataFrame([("1", None), ("2", "f")], "row_id string, file_id string")
    stored = writers.replace_table(frame, f"{folder}/t")
    assert writers.export_json(stored, f"{folder}/json") == 2
    assert values(read_json_rows(spark, f"{folder}/json", frame.schema)) == [("1", None), ("2", "f")]
    import os

    nothing = writers.replace_table(frame.filter("row_id = '9'"), f"{folder}/none")
    assert writers.export_json(nothing, f"{folder}/none-json") == 0 and not os.path.exists(f"{folder}/none-json")
    writers.write_ids(frame, "row_id", f"{folder}/ids")
    assert values(spark.read.text(f"{folder}/ids")) == [("1",), ("2",)]
