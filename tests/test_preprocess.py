import json
import os

import pytest

from conftest import values
from staging import SCHEMAS, V1, descriptor, links, process_link, schema, write_area
from strandline.operators import documents as D
from strandline.plans import preprocess as P
from strandline.schemas import DOCUMENTS, JSON_SCHEMAS


@pytest.fixture
def schemas(spark):
    return spark.createDataFrame(SCHEMAS, JSON_SCHEMAS)


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), DOCUMENTS)


def reshape(spark, schemas, *rows, **options):
    return D.reshape(D.with_report(docs(spark, *rows), schemas, **options).cache())


def test_plain_document_becomes_row(spark, schemas):
    rows, _, _ = reshape(spark, schemas, ("p", "metadata", "project", "e-17_t-9.json", '{"colour": "green"}'))
    assert values(P.typed_json(rows, "project")) == [("e-17", "t-9", '{"colour":"green"}')]


def test_empty_document(spark, schemas):
    rows, _, _ = reshape(spark, schemas, ("p", "metadata", "project", "id_version.json", "{}"))
    assert values(P.typed_json(rows, "project")) == [("id", "version", "{}")]


@pytest.mark.parametrize("name", ["lane_2_part.7_r1.tsv", "plates/well_b/spots_q.txt"])
def test_file_document_joins_descriptor(spark, schemas, name):
    meta = {"file_core": {"file_name": name, "format": "csv", "file_provenance": {"crc32c": "0a9bff41"}}, "schema_type": "file"}
    desc = {"file_name": name, "file_id": "f-88", "file_version": "v", "crc32c": "0a9bff41", "schema_type": "file_descriptor"}
    rows, requests, _ = reshape(
        spark, schemas,
        ("shelf/nine", "metadata", "sequence_file", "123_456.json", json.dumps(meta, indent=1)),
        ("shelf/nine", "descriptors", "sequence_file", "123_456.json", json.dumps(desc, indent=1)),
    )
    tight = dict(separators=(",", ":"))
    assert values(P.typed_json(rows, "sequence_file")) == [
        ("123", "456", json.dumps(meta, **tight), "0a9bff41", json.dumps(desc, **tight))
    ]
    assert values(requests, "source_path", "target_path") == [
        (f"shelf/nine/data/{name}", f"/v1/f-88/0a9bff41/{name}")
    ]


def test_links_document(spark, schemas):
    text = '{ "schema_type": "link_bundle", "schema_version": "1.1.3", "links": [] }'
    rows, _, _ = reshape(spark, schemas, ("p", "links", "links", "123_456_789.json", text))
    assert values(P.typed_json(rows, "links")) == [
        ('{"schema_type":"link_bundle","schema_version":"1.1.3","links":[]}', "123", "456", "789")
    ]


def test_validation_changes_nothing(spark, schemas):
    body = {"place": {"label": "Zürich søndag"}, "sizes": {"steps": [712345678901]}, "describedBy": schema("none")}
    text = json.dumps(body, ensure_ascii=False, indent=4)
    rows, _, errors = reshape(spark, schemas, ("p", "metadata", "organoid", "a_1.json", text))
    assert json.loads(rows.first().content) == body
    assert "Zürich søndag" in rows.first().content and "712345678901" in rows.first().content
    assert values(errors, "errorType", "message") == [("SchemaValidationError", f"No schema found at {schema('none')}")]


def test_names_follow_the_split_rule(spark):
    named = D.with_entity_name(docs(spark, *[("p", "metadata", "project", n, "{}") for n in (
        "a_b.json", "a_b_.json", "_a.json", "a.json", "a_b_c.json", "___.json", "a_b.json.json", "a__b.json",
    )]))
    assert values(named, "file_name", "entity_id", "version") == [
        ("___.json", None, None), ("_a.json", "", "a"), ("a.json", None, None), ("a__b.json", None, None),
        ("a_b.json", "a", "b"), ("a_b.json.json", "a", "b.json"), ("a_b_.json", "a", "b"), ("a_b_c.json", None, None),
    ]


FAILURES = [
    ("descriptor without metadata", {"descriptors/analysis_file/afile1_t.json": descriptor("i", "n")}, 1,
     ("FileMismatchError", "metadata/analysis_file/afile1_t.json",
      "File is present in descriptors/analysis_file but not in metadata/analysis_file.")),
    ("metadata without descriptor", {"metadata/reference_file/rfile1_t.json": {"describedBy": schema("any")}}, 1,
     ("FileMismatchError", "descriptors/reference_file/rfile1_t.json",
      "File is present in metadata/reference_file but not in descriptors/reference_file.")),
    ("four-part links name", {"links/links1_t_project_1.json": links(process_link())}, 1,
     ("NoRegexPatternMatchError", "links/links1_t_project_1.json",
      "Error when finding links id, version, and project id from file.")),
    ("one-part name", {"metadata/analysis_process/aprocess1t.json": {"describedBy": schema("any")}}, 1,
     ("NoRegexPatternMatchError", "metadata/analysis_process/aprocess1t.json",
      "Error when finding entity id and version from file name.")),
    ("no describedBy", {"metadata/analysis_protocol/a_t.json": {"x": 1}}, 1,
     ("MissingPropertyError", "metadata/analysis_protocol/a_t.json", "File has no describedBy property.")),
    ("descriptor without name", {
        "metadata/analysis_file/a_t.json": {"describedBy": schema("any")},
        "descriptors/analysis_file/a_t.json": {k: v for k, v in descriptor("i", "n").items() if k != "file_name"}}, 2,
     ("MissingPropertyError", "descriptors/analysis_file/a_t.json", "File has no file_name property.")),
    ("descriptor without checksum", {
        "metadata/analysis_file/a_t.json": {"describedBy": schema("any")},
        "descriptors/analysis_file/a_t.json": {k: v for k, v in descriptor("i", "n").items() if k != "crc32c"}}, 2,
     ("MissingPropertyError", "descriptors/analysis_file/a_t.json", "File has no crc32c property.")),
    ("metadata against schema", {"metadata/analysis_protocol/a_t.json": {"describedBy": schema("protocol")}}, 1,
     ("SchemaValidationError", "metadata/analysis_protocol/a_t.json",
      f"Data in file does not conform to schema from {schema('protocol')}; #: required key [computational_method] not found")),
    ("links against schema", {"links/l_t_p.json": {"describedBy": schema("links"), "links": []}}, 1,
     ("SchemaValidationError", "links/l_t_p.json",
      f"Data in file does not conform to schema from {schema('links')}; #: required key [schema_type] not found")),
    ("descriptor against schema", {
        "metadata/reference_file/a_t.json": {"describedBy": schema("any")},
        "descriptors/reference_file/a_t.json": {k: v for k, v in descriptor("i", "n").items() if k != "file_version"}}, 1,
     ("SchemaValidationError", "descriptors/reference_file/a_t.json",
      f"Data in file does not conform to schema from {schema('descriptor')}; #: required key [file_version] not found")),
]


@pytest.mark.parametrize("case,files,n_errors,expected", FAILURES, ids=[f[0] for f in FAILURES])
def test_one_wrong_file(spark, schemas, folder, put, case, files, n_errors, expected):
    write_area(put)
    for path, body in files.items():
        put(f"area/{path}", body)
    area = f"{folder}/area"
    errors = P.preprocess(spark, [area], schemas).errors
    kind, path, message = expected
    assert (kind, f"{area}/{path}", path.split("/")[-1], message) in values(errors)
    assert errors.count() == n_errors
    with pytest.raises(P.DocumentErrors):
        P.require_no_errors(errors)


def test_sound_area_end_to_end(spark, schemas, folder, put):
    write_area(put)
    result = P.run(spark, [f"{folder}/area"], schemas, f"{folder}/out")
    assert result.errors.count() == 0
    # 26 metadata, 5 descriptor and the links pattern, less those matched
    assert result.warnings.count() == 26 + 5 + 1 - 6 - 2 - 1
    assert ("NoMatchWarning", f"{folder}/area/metadata/organoid/**.json had no matches") in values(result.warnings)
    requests = spark.read.json(f"{folder}/out/data-transfer-requests/analysis_file")
    assert values(requests, "source_path", "target_path") == [(f"{folder}/area/data/a/b.csv", "/v1/fid1/c1/a/b.csv")]
    # the externally hosted file is not requested
    assert not os.path.exists(f"{folder}/out/data-transfer-requests/supplementary_file")
    assert spark.read.json(f"{folder}/out/metadata/project").columns == ["content", "project_id", "version"]
    assert os.path.isdir(f"{folder}/out/errors")


def test_unreadable_document_is_reported(spark, schemas):
    rows, _, errors = reshape(spark, schemas, ("p", "metadata", "project", "a_1.json", '{"x": '))
    assert rows.count() == 0
    assert values(errors, "errorType", "message") == [("SchemaValidationError", "Unable to parse data into json for file")]


def test_unreadable_schema_is_reported(spark):
    broken = spark.createDataFrame([("u", "{oops")], JSON_SCHEMAS)
    _, _, errors = reshape(spark, broken, ("p", "metadata", "project", "a_1.json", '{"describedBy":"u"}'))
    assert values(errors, "message") == [("Schema not loaded properly for schema at u",)]


def test_large_registry_is_joined_with_equal_result(spark, schemas):
    rows = [("p", "metadata", "project", f"{i}_1.json", json.dumps({"describedBy": schema("protocol" if i % 2 else "gone")})) for i in range(20)]
    held = reshape(spark, schemas, *rows)[2]
    joined = reshape(spark, schemas, *rows, registry_limit=0)[2]
    assert values(held) == values(joined) and held.count() == 20


def test_requests_keep_first_of_a_file_id(spark, schemas):
    rows = [
        ("p", "descriptors", "image_file", f"{n}_1.json", json.dumps(descriptor("same", name)))
        for n, name in (("a", "z.png"), ("b", "y.png"))
    ]
    _, requests, _ = reshape(spark, schemas, *rows)
    assert values(requests, "target_path") == [("/v1/same/c1/y.png",)]


def test_area_paths_with_odd_characters(spark, folder, put):
    from strandline.sources.staging import inventory, read_documents

    odd = "a b+c%20/metadata"
    put(f"{odd}/metadata/project/sub dir/p q_{V1}.json", {"a": 1})
    put(f"{odd}/metadata/stray.json", {"a": 1})
    area = f"{folder}/{odd}"
    found = read_documents(spark, [area])
    assert values(found, "area", "kind", "entity_type", "file_name") == [(area, "metadata", "project", f"p q_{V1}.json")]
    files, unnamed = inventory(spark, [area])
    assert values(files, "top", "entity", "version") == [("metadata", "p q", f"{V1}.json")]
    assert unnamed.count() == 1


def test_inventory_and_structure_of_areas(spark, folder, put):
    from strandline.operators.checks import missing_directories
    from strandline.operators.latest import outdated_files
    from strandline.sources.staging import inventory, top_level

    write_area(put)
    put(f"area/metadata/project/proj1_2020-01-01T00:00:00.000000Z.json", {})
    put("area/staging_area.json", {})
    put("bare/links/x.json", {})
    areas = [f"{folder}/area", f"{folder}/bare", f"{folder}/none"]
    files, unnamed = inventory(spark, areas)
    assert values(files.groupBy("area", "top").count()) == sorted([
        (areas[0], "metadata", 7), (areas[0], "descriptors", 2), (areas[0], "links", 1), (areas[0], None, 1)],
        key=lambda row: tuple((v is not None, str(v)) for v in row))
    assert values(unnamed, "area", "top") == [(areas[1], "links")]
    assert [row.version for row in outdated_files(files).collect()] == ["2020-01-01T00:00:00.000000Z.json"]
    asked = spark.createDataFrame([(a,) for a in areas], "area string")
    missing = [(areas[1], t) for t in ("data", "descriptors", "metadata")] + [(areas[2], t) for t in ("data", "descriptors", "links", "metadata")]
    assert values(missing_directories(top_level(spark, areas), asked)) == sorted(missing)


def test_absent_area_gives_no_documents(spark, folder):
    from strandline.sources.staging import has_any_data, read_documents

    assert read_documents(spark, [f"{folder}/nowhere"]).count() == 0
    assert not has_any_data(spark, f"{folder}/nowhere")


def test_empty_files(spark, folder, put):
    from strandline.sources.staging import has_any_data, read_documents

    put("area/metadata/project/a_1.json", "")
    assert not has_any_data(spark, f"{folder}/area")
    put("area/metadata/project/b_1.json", "{}")
    assert has_any_data(spark, f"{folder}/area")
    assert values(read_documents(spark, [f"{folder}/area"]), "file_name", "value", "file_size") == [("a_1.json", "", 0), ("b_1.json", "{}", 2)]


@pytest.mark.parametrize("text", ['{"a": NaN}', '{"a": -Infinity}', '{"a": 1e999}', '{"a": "\\ud800"}', "", "[" * 100_000])
def test_text_that_is_no_writable_json_is_reported(spark, schemas, text):
    good = ("p", "metadata", "project", "b_1.json", '{"describedBy": "%s"}' % schema("any"))
    rows, _, errors = reshape(spark, schemas, ("p", "metadata", "project", "a_1.json", text), good)
    assert [row.entity_id for row in rows.collect()] == ["b"]
    assert values(errors, "fileName", "message") == [("a_1.json", "Unable to parse data into json for file")]


def test_descriptors_without_a_file_id_are_reported_and_not_requested(spark, schemas):
    bodies = [descriptor(None, "x.csv"), descriptor("f1", "y.csv"), {k: v for k, v in descriptor("", "z.csv").items() if k != "file_id"}]
    bodies.append({k: v for k, v in descriptor("", "w.csv", drs_uri="drs://w").items() if k != "file_id"})
    rows = [("p", "descriptors", "image_file", f"{i}_1.json", json.dumps(body)) for i, body in enumerate(bodies)]
    _, requests, errors = reshape(spark, schemas, *rows)
    assert values(requests, "target_path") == [("/v1/f1/c1/y.csv",)]
    found = values(errors.filter("errorType = 'MissingPropertyError'"), "fileName", "message")
    assert found == [("0_1.json", "File has no file_id property."), ("2_1.json", "File has no file_id property.")]


def test_constraints_that_are_not_checked_are_named(spark):
    known = [("u", '{"minProperties": 1, "properties": {"a": {"$ref": "x"}}, "title": "t"}'), ("v", '{"properties": {"a": {"pattern": "\\\\p{L}"}}}'), ("w", "false")]
    table = spark.createDataFrame(known, JSON_SCHEMAS)
    rows = [("p", "metadata", "project", f"{url}_1.json", json.dumps({"describedBy": url, "a": "b"})) for url, _ in known]
    _, _, errors = reshape(spark, table, *rows)
    assert values(errors, "fileName", "message") == [
        ("u_1.json", "Data in file does not conform to schema from u; #: constraint [minProperties] is not supported,#/a: constraint [$ref] is not supported"),
        ("v_1.json", "Schema not loaded properly for schema at v"),
        ("w_1.json", "Data in file does not conform to schema from w; #: no value is permitted"),
    ]


def test_empty_documents_are_reported_with_the_others(spark, folder, put, schemas):
    write_area(put)
    put(f"area/metadata/cell_line/void_{V1}.json", "")
    put(f"area/links/void_{V1}_proj1.json", "")
    result = P.preprocess(spark, [f"{folder}/area"], schemas)
    assert values(result.errors, "fileName", "message") == [
        (f"void_{V1}.json", "Unable to parse data into json for file"), (f"void_{V1}_proj1.json", "Unable to parse data into json for file")]


def test_workers_need_no_installed_package(folder):
    """The same in a process started elsewhere, without the package on the workers' path."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import importlib.util, sys\n"
        f"spec = importlib.util.spec_from_file_location('entry', {root!r} + '/__spark_entry__.py')\n"
        "entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "for name in ('v1_schema_validation', 'p4_file_rows', 'k7_error_log'):\n"
        "    print(name, entry.queries()[name](spark, '/root/testdata/sf0.001').count())\n"
    )
    path = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, env=path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(done.stdout.split()) == 6
