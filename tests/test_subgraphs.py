import json

import pytest

from conftest import values
from staging import file_link, links, process_link
from strandline.operators import skew
from strandline.operators import subgraphs as S
from strandline.plans import check as C
from strandline.schemas import ROWS
from strandline.session import LANDED


def frame(spark, *rows):
    return spark.createDataFrame([(i, p, c if isinstance(c, str) else json.dumps(c)) for i, p, c in rows],
                                 "links_id string, project_id string, content string")


def test_nodes_of_two_subgraphs(spark):
    rows = frame(
        spark,
        ("l1", "p", links(file_link("proj1", ("s1", "s2")))),
        ("l2", "p", links(process_link("proc1", ("i1", "i2"), ("o1", "o2"), ("q1",)))),
    )
    assert values(S.subgraph_nodes(rows), "links_id", "entity_type", "entity_id") == sorted([
        ("l1", "links", "l1"), ("l2", "links", "l2"), ("l1", "project", "proj1"),
        ("l1", "supplementary_file", "s1"), ("l1", "supplementary_file", "s2"),
        ("l2", "analysis_process", "proc1"), ("l2", "cell_line", "i1"), ("l2", "cell_line", "i2"),
        ("l2", "analysis_file", "o1"), ("l2", "analysis_file", "o2"), ("l2", "analysis_protocol", "q1"),
    ])
    assert S.link_problems(rows).count() == 0


def test_problems_are_reported(spark):
    open_link = process_link()
    del open_link["outputs"]
    partial = process_link()
    del partial["inputs"][0]["input_id"]
    rows = frame(
        spark, ("ok", "p", links()), ("unknown", "p", links({"link_type": "odd"})), ("open", "p", links(open_link)),
        ("partial", "p", links(partial)), ("text", "p", "not json"), ("none", "p", {"a": 1}),
        ("files", "p", links({"link_type": "supplementary_file_link", "entity": {"entity_type": "project", "entity_id": "x"}})),
    )
    assert values(S.link_problems(rows), "links_id", "problem") == [
        ("files", "incomplete supplementary_file_link"), ("none", "no links array"), ("open", "incomplete process_link"),
        ("partial", "incomplete process_link"), ("text", "no links array"), ("unknown", "unknown link type odd"),
    ]


def loaded(spark, *pairs):
    return spark.createDataFrame(list(pairs), "entity_type string, entity_id string")


ALL = [("links", "l1"), ("analysis_process", "proc1"), ("cell_line", "cell1"), ("analysis_file", "file1"), ("analysis_protocol", "prot1")]


def test_missing_entities(spark):
    rows = frame(spark, ("l1", "p1", links(process_link())), ("l2", "p2", links(process_link("other"))))
    stored = loaded(spark, *ALL, *ALL)
    nodes = S.subgraph_nodes(rows)
    absent = [("analysis_process", "other"), ("links", "l2")]
    assert values(S.missing_entities(nodes, stored)) == absent
    assert values(S.missing_by_project(nodes, stored), "project_id", "entity_type", "entity_id") == [("p2", *a) for a in absent]
    asked = spark.createDataFrame([("p1", "q"), ("p2", "q"), ("p3", "q")], "project_id string, dataset_qualifier string")
    assert values(S.verify_projects(asked, rows, stored), "project_id", "n_links", "n_expected", "n_missing", "n_problems", "verified") == [
        ("p1", 1, 5, 0, 0, True), ("p2", 1, 5, 2, 0, False), ("p3", 0, 0, 0, 0, False)]


def test_project_sets(spark):
    a = spark.createDataFrame([("x",), ("y",)], "project_id string")
    b = spark.createDataFrame([("y",), ("z",)], "project_id string")
    assert values(S.project_set_difference(a, b)) == [("x", "unexpected"), ("z", "absent")]
    assert S.project_set_difference(a, a).count() == 0


def stored_rows(spark, content, project="p1", drop=()):
    from datetime import date, datetime

    made = []
    for entity_type, entity_id in [*ALL, ("project", project)]:
        if entity_type in drop:
            continue
        own = entity_type == "links"
        made.append((entity_id, datetime(2021, 1, 1), json.dumps(content) if own else "{}", project if own else None,
                     "f" if entity_type.endswith("_file") else None, "{}" if entity_type.endswith("_file") else None,
                     None, f"{entity_type}-{entity_id}", entity_type, date(2021, 1, 1)))
    return spark.createDataFrame(made, ROWS)


def test_single_project(spark):
    rows = stored_rows(spark, links(process_link()))
    C.require_single_project(rows, "p1")
    C.require_project_loaded(rows, "p1")
    with pytest.raises(S.SubgraphError, match="another project"):
        C.require_single_project(rows, "p2")
    with pytest.raises(S.SubgraphError, match="no links rows"):
        C.require_project_loaded(rows, "p2")
    with pytest.raises(S.SubgraphError, match="not loaded"):
        C.require_single_project(stored_rows(spark, links(process_link()), drop=("cell_line",)), "p1")
    with pytest.raises(S.SubgraphError, match="unreadable"):
        C.require_single_project(stored_rows(spark, links({"link_type": "odd"})), "p1")


def test_report_and_missing_entities_shuffle_once_and_store_nothing(spark, monkeypatch):
    """Nodes were stored and the loaded entities shuffled a second time, by slice, though no key can be heavy."""
    rows = frame(spark, ("l1", "p1", links(process_link())), ("l2", "p2", links(process_link("other"))), ("l3", "p2", "{}"), ("l4", "p2", "{}"))
    stored = loaded(spark, *ALL, *ALL)
    nodes = S.subgraph_nodes(rows)
    n_stored = len(LANDED)
    missing, report = S.missing_by_project(nodes, stored, rows), S.project_report(rows, stored)
    assert len(LANDED) == n_stored and "__slice" not in missing._jdf.queryExecution().optimizedPlan().toString()
    counts = [("p1", 1, 5, 0, 0, True), ("p2", 3, 7, 4, 2, False)]
    assert values(report, "project_id", "n_links", "n_expected", "n_missing", "n_problems", "verified") == counts
    want = values(missing)
    monkeypatch.setattr(skew, "MIN_SLICE_ROWS", 1)  # more projects than a slice has rows
    assert values(S.missing_by_project(nodes, stored)) == want and len(LANDED) > n_stored
    assert values(S.project_report(rows, stored), "project_id", "n_links", "n_expected", "n_missing", "n_problems", "verified") == counts


def test_a_check_opens_documents_once_and_stores_nothing(spark):
    one = frame(spark, ("l1", "p1", links(process_link())))
    n_stored = len(LANDED)
    assert S.first_fault(one, loaded(spark, *ALL, (None, None))) is None
    assert S.first_fault(one, loaded(spark, *ALL[1:], ("links", None))) == ({"entity_type": "links", "entity_id": "l1"}, False)
    row, unreadable = S.first_fault(one.unionByName(frame(spark, ("l2", "p1", "{}"))), loaded(spark, *ALL))
    assert unreadable and row == {"links_id": "l2", "project_id": "p1", "problem": "no links array"}
    # an id that is null is never loaded
    nameless = frame(spark, (None, "p1", links(process_link())))
    assert S.first_fault(nameless, loaded(spark, *ALL[1:], ("links", None))) == ({"entity_type": "links", "entity_id": None}, False)
    assert len(LANDED) == n_stored
