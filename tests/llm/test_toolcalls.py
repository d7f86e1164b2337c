import json

from strandline.llm import toolcalls

SCHEMA = "conv_id long, turn long, role string, text string, id string, level string, c string"


def calls(*items):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in items]})


def result(key, content):
    return json.dumps({"tool_call_id": key, "content": content})


def test_links(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", calls(("a", "search", {"query": "x", "limit": 3}), ("b", "search", {"limit": 2, "query": "é\n\"", "after": "a"}))),
        (1, 2, "tool", result("a", "found")), (1, 2, "tool", result("b", None)),
        (1, 3, "assistant", calls(("c", "fetch", {"depth": 1.5, "path": "p", "after": "a,b"}), ("d", "nothing", {}), ("e", "note", [1]))),
        (1, 4, "assistant", calls(("f", "note", {"text": 1, "extra": {"z": 1, "a": [2, 1]}, "after": "g"}), ("g", "note", {"text": "t", "pinned": True, "after": "f"}))),
        (2, 1, "assistant", calls(("a", "note", {"text": "other", "pinned": False}))), (2, 0, "tool", result("a", "early")),
        (3, 1, "assistant", None), (3, 2, "tool", "{broken tool_call_id"), (None, 1, "assistant", calls(("z", "note", {}))), (4, 1, "assistant", ""),
        (5, 1, "assistant", calls((None, "note", {}))), (6, 1, "assistant", calls(("h", "note", {"text": "x" * 300_000, "pinned": True}))),
    ]
    rows = [(*r, "clash", "clash", "clash") for r in [*rows, rows[1]]]
    got = {(r.conv_id, r.call_id): r for r in toolcalls.link(spark.createDataFrame(rows, SCHEMA), toolcalls.tool_schemas(spark)).collect()}
    assert set(got) == {(1, c) for c in "abcdefg"} | {(2, "a"), (6, "h")}
    status = {k: (r.status, r.level) for k, r in got.items()}
    assert status[1, "a"] == ("ok", 0) and status[1, "b"] == ("ok", 1) and status[1, "c"] == ("bad_arguments", 2)
    assert status[1, "d"] == ("unknown_tool", 0) and status[1, "e"] == ("bad_arguments", 0)
    assert status[1, "f"] == ("cycle", None) == status[1, "g"] and status[2, "a"] == ("early_result", 0) and status[6, "h"] == ("no_result", 0)
    assert got[1, "c"].problems == "type:depth" and got[1, "f"].problems == "missing:pinned,type:text,unknown:extra"
    for key in ((1, "a"), (1, "b"), (1, "c"), (1, "f"), (6, "h")):
        canonical = got[key].canonical
        assert canonical == json.dumps(json.loads(canonical), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(got[1, "b"].canonical) == {"arguments": {"limit": 2, "query": "é\n\"", "after": "a"}, "id": "b", "name": "search", "result": None}
    assert got[1, "e"].canonical is None


def test_a_long_chain(spark):
    rows = [(1, i, "assistant", calls((f"k{i}", "note", {"text": "t", "pinned": True, **({"after": f"k{i - 1}"} if i else {})})), "", "", "") for i in range(6)]
    got = toolcalls.link(spark.createDataFrame(rows, SCHEMA), toolcalls.tool_schemas(spark)).collect()
    assert {r.call_id: r.level for r in got} == {f"k{i}": i for i in range(6)}


def test_empty_table(spark):
    assert toolcalls.link(spark.createDataFrame([], SCHEMA), toolcalls.tool_schemas(spark)).collect() == []
