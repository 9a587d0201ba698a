import json

from ledgerloom.functions.json_tools import canonical, loads, record_of
from ledgerloom.operators import nested as N


def paths(value, path, parent):
    """A plain walk: (path, parent) of every object below the top."""
    if isinstance(value, str):
        try:
            inner = json.loads(value)
        except ValueError:
            return
        if isinstance(inner, dict | list):
            yield from paths(inner, path, parent)
    elif isinstance(value, dict):
        if path != "$":
            yield path, parent
        for k, v in value.items():
            yield from paths(v, k if path == "$" else f"{path}.{k}", path)
    elif isinstance(value, list):
        for i, v in enumerate(value):
            yield from paths(v, f"{path}[{i}]", parent)


RECORDS = {
    1: {"a": {"b": [{"c": 1}, None, {"d": {}}]}, "e": [], "f": {}},
    2: {"links": {"taxons": [{"content_id": "x", "links": {"parent": {"y": 1}}}]}, "details": {"attachments": [{"id": "q"}]}},
    3: {"s": json.dumps({"in": {"deep": [1, {"z": json.dumps([{"w": 1}])}]}}), "t": "{not json}", "u": "[1, 2]"},
    4: {},
}


def test_paths_equal_plain_walk_and_links(spark):
    rows = [("t", k, json.dumps(v)) for k, v in RECORDS.items()]
    rows += [("t", 1, json.dumps(RECORDS[1])), ("t", 5, json.dumps(json.dumps(RECORDS[1]))), ("t", 6, "not available"), ("t", 7, None), ("t", 8, ""), ("t", 9, '{"a": {"b": 1}'), ("t", 10, "[{}]"), ("t", 11, "  ")]
    df = spark.createDataFrame(rows, "source_table string, row_id long, text string").selectExpr("*", "1 AS pre", "'x' AS node_path")
    nodes = N.flatten(df).collect()
    got = sorted((r["row_id"], r["node_path"], r["parent_path"]) for r in nodes if r["parent_pre"] is not None and r["node_type"] != "item")
    want = sorted((k, p, q) for k, v in {**RECORDS, 5: RECORDS[1]}.items() for p, q in paths(v, "$", None))
    assert got == want
    assert {r["node_type"] for r in nodes} == {"record", "link", "attachment", "object", "item"}
    by = {(r["row_id"], r["node_path"]): r for r in nodes}
    for r in nodes:
        if r["parent_pre"] is not None:
            up = by[r["row_id"], r["parent_path"]]
            assert up["pre"] == r["parent_pre"] < r["pre"] and up["post"] > r["post"]
    assert json.loads(by[1, "a.b[0]"]["scalars_json"]) == {"c": 1}


def test_scalars_of_lists_are_kept(spark):
    rows = [("t", 1, '{"a":["x",null,["y"]],"b":{"c":[1,2.5,true],"d":5},"e":"[\\"z\\"]"}')] * 3 + [("t", None, '{"a":[1]}')] * 2
    items = [r for r in N.flatten(spark.createDataFrame(rows, "source_table string, row_id long, text string")).collect() if r["node_type"] == "item"]
    assert sorted((r["node_path"], json.loads(r["scalars_json"]), r["parent_path"]) for r in items if r["row_id"] == 1 and r["scalars_json"] != "null") == sorted(
        [("a[0]", "x", "$"), ("a[2][0]", "y", "$"), ("b.c[0]", 1, "b"), ("b.c[1]", 2.5, "b"), ("b.c[2]", True, "b"), ("e[0]", "z", "$")], key=str
    )
    assert [(r["node_path"], r["list_position"]) for r in items if r["scalars_json"] == "null"] == [("a[1]", 1)]
    assert [r["node_path"] for r in items if r["row_id"] is None] == ["a[0]"]


def test_sweep_equals_all_pairs(spark):
    record = {"links": {"a": [{"links": {"b": [{"x": {"y": {}}}, {"z": [1, {}]}]}} for _ in range(5)]}, "attachments": [{"links": {"c": {"q": {}}}}], "p": {"q": {}}}
    rows = [("t", i, json.dumps(record)) for i in range(3)] + [("u", 1, json.dumps(record))]
    nodes = N.flatten(spark.createDataFrame(rows, "source_table string, row_id long, text string"))
    got = N.contained(nodes.select("source_table", "row_id", "pre", "post", "node_path"), nodes.where("node_type = 'link'")).collect()
    every = nodes.collect()
    links = [n for n in every if n["node_type"] == "link"]
    for r in got:
        above = [n for n in links if (n["source_table"], n["row_id"]) == (r["source_table"], r["row_id"]) and n["pre"] < r["pre"] and n["post"] > r["post"]]
        best = max(above, key=lambda n: n["pre"], default=None)
        assert (r["outer_pre"], r["outer_path"]) == ((best["pre"], best["node_path"]) if best else (None, None))
    assert len(got) == len(every)


def test_one_pass_gives_all_tables(spark):
    rows = spark.createDataFrame([("t", k, json.dumps(v)) for k, v in RECORDS.items()] * 2, "source_table string, row_id long, text string")
    tables = N.node_tables(rows)
    assert sum(t.count() for t in tables.values()) == N.flatten(rows).count()
    assert tables["link"].count() == 2 and set(tables["record"].columns) == set(N.NODES.names)


def test_interval_join_finds_nearest(spark):
    nodes = N.flatten(spark.createDataFrame([("t", 2, json.dumps(RECORDS[2]))], "source_table string, row_id long, text string"), payload=False)
    linked = N.contained(nodes.where("node_type <> 'link'").select("source_table", "row_id", "pre", "post", "node_path"), nodes.where("node_type = 'link'"))
    got = {r["node_path"]: r["outer_path"] for r in linked.collect()}
    assert got["links.taxons[0].links"] == "links.taxons[0]" and got["links"] is None and got["details.attachments[0]"] is None


def test_any_depth(spark):
    depth = 20_000
    text = '{"a":' * depth + "{}" + "}" * depth
    assert N.flatten(spark.createDataFrame([("t", 1, text)], "source_table string, row_id long, text string"), payload=False).count() == depth + 1
    assert record_of(text) is not None
    assert canonical(text).count("{") == depth + 1
    assert loads("[" * 5000 + "1" + "]" * 5000)
    for bad in ('{"a":' * depth, "[" * 9000 + "1,]" + "]" * 8999):
        try:
            loads(bad)
        except ValueError:
            continue
        raise AssertionError("accepted damaged text")


def test_empty(spark):
    assert N.flatten(spark.createDataFrame([], "source_table string, row_id long, text string")).count() == 0
