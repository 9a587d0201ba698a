import random

from ledgerloom.operators import hierarchy as H


def brute(links):
    up = {}
    for p, c in links:
        if p is not None and c is not None:
            up[c] = min(up.get(c, p), p)
    out = {}
    for n in {x for link in links if None not in link for x in link}:
        path, seen = [n], {n}
        while path[-1] in up and up[path[-1]] not in seen:
            path.append(up[path[-1]])
            seen.add(path[-1])
        out[n] = None if path[-1] in up else path[::-1]
    return out


def check(spark, links, stride):
    got = H.resolve(spark.createDataFrame(links, "parent string, child string"), stride).collect()
    want = brute(links)
    assert len(got) == len(want)
    for r in got:
        path = want[r["node_id"]]
        if path is None:
            assert r["on_cycle"] and r["depth"] == -1 and r["root_id"] is None and r["node_path"] is None
        else:
            assert list(r["node_path"]) == path and r["depth"] == len(path) - 1 and r["root_id"] == path[0] and not r["on_cycle"]


def test_random_forest_chains_cycles_and_hot_parent(spark):
    rng = random.Random(2)
    links = [(f"c{i}", f"c{i + 1}") for i in range(60)]  # a deep chain
    links += [("c0", f"leaf{i}") for i in range(40)]
    links += [(f"r{i}", f"r{(i + 1) % 25}") for i in range(25)] + [("r3", "below"), ("below", "below2")]  # a cycle, and what hangs from it
    links += [("self", "self"), ("x", "y"), ("y", "x"), ("y", "y2")]
    links += [(f"t{rng.randint(0, i - 1)}", f"t{i}") for i in range(1, 60)]
    links += [("t0", "two"), ("a0", "two"), ("t0", "two"), (None, "t1"), ("t1", None)]
    check(spark, links, 8)


def test_without_and_with_only_splitters(spark):
    links = [(f"n{i}", f"n{i + 1}") for i in range(9)] + [("p", "q"), ("q", "p")]
    check(spark, links, 1)
    check(spark, links, 10**9)


def test_empty_and_descendants(spark):
    assert H.resolve(spark.createDataFrame([], "parent string, child string")).count() == 0
    tree = H.resolve(spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "x")], "parent string, child string"))
    assert sorted(map(tuple, H.descendants(tree).collect())) == [("a", "b", 1), ("a", "c", 2), ("b", "c", 1)]


def test_page_links(spark):
    schema = "content_id string, base_path string, parent_taxons array<string>, child_taxons array<string>, second_level_browse_pages array<string>, id string"
    pages = [("A", "/a", None, [" B ", None, "nowhere", "/C"], [], "z"), ("B", "/b", [" a"], None, None, "z"), ("C", "/c", [], [], ["/D "], "z"), ("D", "/d", None, None, None, "z"), (None, "/n", ["A"], None, None, "z"), ("A", "/a", None, None, None, "z")]
    nodes, links = H.page_links(spark.createDataFrame(pages, schema))
    assert sorted(map(tuple, links.collect())) == [("A", "B"), ("A", "C"), ("C", "D")]
    assert nodes.count() == 4
