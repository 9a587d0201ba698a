import itertools
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import identity, text, urls
from ledgerloom.operators import assign, graph, index, packing, projection, quality
from ledgerloom.sources import jsonl, web


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}").orderBy("i")


def test_token_vectors(spark):
    got = [r[0] for r in column(spark, ["The Café café driving-licence API.v2", "The e-government can't file.name under_score", None, "", "ß ﬁne"]).select(text.tokens(F.col("x"))).collect()]
    assert got == [["cafe", "driving-licence", "api.v2"], ["e-government", "can", "file.name", "under_score"], None, [], ["fine"]]
    shards = [r[0] for r in column(spark, ["e-government", "can", "_", "7up"]).select(identity.search_shard(F.col("x"))).collect()]
    assert shards == ["eg", "ca", "_", "7u"]


def test_fnv_vectors(spark):
    def plain(s):
        h = 2166136261
        for b in s.encode():
            h = (h ^ b) * 16777619 % 2**32
        return h

    words = ["", "a", "dataset/a", "é🙂", None]
    got = [tuple(r) for r in column(spark, words).select(identity.fnv1a32(F.col("x")), identity.adjacency_bucket(F.col("x"))).collect()]
    assert got == [(plain(w), f"{plain(w) >> 24:02x}") if w is not None else (None, None) for w in words]


def test_url_rules():
    ok = {"HTTPS://Example.ORG:443/a?utm_x=1&b=2&api_key=q#f": "https://example.org/a?b=2", "/x": "https://www.gov.example/x", "http://a.b": "http://a.b/", "http://a.b:8080/": "http://a.b:8080/", "https://bücher.example/": "https://xn--bcher-kva.example/"}
    assert {u: urls.normal_url(u) for u in ok} == ok
    assert all(urls.normal_url(u) is None for u in [None, "//a.b/c", "ftp://a.b", "https://u:p@a.b/", "https:///x", "https://a.b\\c", "https://a.b/\n", "mailto:x", "https://a.b:99999/", ""])
    assert urls.resolved_url("https://a.b/c/d", " ../e ") == "https://a.b/e" and urls.resolved_url("https://a.b/", "mailto:x") is None and urls.resolved_url(None, "x") is None


def test_ranking_vectors(spark):
    lists = spark.createDataFrame([("a", 1, 10, 1), ("a", 2, 8, 0), ("b", 1, 4, 0), ("b", 3, 20, 1)], "token string, ordinal int, score int, mask int")
    terms = spark.createDataFrame([("a", 2), ("b", 2)], "token string, df int")
    one = index.search(spark.createDataFrame([(1, "aa")], "query_id int, text string").withColumn("text", F.lit("xx")), lists, terms)
    assert one.count() == 0
    lists2 = lists.withColumn("token", F.concat("token", "token"))
    terms2 = terms.withColumn("token", F.concat("token", "token"))
    got = index.search(spark.createDataFrame([(1, "aa bb")], "query_id int, text string"), lists2, terms2, cap=10).collect()
    assert [(r["ordinal"], r["search_score"]) for r in got] == [(1, 18)]
    capped = spark.createDataFrame([("aa", 1, 1, 0), ("bb", 2, 12, 1)], "token string, ordinal int, score int, mask int")
    got = index.search(spark.createDataFrame([(1, "aa bb")], "query_id int, text string"), capped, spark.createDataFrame([("aa", 1000), ("bb", 1)], "token string, df int"), cap=100).collect()
    assert [(r["ordinal"], r["search_score"]) for r in got] == [(2, 16)]


def test_scale_recipe(spark):
    """2,048 records, each linked to the one before, one publisher, every hundredth with an attachment, 64 tokens in each title."""
    n = 2048
    rows = [(i, f"common ca{i % 64:06d} " + " ".join(f"ca{t:06d}" for t in range(64)), [f"r{i - 1}"] if i else [], ["p"], [f"a{i}"] if i % 100 == 0 else []) for i in range(n)]
    df = spark.createDataFrame(rows, "rid int, title string, related array<string>, organisations array<string>, attachments array<string>").withColumn("id", F.concat(F.lit("r"), "rid"))
    edges = graph.list_edges(df, "id", ["related", "organisations", "attachments"])
    assert edges.count() == n - 1 + n + 21 and edges.where("predicate = 'attachments'").count() == 21 and edges.where("predicate = 'organisations'").select("target").distinct().count() == 1
    lists = index.capped(index.postings(df, "rid", {"title": F.col("title")})).where("token = 'common'")
    assert lists.count() == 2000 and lists.agg(F.max("ordinal")).first()[0] == 1999


def test_robots():
    rules = web.robots_rules("User-agent: a\nUser-agent: *\nDisallow: /x\nAllow: /x/y\nDisallow:\nDisallow: /*.pdf$\n\nUser-agent: b\nDisallow: /")
    assert rules == [(False, "/x"), (True, "/x/y"), (False, "/*.pdf$")]
    assert web.robots_rules("") == []


def test_robots_decisions(spark):
    rules = web.robots_rules("User-agent: *\nDisallow: /x\nAllow: /x/y\nDisallow: /*.pdf$\nAllow: /same\nDisallow: /same")
    got = {r["x"]: r["ok"] for r in column(spark, ["/x", "/x/y/z", "/a.pdf", "/a.pdf?b", "/same", "/"]).select("x", web.robots_allows(F.col("x"), rules).alias("ok")).collect()}
    assert got == {"/x": False, "/x/y/z": True, "/a.pdf": False, "/a.pdf?b": True, "/same": True, "/": True}
    assert column(spark, ["/x"]).select(web.robots_allows(F.col("x"), [])).first()[0] is True


def test_pages_and_sitemaps(spark):
    pages = ['<html lang=cy><a href=" /a " rel=next>One</a><script>no</script><script type="application/ld+json">{"@type": ["A", "B"]}</script> , two', None, "", "<script type='application/ld+json'>{broken</script>x"]
    rows = web.page_parts(column(spark, pages), "i", "x").orderBy("i").collect()
    assert rows[0]["language"] == "cy" and rows[0]["text"] == "One, two" and rows[0]["types"] == ["A", "B"] and rows[0]["links"][0]["href"] == "/a"
    assert rows[1]["text"] is None and rows[2]["text"] == "" and rows[3]["text"] == "x" and rows[3]["types"] == []
    texts = spark.createDataFrame([("a &amp; b <b>c</b> .",), (None,), ("x  &lt; y ,z",), ("plain  text !",), ("<script>no</script> yes",)], "t string")
    assert [r[0] for r in texts.select(web.html_text(F.col("t"))).collect()] == ["a & b c.", None, "x < y,z", "plain text!", "yes"]
    maps = ["<urlset><url><loc>u1</loc></url><url><loc>u2</loc><lastmod>d</lastmod></url></urlset>", '<sitemapindex xmlns="q"><sitemap><loc>s</loc><lastmod>e</lastmod></sitemap></sitemapindex>', None]
    got = sorted(map(tuple, web.sitemap_entries(column(spark, maps), "i", "x").collect()), key=str)
    assert got == [(0, "url", "u1", None), (0, "url", "u2", "d"), (1, "sitemap", "s", "e")]
    links = web.markdown_links(column(spark, ["[a](b) ![i](j) [c](d)", None]), "i", "x").select("label", "url").collect()
    assert [tuple(r) for r in links] == [("a", "b"), ("c", "d")]


def test_least_cost_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(1, 6))
        m = int(rng.integers(n, 7))
        cost = rng.integers(0, 20, (n, m)).astype(float)
        best = min(sum(cost[i, p[i]] for i in range(n)) for p in itertools.permutations(range(m), n))
        found = assign.least_cost(cost)
        assert len(set(found.tolist())) == n and cost[np.arange(n), found].sum() == best


def test_shards_and_manifest_tampering(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}", None) for i in range(50)], "k int, t string, z string")
    path = str(tmp_path / "out")
    packing.write_canonical(df, path, ["k"], 20)
    listed = packing.manifest(spark, path)
    held = spark.createDataFrame(listed.collect(), listed.schema)
    assert jsonl.read_verified(spark, path, held, "k int, t string, z string").count() == 50
    line = spark.read.text(path).orderBy("value").first()[0]
    assert list(json.loads(line)) == ["k", "t", "z"]
    os.remove(next(os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-")))
    with pytest.raises(ValueError, match="missing"):
        jsonl.read_verified(spark, path, held, "k int, t string, z string")
    with pytest.raises(Exception, match="too long"):
        jsonl.read_raw_jsonl(spark, path, 3).collect()


def test_greedy_shards_reset(spark):
    sizes = [5, 5, 1, 12, 3, 3, 3, 3, 3]
    df = spark.createDataFrame([("g", i, s) for i, s in enumerate(sizes)] + [("h", 0, 99)], "g string, i int, s int")
    got = sorted((r["g"], r["i"], r["shard"]) for r in packing.greedy_shards(df, "g", ["i"], "s", 10).collect())
    assert [x[2] for x in got] == [0, 0, 1, 2, 3, 3, 3, 4, 4, 0]


def test_nested_quality(spark):
    rows = column(spark, ['{"a": {"Logo-Url": "x"}, "b": []}', '{"b": 1, "e": {"keep": 1, "drop": 2}}', "bad", None])
    mask = quality.nested_mask({"logo": ["logo_url"], "b": ["b"]})
    assert [r[0] for r in rows.select(mask("x")).collect()] == [1, 2, 0, 0]
    assert [r[0] for r in rows.select(quality.without_fields(["drop", "a"])("x")).collect()] == ['{"b":[]}', '{"b":1,"e":{"keep":1}}', None, None]
    assert rows.select(quality.canonical_sha256("x")).distinct().count() == 3


def test_upsert_levels_and_install(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 5)], "k int, v string, o int")
    new = spark.createDataFrame([(1, "c", 1), (2, "d", 4), (3, "e", 1)], "k int, v string, o int")
    assert sorted((r["k"], r["v"]) for r in projection.upsert(old, new, ["k"], "o").collect()) == [(1, "c"), (2, "b"), (3, "e")]
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("x", "y"), ("y", "x"), ("y", "z")], "source string, target string")
    assert {r["node"]: r["level"] for r in projection.topological_levels(edges).collect()} == {"a": 0, "b": 1, "c": 2, "x": None, "y": None, "z": None}
    for name, value in (("one", 1), ("two", 2)):
        spark.range(value).write.parquet(str(tmp_path / name))
        projection.install(spark, str(tmp_path / name), str(tmp_path / "here"))
        assert spark.read.parquet(str(tmp_path / "here")).count() == value
    assert sorted(os.listdir(tmp_path)) == ["here"]
