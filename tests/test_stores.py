"""The stored index, greedy packing, percentiles, replay and clean-up, against plain Python."""

import gzip
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom import session
from ledgerloom.operators import evaluate, graph, packing, quality, stored, systems
from ledgerloom.sources import jsonl, web


def greedy(rows, limit, most):
    out, state = {}, {}
    for g, k, s in sorted(rows, key=lambda r: (r[0] or "", r[1])):
        shard, used, count = state.get(g, (0, 0, 0))
        if count and (used + (s or 0) > limit or count >= most):
            shard, used, count = shard + 1, 0, 0
        state[g] = (shard, used + (s or 0), count + 1)
        out[g, k] = shard
    return out


@pytest.mark.parametrize(("chunk", "limit", "most"), [(7, 40, 5), (50, 300, 1000), (10**6, 25, 3)])
def test_greedy_packing_equals_the_plain_loop(spark, monkeypatch, chunk, limit, most):
    rng = random.Random(chunk)
    rows = [("hot" if i % 3 else rng.choice(["a", "b", None]), i, rng.choice([0, 1, 5, 12, 60, None])) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, k int, s long")
    monkeypatch.setattr(packing, "CHUNK_ROWS", chunk)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = {(r["g"], r["k"]): r["shard"] for r in packing.greedy_shards(df, "g", ["k"], "s", limit, most).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == greedy(rows, limit, most)


def test_content_addresses_follow_the_content(spark, tmp_path):
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else "x" * (i % 7)) for i in range(60)], "k int, v string")
    one = packing.write_content_addressed(rows.repartition(5), f"file://{tmp_path}/a", ["k"], 200)
    same = packing.write_content_addressed(rows.orderBy(F.desc("k")).coalesce(1), f"file://{tmp_path}/a", ["k"], 200)
    other = packing.write_content_addressed(rows.where("k <> 7"), f"file://{tmp_path}/a", ["k"], 200)
    assert one == same != other
    back = spark.read.text(one)
    assert sorted(json.loads(r["value"])["k"] for r in back.collect()) == list(range(60))
    assert max(sum(len(r["value"]) + 1 for r in back.where(F.col("shard") == s["shard"]).collect()) for s in back.select("shard").distinct().collect()) <= 200


def test_packing_of_nothing(spark):
    assert packing.greedy_shards(spark.createDataFrame([], "g string, k int, s long"), "g", ["k"], "s", 5).collect() == []


def test_partition_bytes_are_those_of_indented_json(spark):
    rng = random.Random(5)
    lists = {f"t{i}": [[rng.randint(0, 10**6), rng.randint(1, 60), rng.randint(1, 511)] for _ in range(rng.randint(1, 9))] for i in range(60)}
    df = spark.createDataFrame([("t", t, o, s, m) for t, rows in lists.items() for o, s, m in rows], "shard string, token string, ordinal long, score int, mask int")
    parts = {r["token"]: r["part"] for r in stored.posting_partitions(df, 900).collect()}
    size = lambda tokens: len((json.dumps({"tokens": {t: lists[t] for t in sorted(tokens)}}, indent=2) + "\n").encode())
    for n in range(max(parts.values()) + 1):
        own = [t for t in parts if parts[t] == n]
        assert size(own) <= 900
        after = min((t for t in parts if parts[t] == n + 1), default=None)
        assert after is None or size([*own, after]) > 900
    with pytest.raises(Exception, match="postings too large"):
        stored.posting_partitions(df, 150).collect()


def test_index_is_fetched_and_refused(spark, tmp_path):
    rows = [(1, "dataset/a", "https://x/a", "Canal rules", "canal"), (2, "dataset/b", "https://x/b", "Canal café", "canal"), (1500, "dataset/c", "https://x/c", "Water", "x")]
    df = spark.createDataFrame(rows, "rid int, open string, url string, title string, tag string")
    stored.write_index(df, "rid", {"title": F.col("title")}, F.col("title"), {"open": F.col("open"), "url": F.col("url"), "tag": F.col("tag")}, f"file://{tmp_path}/index")
    own = stored.SearchIndex(spark, f"file://{tmp_path}/index")
    assert own.fetch("dataset/c")["title"] == "Water" and own.fetch("https://x/a", "url")["rid"] == 1
    for asked, kind in (("canal", None), ("none", None), ("dataset/a", "url")):
        with pytest.raises(LookupError):
            own.fetch(asked, kind)
    found = own.search(spark.createDataFrame([(1, "canal cafe"), (2, "nothing")], "query_id int, text string")).collect()
    assert [(r["query_id"], r["ordinal"]) for r in found] == [(1, 2)]
    assert sorted(r["ordinal"] for r in own.bm25(spark.createDataFrame([(1, "canal")], "query_id int, text string")).collect()) == [1, 2]
    assert sorted(r["ordinal"] for r in own.exact(["canal", "https://x/c"], ["url"]).collect()) == [1500]
    plan = own.table("postings").where(F.col("lead").isin("ca"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_identifiers_with_one_match(spark):
    index = spark.createDataFrame([("dataset/a", "open", 1), ("u", "url", 1), ("u", "tag", 2), ("t", "tag", 1), ("t", "tag", 2)], "identifier string, kind string, rid int")
    asked = spark.createDataFrame([("dataset/a", None), ("u", "url"), ("u", None), ("t", None), ("x", None), ("dataset/a", "url")], "identifier string, kind string")
    got = {(r["identifier"], r["kind"]): (r["rid"], r["fault"]) for r in graph.one_match(asked, index, "rid", {"dataset/": "open"}).collect()}
    assert got == {("dataset/a", "open"): (1, None), ("u", "url"): (1, None), ("u", None): (None, "ambiguous"), ("t", None): (None, "ambiguous"), ("x", None): (None, "unknown"), ("dataset/a", "url"): (None, "unknown")}


def test_percentiles_of_a_large_group(spark):
    rng = random.Random(4)
    rows = [("big" if i % 2 else rng.choice(["s", None]), rng.choice([None, 1.0, 2.5, rng.random()])) for i in range(600)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    for r in evaluate.percentiles(df, ["g"], "v", [0.01, 0.5, 0.95]).collect():
        values = sorted(v for g, v in rows if g == r["g"] and v is not None)
        want = [values[max(0, math.ceil(len(values) * s) - 1)] if values else None for s in (0.01, 0.5, 0.95)]
        assert [r["p1"], r["p50"], r["p95"]] == want and r["n"] == len(values)


def test_replay_usage_and_abstention(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, v string")
    assert systems.replay_faults(a, a.repartition(3)).collect() == []
    assert sorted((r["k"], r["run"], r["n_more"]) for r in systems.replay_faults(a, b).collect()) == [(1, "first", 1), (3, "second", 1)]
    assert [(r["column"], r["total"]) for r in systems.usage_faults(a, ["k"]).collect()] == [("k", 4.0)] and systems.usage_faults(a.where("false"), ["k"]).collect() == []
    texts = spark.createDataFrame([("Guaranteed, without the facts",), ("guarantee",), ("Not enough to answer safely",), (None,)], "t string")
    assert [r[0] for r in texts.select(systems.abstains(F.col("t"))).collect()] == [True, False, True, False]


def test_topology_and_citation_faults(spark):
    made = spark.createDataFrame([("h", 1), ("k", 2)], "host string, n int")
    assert quality.topology_faults(made, made).collect() == []
    assert sorted((r["host"], r["column"]) for r in quality.topology_faults(made.where("host = 'h'"), made.withColumn("n", F.lit(2))).collect()) == [("h", "n"), ("k", "n")]


def test_sitemap_entries_keep_their_own_dates(spark):
    xml = '<urlset xmlns="http://s"><url><loc>https://a/1</loc></url><url><loc> https://a/2 </loc><lastmod>2024-01-02</lastmod></url><url><lastmod>2024-01-09</lastmod></url></urlset>'
    maps = spark.createDataFrame([(1, xml), (2, "<sitemapindex><sitemap><loc>https://a/m</loc></sitemap></sitemapindex>"), (3, "<urlset><url>"), (4, None), (5, "")], "k int, xml string")
    got = sorted((r["k"], r["kind"], r["loc"], r["lastmod"]) for r in web.sitemap_entries(maps, "k", "xml").collect())
    assert got == [(1, "url", "https://a/1", None), (1, "url", "https://a/2", "2024-01-02"), (2, "sitemap", "https://a/m", None)]


def test_links_in_context_and_search_parts(spark):
    text = "# Head\n\nSee [the *rules*](https://x/r) & [more](/m)\nhere.\n \nNo ![image](/i.png) link, but [one](/o)."
    found = [(r["paragraph"], r["context"], r["label"], r["url"]) for r in web.markdown_links_in_context(spark.createDataFrame([(1, text), (2, None), (3, "")], "k int, t string"), "k", "t").collect()]
    assert found == [(1, "See the rules & more here.", "the *rules*", "https://x/r"), (1, "See the rules & more here.", "more", "/m"), (2, "No !image link, but one.", "one", "/o")]
    parts = json.dumps([{"slug": "a", "title": "A", "body": "<p>Some <b>text</b> .</p>"}, {"slug": "b", "body": " <br> "}, {"link": "/c", "body": "plain &amp; more"}])
    got = [(r["part_index"], r["part_slug"], r["extract_text"]) for r in web.search_parts(spark.createDataFrame([("i", parts), ("j", "{}"), ("k", None)], "id string, parts string"), "id", "parts").collect()]
    assert got == [(0, "a", "Some text."), (2, None, "plain & more")]


def test_line_faults_and_bounded_files(spark, tmp_path):
    (tmp_path / "lines").write_text('{"a":1,"b":"é"}\n{"b":1,"a":2}\n[1]\n\n{"a": 1}\n{"a":"' + "x" * 50 + '"}\n{bad\n')
    got = {r["fault"]: r["n"] for r in jsonl.line_faults(spark, str(tmp_path / "lines"), 40).collect()}
    assert got == {"not_an_object": 2, "too_long": 1, "not_canonical": 3}
    (tmp_path / "f.gz").write_bytes(gzip.compress(b'{"a": 1}' * 100))
    assert jsonl.read_gzip_json(spark, str(tmp_path / "f.gz"), 500, 1000).first()["text"] == '{"a": 1}' * 100
    for bounds in ((5, 1000), (500, 799)):
        with pytest.raises(Exception, match="too large|more bytes"):
            jsonl.read_gzip_json(spark, str(tmp_path / "f.gz"), *bounds).collect()


def test_release_leaves_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda s: f"file://{tmp_path}")
    session.durable(spark.range(5), "x")
    a, n = session.durable_counted(spark.range(5).toDF("v"), "y", F.col("v") > 2)
    assert n == 2 and session.parts(spark, [a, a]).count() == 10
    made = []
    source = spark.read.parquet(a._ledgerloom_path)
    for _ in range(2):
        session.stored("z", source, lambda path: (made.append(path), spark.range(3).write.parquet(path)))
    assert len(made) == 1
    session.discard(a)
    session.release(spark)
    assert not list((tmp_path / "ledgerloom").iterdir())
