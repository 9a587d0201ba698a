"""Queries over small tables of their own, against brute force: what a cut of the input or of a list would lose."""

import datetime
import glob
import hashlib
import itertools
import json
import os
import random
import re
import shutil

from pyspark.sql import functions as F

from ledgerloom.functions import text
from ledgerloom.operators import assign, index, quality
from ledgerloom.plans import catalogue
from ledgerloom.streaming import queue


def put(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_pages_hold_whole_documents(spark, tmp_path):
    texts = {
        1: "Canal rules. " * 40 + "The end, at last",
        2: 'Mark-up <b class="x">bold</b> & an &amp; entity, <script>alert("é")</script> past the sixtieth character: <a href="/no">no link</a> ünï 🙂',
        3: "No path ,\n but text; 12 %",
        4: "",
        5: None,
    }
    paths = {1: "/one", 2: '/two?a=1&amp="q"', 3: None, 4: "/four", 5: "/five"}
    folder = put(spark, tmp_path, "documents", [(k, "en" if k > 1 else None, t, paths[k]) for k, t in texts.items()], "doc_id long, lang string, text string, base_path string")
    shown = lambda *parts: re.sub(r"\s+([,.;:!?])", r"\1", " ".join(" ".join(parts).split()))
    got = {r["doc_id"]: r for r in catalogue.QUERIES["html_text"](spark, folder).collect()}
    assert {k: r["text"] for k, r in got.items()} == {k: None if t is None else shown(t, "& more , end") for k, t in texts.items()}
    assert {k: r["language"] for k, r in got.items()} == {1: None, 2: "en", 3: "en", 4: "en", 5: None}
    links = sorted((r["doc_id"], r["position"], r["tag"], r["href"]) for r in catalogue.QUERIES["html_links"](spark, folder).collect())
    want = [(k, [x for x in [("a", paths[k]), ("img", f"/media/{k}.png")] if x[1]]) for k, t in texts.items() if t is not None]
    assert links == [(k, i, *x) for k, own in want for i, x in enumerate(own)]


RECORD = "rid long, open string, title string, publisher string, description string, document_type string, schema_name string, url string, language string, lifecycle string, tags string, title_key string, content_id string"


def test_long_lists_are_searched_whole(spark, tmp_path):
    """All records of few tokens, fewer than the 2,000 that a list keeps: those that hold both tokens are the last of the one list."""
    titles = [" ".join(["canal"] + ["seasonal"] * (i >= 300) + ["contractor", "quarry"] * (i < 310)) for i in range(700)]
    folder = put(spark, tmp_path, "records", [(i, f"o{i}", t, *[None] * 10) for i, t in enumerate(titles)], RECORD)
    lists = {r["token"]: r["n"] for r in catalogue.QUERIES["postings_topk"](spark, folder).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert lists == {"canal": 700, "seasonal": 400, "contractor": 310, "quarry": 310}
    both = list(range(300, 310))
    found = catalogue.QUERIES["keyword_search"](spark, folder).where("query_id = 1").orderBy("rank").collect()
    assert [r["ordinal"] for r in found] == both and {r["matched_tokens"] for r in found} == {2}
    counts = {r["query_id"]: r["n_results"] for r in catalogue.QUERIES["search_answerability"](spark, folder).collect()}
    assert counts[1] == 10 and counts[6] == 20
    grouped = catalogue.QUERIES["prefix_group_search"](spark, folder).where("query_id = 2").orderBy("rank").collect()
    assert [r["ordinal"] for r in grouped] == both


def test_capped_lists_equal_brute_force(spark):
    """A lowered cap, so that short lists are capped: which tokens are complete, candidates, scores."""
    rng, cap = random.Random(5), 3
    post = {t: {o: (rng.choice([4, 16]), rng.choice([1, 4])) for o in rng.sample(range(8), n)} for t, n in [("aa", 2), ("bb", 3), ("cc", 5), ("dd", 7)]}
    best = {t: sorted(p, key=lambda o: (-p[o][0], o))[:cap] for t, p in post.items()}
    asked = [(i, " ".join(c)) for i, c in enumerate(c for n in range(1, 5) for c in itertools.combinations(["aa", "bb", "cc", "dd"], n))]
    want = []
    for i, text in asked:
        ts = text.split()
        whole = [t for t in ts if len(post[t]) <= cap]
        sets = [set(best[t]) for t in whole] or [set(best[min(ts, key=lambda t: (len(post[t]), t))])]
        at = set.intersection(*sets) or set.union(*sets)
        score = {o: sum(post[t][o][0] + 4 * (post[t][o][1] == 1) for t in ts if o in best[t]) for o in at}
        want += [(i, o, score[o], k) for k, o in enumerate(sorted(at, key=lambda o: (-score[o], o)), 1)]
    rows = spark.createDataFrame([(t, o, s, m) for t, p in post.items() for o, (s, m) in p.items()], "token string, ordinal int, score int, mask int")
    found = index.search(spark.createDataFrame(asked, "query_id int, text string"), index.capped(rows, cap), index.lexicon(rows), cap=cap)
    assert sorted((r["query_id"], r["ordinal"], r["search_score"], r["rank"]) for r in found.collect()) == sorted(want)


def test_view_shows_up_to_its_limits(spark, tmp_path):
    put(spark, tmp_path, "lineitem", [(k, 17, 1) for k in range(30)], "l_orderkey long, l_partkey long, l_suppkey long")
    folder = put(spark, tmp_path, "orders", [(k, 1) for k in range(30)], "o_orderkey long, o_custkey long")
    shown = catalogue.QUERIES["centre_view"](spark, folder).collect()
    assert len(shown) == 31 and {r["source"] for r in shown} == {"part/17", *(f"order/{k}" for k in range(30))}


def test_watermark_reads_every_form(spark, tmp_path):
    def at(own, *evidence):
        return json.dumps({"retrieved_at": own, "closing_evidence": list(evidence)})

    rows = [
        ("offset", at("2026-01-01T00:30:00Z")), ("offset", at("2026-01-01T00:00:00-05:00")), ("offset", at("2026-01-01T04:00:00+00:00")),
        ("fraction", at("2026-01-01T00:00:00.250Z")), ("fraction", at("2026-01-01T00:00:00Z")),
        ("naive", at("2026-01-01T10:00:00")), ("naive", at("2026-01-01T10:30:00+01:00")), ("date", at("2026-01-02")), ("date", at("2026-01-01T23:59:59Z")),
        ("nested", at("2026-01-01T00:00:00Z", {"retrieved_at": "2026-03-01T00:00:00Z"}, {"retrieved_at": None}, "zz", {})), ("nested", at("2026-02-01T00:00:00Z")),
        ("invalid", at("soon")), ("invalid", at("later")), ("mixed", at("zz")), ("mixed", at("2020-01-01")), ("none", "{}"), ("none", "damaged"), ("none", None), (None, at("2026-01-05", {"retrieved_at": "9999"})),
    ]
    folder = put(spark, tmp_path, "work_items", rows, "coverage_disposition string, input_json string")
    got = {r["coverage_disposition"]: r["watermark"] for r in catalogue.QUERIES["closing_watermark"](spark, folder).collect()}
    assert got == {
        "offset": "2026-01-01T00:00:00-05:00", "fraction": "2026-01-01T00:00:00.250Z", "naive": "2026-01-01T10:00:00", "date": "2026-01-02", "nested": "2026-03-01T00:00:00Z",
        "invalid": "soon", "mixed": "2020-01-01", "none": "", None: "2026-01-05",
    }


def test_secrets_at_any_depth_are_found(spark, tmp_path):
    key = "AKIA" + "Z" * 16
    deep = lambda v: json.dumps({"details": [{"x": 1}, {"note": ["ok", v]}]})
    planted = [
        (deep("Data:image/png;base64,AAAA"), ["data_uri_payload"]), (deep("Zm9v" * 130 + "=="), ["long_base64_payload"]), (deep("  <!DOCTYPE HTML><p>"), ["complete_html_document"]),
        (deep("<html lang=en>"), ["complete_html_document"]), (deep("x " * 524_289), ["oversized_string"]), (deep("x " * 524_288), []), (deep({"Set-Cookie": None}), ["credential_field"]),
        (deep({"Body.HTML": "", "api key": "k"}), ["credential_field", "prohibited_body_field"]), (deep(key).replace("AKIA", "\\u0041KIA"), ["aws_access_key"]), (deep("a\n" + key), ["aws_access_key"]),
        (deep("Authorization:\tBearer abcdefghijkl.m"), ["bearer_credential"]), (deep("-----BEGIN EC PRIVATE KEY-----"), ["private_key_material"]), (json.dumps({key: 1}), ["aws_access_key"]),
        (json.dumps(deep(key)), ["aws_access_key"]), ("{damaged " + key, ["aws_access_key"]), ("data:a/b;base64,", ["data_uri_payload"]), (deep("see data:a/b;base64,"), []), (deep("body password"), []), ("", []), (None, []),
    ]
    folder = put(spark, tmp_path, "source_records", [(i, t) for i, (t, _) in enumerate(planted)], "seq int, raw_json string")
    got = sorted((r["seq"], r["column"], r["pattern"]) for r in catalogue.QUERIES["secret_scan"](spark, folder).collect())
    assert got == [(i, "raw_json", name) for i, (_, names) in enumerate(planted) for name in names]


def test_records_without_a_title_are_rows(spark, tmp_path):
    texts = [
        '{"title": "Stated", "base_path": "/a/b", "content_id": "C-1", "description": "d", "locale": "cy", "document_type": "guide", "schema_name": "s", "updated_at": "2026"}',
        '{"base_path": "/guidance/rent-a-canal/", "redirects": [{"path": "/x"}]}', '\n\t{"title": "", "base_path": "/", "document_type": "gone"}', '{"title": null, "canonical_url": "https://else.example/x", "withdrawn_notice": {"a": 1}}',
        "[]", "{damaged", '"text"', None,
    ]
    folder = put(spark, tmp_path, "source_records", list(enumerate(texts)), "seq int, raw_json string")
    got = [tuple(r) for r in catalogue.QUERIES["normalised_records"](spark, folder).orderBy("seq").select(
        "seq", "url", "base_path", "content_id", "title", "description", "document_type", "schema_name", "language", "lifecycle", "routing_kind", "timestamp", "host_kind", "open"
    ).collect()]
    route = lambda url: f"dataset/route-{hashlib.sha256(url.encode()).hexdigest()[:24]}-en"
    site = "https://www.gov.example"
    assert got == [
        (0, site + "/a/b", "/a/b", "C-1", "Stated", "d", "guide", "s", "cy", "published", "canonical", "2026", "main", "dataset/c-1-cy"),
        (1, site + "/guidance/rent-a-canal/", "/guidance/rent-a-canal/", None, "Rent A Canal", "", "unknown", "unknown", "en", "redirect", "redirect", None, "main", route(site + "/guidance/rent-a-canal/")),
        (2, site + "/", "/", None, "Untitled", "", "gone", "gone", "en", "published", "tombstone", None, "main", route(site + "/")),
        (3, "https://else.example/x", "/", None, "Untitled", "", "unknown", "unknown", "en", "withdrawn", "canonical", None, "external", route("https://else.example/x")),
    ]


def test_terms_leave_stop_words_no_place(spark, tmp_path):
    words = [f"canal{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]
    items = [(1, " ".join(f"Which {w} should THE" for w in words)), (2, "The version of GOV.UK, which 2024 item a b river River")]
    folder = put(spark, tmp_path, "eval_items", items, "item_id int, text string")
    got = {r["item_id"]: r["terms"] for r in catalogue.QUERIES["lexical_terms"](spark, folder).collect()}
    assert got == {1: words[:32], 2: ["of", "river"]}


def test_pool_keeps_scarce_classes(spark, tmp_path):
    rows = [(f"i{n}", n % 50 == 0, n in (7, 8)) for n in range(400)] + [("i1", False, True), (None, True, True)]
    df = spark.createDataFrame(rows, "i string, rare boolean, few boolean")
    first = sorted({r[0] for r in rows if r[0]}, key=lambda i: hashlib.sha256(i.encode()).hexdigest())
    of = {n: [i for i in first if any(r[c] for r in rows if r[0] == i)] for n, c in (("rare", 1), ("few", 2))}
    want = {i: [n for n in of if i in of[n]] for i in {*first[:20], *of["rare"][:3], *of["few"][:3]}}
    got = assign.min_hash_pool(df, F.col("i"), {"rare": F.col("rare"), "few": F.col("few")}, 20, 3).collect()
    assert len(got) == len(want) and {r["identity"]: r["classes"] for r in got} == want and set(of["few"]) == {"i1", "i7", "i8"}
    records = ['{"base_path": "/a", "links": {"x": [], "y": [1]}}', '{"base_path": "/b", "links": {"x": []}, "locale": "cy"}', '{"content_id": "c", "details": {"attachments": [{}]}, "document_type": "gone"}', '{"base_path": "/d", "redirects": [{}], "links": {"available_translations": [{}]}}', "[]"]
    folder = put(spark, tmp_path, "source_records", list(enumerate(records)), "seq int, raw_json string")
    assert {r["identity"]: r["classes"] for r in catalogue.QUERIES["anchor_pool"](spark, folder).collect()} == {
        "url:https://www.gov.example/a:en": ["links"], "url:https://www.gov.example/b:cy": ["language"], "content:c:en": ["resources", "lifecycle"], "url:https://www.gov.example/d:en": ["links", "lifecycle", "language"],
    }


def test_browser_tokens(spark):
    df = spark.createDataFrame([(1, "Café straße smørrebrød Łódź e-mail the CAFE"), (2, "plain Text.v2 plain"), (3, None)], "i int, x string").orderBy("i")
    assert [r[0] for r in df.select(text.browser_tokens(F.col("x"))).collect()] == [["cafe", "stra", "sm", "rrebr", "odz", "e-mail"], ["plain", "text.v2"], None]


def test_index_faults_are_named(spark):
    found = spark.createDataFrame([(t, o, 20 - o, 1) for t in "abcdef" for o in range(5)], "token string, ordinal int, score int, mask int")
    lists, terms = index.capped(found, 3), index.lexicon(found)
    assert quality.index_faults(lists, terms, found, 3).count() == 0
    rank = F.when(F.col("token") == "b", 4 - F.col("rank")).when((F.col("token") == "c") & (F.col("rank") == 3), 4).otherwise(F.col("rank")).cast("int")
    score = F.when((F.col("token") == "d") & (F.col("rank") == 1), 99).otherwise(F.col("score"))
    bad = lists.select("token", "ordinal", score.alias("score"), "mask", rank.alias("rank")).union(spark.createDataFrame([("e", 3, 17, 1, 4)], "token string, ordinal int, score int, mask int, rank int"))
    wrong = terms.select("token", F.when(F.col("token") == "f", 6).otherwise(F.col("df")).alias("df"))
    got = {(r["token"], r["fault"]) for r in quality.index_faults(bad, wrong, found, 3).collect()}
    assert got == {("b", "order"), ("b", "entries"), ("c", "contiguity"), ("c", "entries"), ("d", "entries"), ("e", "cap"), ("e", "entries"), ("f", "df")}


def test_stream_gives_open_windows_and_files_in_no_order(spark, tmp_path):
    days = ["2026-01-09", "2026-01-01", "2026-01-10", "2026-01-01"]
    schema = "ts timestamp, event_type string"
    rows = [[(datetime.datetime.fromisoformat(f"{d}T{h:02}:30:00"), e) for h in (0, 1, 23) for e in ("a", "b", None)] for d in days]
    for i, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/one{i}")
        os.makedirs(f"{tmp_path}/in/events.parquet", exist_ok=True)
        os.rename(glob.glob(f"{tmp_path}/one{i}/part-*.parquet")[0], f"{tmp_path}/in/events.parquet/{i}.parquet")
        os.utime(f"{tmp_path}/in/events.parquet/{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    batch = spark.read.parquet(f"{tmp_path}/in/events.parquet").groupBy(F.date_trunc("hour", "ts").alias("window_start"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    counts = queue.windowed_counts(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/events.parquet"), "ts", ["event_type"], late=None)
    order = lambda df: sorted(map(str, df.select("window_start", "event_type", "n").collect()))
    assert order(queue.run_updates(counts, ["window_start", "event_type"])) == order(batch)
    folder = put(spark, tmp_path / "q", "events", [r for part in rows for r in part], schema)
    for f in os.listdir(f"{folder}/events.parquet"):
        if f.endswith(".parquet"):
            os.rename(f"{folder}/events.parquet/{f}", f"{folder}/x.parquet")
    shutil.rmtree(f"{folder}/events.parquet")
    os.rename(f"{folder}/x.parquet", f"{folder}/events.parquet")
    assert order(catalogue.QUERIES["stream_windowed_counts"](spark, folder)) == order(batch)
