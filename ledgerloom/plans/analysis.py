"""Queries: evaluation metrics, aggregates, samples, data quality, web sources, packing, streams; with the SQL that checks them."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import assign, evaluate, facets, packing, quality, windows
from ledgerloom.plans.text_search import _RECORDS, catalogue
from ledgerloom.session import scratch, table
from ledgerloom.sources import jsonl, web
from ledgerloom.streaming import queue

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_GRADED = "g AS (SELECT token AS query_id, rid AS item, max(CASE WHEN mask & 1 > 0 THEN 2 WHEN mask & 4 > 0 THEN 1 ELSE 0 END) AS grade, max(tf) AS tf FROM be WHERE token IS NOT NULL AND rid IS NOT NULL GROUP BY ALL)"


def _graded(spark, folder):
    grade = F.when(F.col("mask").bitwiseAND(1) > 0, 2).when(F.col("mask").bitwiseAND(4) > 0, 1).otherwise(0)
    rows = table(spark, folder, "be").where("token IS NOT NULL AND rid IS NOT NULL")
    return rows.groupBy(F.col("token").alias("query_id"), F.col("rid").alias("item")).agg(F.max(grade).alias("grade"), F.max("tf").alias("tf"))


@query(f"""WITH {_GRADED}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY tf DESC, item) AS rank FROM g),
 w AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY grade DESC, item) AS place FROM g WHERE grade > 0),
 ideal AS (SELECT query_id, count(*) AS n, sum(CASE WHEN place <= 10 THEN (pow(2, grade) - 1) / log2(place + 1) END) AS ideal FROM w GROUP BY query_id),
 h AS (SELECT query_id, count(*) AS hits, min(rank) AS first, sum((pow(2, grade) - 1) / log2(rank + 1)) AS dcg FROM r WHERE rank <= 10 AND grade > 0 GROUP BY query_id)
 SELECT query_id, round(coalesce(hits / n, 0), 9) AS recall, round(coalesce(1.0::DOUBLE / first, 0), 9) AS mrr, round(coalesce(dcg / ideal, 0), 9) AS ndcg FROM ideal LEFT JOIN h USING (query_id)""")
def ir_metrics(spark, folder):
    """Tokens as queries, their records ranked by term frequency, graded by the field that holds them."""
    from pyspark.sql.window import Window

    rows = _graded(spark, folder)
    results = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("tf"), "item")))
    return evaluate.ranking_metrics(results.select("query_id", "item", "rank"), rows.select("query_id", "item", "grade"))


@query("""WITH s AS (SELECT acquisition_id, list_distinct(list_filter(coalesce(child_taxons, []), lambda x: x IS NOT NULL)) AS f, list_distinct(list_filter(coalesce(second_level_browse_pages, []), lambda x: x IS NOT NULL)) AS w FROM (SELECT DISTINCT ON (acquisition_id) * FROM acquisition)),
 p AS (SELECT *, len(list_intersect(f, w)) AS b FROM s), q AS (SELECT acquisition_id, CASE WHEN len(f) = 0 THEN (len(w) = 0)::INT ELSE b / len(f) END AS p, CASE WHEN len(w) = 0 THEN (len(f) = 0)::INT ELSE b / len(w) END AS r FROM p)
 SELECT acquisition_id, round(p, 9) AS precision, round(r, 9) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 9) AS f1 FROM q""")
def set_scores(spark, folder):
    none = F.array().cast("array<string>")
    rows = table(spark, folder, "acquisition").dropDuplicates(["acquisition_id"])
    rows = rows.select("acquisition_id", F.filter(F.coalesce("child_taxons", none), lambda x: x.isNotNull()).alias("f"), F.filter(F.coalesce("second_level_browse_pages", none), lambda x: x.isNotNull()).alias("w"))
    return rows.select("acquisition_id", *evaluate.set_scores(rows, "f", "w"))


@query("""SELECT event_type, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99, count(value) AS n FROM events GROUP BY event_type""")
def percentile_nearest_rank(spark, folder):
    return evaluate.percentiles(table(spark, folder, "events"), ["event_type"], "value", [0.5, 0.95, 0.99])


@query("SELECT event_type, sum((value > 20 AND user_id < 75)::INT)::BIGINT AS tp, sum((value <= 20 AND user_id < 75)::INT)::BIGINT AS fp, sum((value > 20 AND user_id >= 75)::INT)::BIGINT AS fn, sum((value <= 20 AND user_id >= 75)::INT)::BIGINT AS tn FROM events GROUP BY event_type")
def confusion_matrix(spark, folder):
    return evaluate.confusion(table(spark, folder, "events"), ["event_type"], F.col("value") > 20, F.col("user_id") < 75)


_SLICES = ("o_orderstatus", "o_orderpriority", "year")


@query(" UNION ALL ".join(f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, segment, count(*) AS n, round(avg(o_totalprice), 6) AS avg_o_totalprice FROM (SELECT *, year(o_orderdate) AS year, c_mktsegment AS segment FROM orders JOIN customer ON o_custkey = c_custkey) GROUP BY ALL" for d in _SLICES))
def slice_analysis(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    rows = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate")).join(customers, "o_custkey")
    return evaluate.slices(rows, "segment", _SLICES, ["o_totalprice"])


@query("SELECT o_orderstatus, o_orderpriority, grouping_id(o_orderstatus, o_orderpriority) AS gid, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")
def slice_grouping_sets(spark, folder):
    table(spark, folder, "orders").createOrReplaceTempView("ledgerloom_orders")
    return spark.sql("SELECT o_orderstatus, o_orderpriority, grouping_id(o_orderstatus, o_orderpriority) AS gid, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM ledgerloom_orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")


_CODES = "[CASE WHEN closing_disposition IS NULL THEN 'no_closing' END, CASE WHEN coverage_disposition IS NULL THEN 'no_coverage' END, CASE WHEN attempts > 1 THEN 'retried' END]"


@query(f"""WITH w AS (SELECT DISTINCT work_id, work_kind, {_CODES} AS codes FROM work_items), e AS (SELECT DISTINCT work_id, work_kind, unnest(codes) AS code FROM w), f AS (SELECT * FROM e WHERE code IS NOT NULL)
 SELECT work_kind, code, count(*) AS n, list_sort(list(work_id) FILTER (rn <= 20)) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY work_kind, code ORDER BY work_id) AS rn FROM f) GROUP BY work_kind, code""")
def failure_codes(spark, folder):
    codes = F.array_compact(F.array(F.when(F.col("closing_disposition").isNull(), "no_closing"), F.when(F.col("coverage_disposition").isNull(), "no_coverage"), F.when(F.col("attempts") > 1, "retried")))
    rows = table(spark, folder, "work_items").select("work_id", "work_kind", codes.alias("codes")).distinct()
    return evaluate.failures(rows, "work_id", ["work_kind"], "codes")


@query("""WITH o AS (SELECT event_type AS system, user_id AS q, user_id % 10 AS cluster, round(avg(value), 6) AS metric FROM events GROUP BY ALL), p AS (SELECT q, metric AS base FROM o WHERE system = 'view'),
 d AS (SELECT system, cluster, metric - base AS d FROM o JOIN p USING (q) WHERE system <> 'view'), c AS (SELECT system, cluster, avg(d) AS m, count(*) AS n, sum((d > 0)::INT) AS wins, sum((d = 0)::INT) AS ties, sum((d < 0)::INT) AS losses FROM d GROUP BY ALL),
 w AS (SELECT system, sum(n)::BIGINT AS n_pairs, count(*) AS n_clusters, avg(m) AS mean, stddev_samp(m) AS sd, sum(wins)::BIGINT AS wins, sum(ties)::BIGINT AS ties, sum(losses)::BIGINT AS losses FROM c GROUP BY system)
 SELECT system, n_pairs, n_clusters, round(mean, 6) AS mean, round(sd, 6) AS sd, round(mean - 1.9599639845400536 * sd / sqrt(n_clusters), 6) AS low, round(mean + 1.9599639845400536 * sd / sqrt(n_clusters), 6) AS high,
 round(mean - 2.3939797998185104 * sd / sqrt(n_clusters), 6) AS low_corrected, round(mean + 2.3939797998185104 * sd / sqrt(n_clusters), 6) AS high_corrected, wins, ties, losses FROM w""")
def paired_comparison(spark, folder):
    rows = table(spark, folder, "events").groupBy(F.col("event_type").alias("system"), F.col("user_id").alias("q"), (F.col("user_id") % 10).alias("cluster")).agg(F.round(F.avg("value"), 6).alias("metric"))
    return evaluate.paired_comparison(rows, "q", "system", "cluster", "metric", "view", 3)


@query("SELECT item_id, system, edges, exact FROM eval_items, (VALUES ('proposal', true, true), ('keyword', false, false), ('no_edges', false, true)) s(system, edges, exact)")
def systems_matrix(spark, folder):
    return evaluate.systems_matrix(table(spark, folder, "eval_items").select("item_id"), {"proposal": {"edges": True, "exact": True}, "keyword": {}, "no_edges": {"exact": True}})


@query("SELECT record_shard, publisher, count(*) AS n FROM (SELECT DISTINCT ON (rid) * FROM records) WHERE publisher <> '' GROUP BY record_shard, publisher QUALIFY row_number() OVER (PARTITION BY record_shard ORDER BY count(*) DESC, publisher) = 1")
def primary_mode(spark, folder):
    """The most frequent publisher of each shard, ties by name: an aggregate of an aggregate."""
    counts = catalogue(spark, folder).where("publisher <> ''").groupBy("record_shard", "publisher").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("record_shard").agg(F.min(F.struct((-F.col("n")).alias("m"), "publisher")).alias("b"))
    return best.select("record_shard", F.col("b.publisher").alias("publisher"), (-F.col("b.m")).alias("n"))


@query("SELECT role, locale, count(*) AS n, count(DISTINCT url) AS urls, min(input_id) AS first_id, max(input_id) AS last_id, CAST(sum(length(record_json)) AS BIGINT) AS chars FROM inputs GROUP BY role, locale")
def group_statistics(spark, folder):
    return table(spark, folder, "inputs").groupBy("role", "locale").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("urls"), F.min("input_id").alias("first_id"), F.max("input_id").alias("last_id"), F.sum(F.length("record_json")).alias("chars"))


@query("SELECT candidate_key, count(*) AS n FROM candidates GROUP BY candidate_key HAVING count(*) > 1")
def duplicate_groups(spark, folder):
    return table(spark, folder, "candidates").groupBy("candidate_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT rid, CAST(bit_or(mask) AS INTEGER) AS mask, count(*) AS observations, list_sort(list(DISTINCT shard)) AS kinds FROM be WHERE mask > 0 GROUP BY rid")
def mask_union(spark, folder):
    return quality.audit_items(table(spark, folder, "be"), "rid", "mask", "shard")


@query("WITH i AS (SELECT rid, CAST(bit_or(mask) AS INTEGER) AS mask FROM be WHERE mask > 0 GROUP BY rid), r AS (SELECT rid, CAST(max(mask) AS INTEGER) AS review_mask FROM be GROUP BY rid) SELECT rid, mask FROM i WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.rid = i.rid AND r.review_mask & i.mask = i.mask)")
def unreviewed_items(spark, folder):
    """Items whose bits no single review covers."""
    rows = table(spark, folder, "be")
    items = quality.audit_items(rows, "rid", "mask", "shard").select("rid", "mask")
    return quality.unreviewed(items, rows.groupBy("rid").agg(F.max("mask").alias("review_mask")), "rid")


@query("SELECT lang, source, arg_min(doc_id, h) AS doc_id FROM (SELECT *, sha256(CAST(doc_id AS VARCHAR)) AS h FROM documents) GROUP BY lang, source")
def stratified_minhash(spark, folder):
    return assign.stratum_representatives(table(spark, folder, "documents"), ["lang", "source"], F.col("doc_id").cast("string"), ["doc_id"])


@query("SELECT doc_id FROM documents ORDER BY sha256(CAST(doc_id AS VARCHAR)) LIMIT 100")
def min_hash_sample(spark, folder):
    return assign.min_hash_sample(table(spark, folder, "documents").select("doc_id"), F.col("doc_id").cast("string"), 100)


@query("""WITH d AS (SELECT *, CAST(doc_id AS VARCHAR) AS k, sha256(CAST(doc_id AS VARCHAR)) AS h FROM documents), f AS (SELECT arg_min(k, h) AS k FROM d GROUP BY lang, source)
 SELECT k, 'stratum' AS how FROM f UNION ALL (SELECT k, 'fill' FROM d WHERE k NOT IN (SELECT k FROM f) ORDER BY h LIMIT (SELECT greatest(0, 200 - count(*)) FROM f))""")
def stratified_fill(spark, folder):
    return assign.stratified_sample(table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("k"), "lang", "source"), "k", ["lang", "source"], 200)


@query("""WITH d AS (SELECT doc_id, source, sha256(CAST(doc_id AS VARCHAR)) AS h FROM documents) SELECT a.doc_id, a.source, arg_min(b.doc_id, b.h) AS near_miss FROM d a JOIN d b ON a.source = b.source AND a.doc_id <> b.doc_id GROUP BY a.doc_id, a.source""")
def near_misses(spark, folder):
    return assign.near_misses(table(spark, folder, "documents").select("doc_id", "source"), "doc_id", "source")


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) <= 7")
def quota_suite(spark, folder):
    return assign.quota_suite(table(spark, folder, "documents"), ["source"], [F.desc("n_chars"), F.col("doc_id")], 7).select("doc_id", "source")


@query()
def least_cost_assignment(spark, folder):
    """Nations of each region matched to market segments at least cost."""
    customers = table(spark, folder, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.round(F.avg("c_acctbal"), 4).alias("cost"))
    regions = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    return assign.assign(customers.join(regions, "c_nationkey"), "n_regionkey", "c_nationkey", "c_mktsegment", "cost")


@query()
def greedy_anchors(spark, folder):
    """Suppliers of a nation choose parts, each part once a nation."""
    lines = table(spark, folder, "lineitem").join(table(spark, folder, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
    choices = lines.groupBy("s_nationkey", "l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("rank"))
    return assign.greedy_anchors(choices, "s_nationkey", "l_suppkey", "l_partkey", "rank")


@query("SELECT input_id, list_filter([CASE WHEN NOT coalesce(regexp_matches(fingerprint, '^[0-9a-f]{64}$'), false) THEN 'fingerprint' END, CASE WHEN NOT coalesce(regexp_matches(url, '^https://'), false) THEN 'url' END, CASE WHEN NOT coalesce(length(record_json) > 2, false) THEN 'record' END], lambda x: x IS NOT NULL) AS failed FROM inputs WHERE NOT (coalesce(regexp_matches(fingerprint, '^[0-9a-f]{64}$'), false) AND coalesce(regexp_matches(url, '^https://'), false) AND coalesce(length(record_json) > 2, false))")
def failed_checks(spark, folder):
    checks = {"fingerprint": F.col("fingerprint").rlike("^[0-9a-f]{64}$"), "url": F.col("url").rlike("^https://"), "record": F.length("record_json") > 2}
    return quality.failed_checks(table(spark, folder, "inputs"), "input_id", checks)


@query("WITH e AS (SELECT input_id FROM inputs WHERE NOT coalesce(regexp_matches(fingerprint, '^[0-9a-f]{64}$'), false)) SELECT input_id, (SELECT count(*) FROM e) AS n_errors FROM e ORDER BY input_id LIMIT 100")
def error_ledger(spark, folder):
    found = quality.failed_checks(table(spark, folder, "inputs"), "input_id", {"fingerprint": F.col("fingerprint").rlike("^[0-9a-f]{64}$")})
    return quality.error_ledger(found.select("input_id"), ["input_id"])


_TRIGGERS = {"date": r"(^|[^0-9])(19|20)[0-9]{2}([^0-9]|$)", "money": r"[0-9] marks", "contact": r"(?i)contact the ", "heading": r"(^|\n)#{1,6} ", "refused": r"refused"}


@query("SELECT doc_id, CAST(" + " + ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN {1 << i} ELSE 0 END" for i, p in enumerate(_TRIGGERS.values())) + " AS INTEGER) AS mask FROM documents WHERE text IS NOT NULL")
def trigger_mask(spark, folder):
    return table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", quality.trigger_mask(F.col("text"), _TRIGGERS).alias("mask"))


_PATTERNS = {"evidence": r"evidence_(sha256|url)", "attachment": r"\"content_type\": ?\"application/pdf\"", "closing": r"closing_probe"}


@query(" UNION ALL ".join(f"SELECT seq, 'raw_json' AS column, '{n}' AS pattern FROM source_records WHERE regexp_matches(raw_json, '{p}')" for n, p in _PATTERNS.items()))
def pattern_scan(spark, folder):
    """The scan that looks for secrets, with patterns that these data hold."""
    return quality.secret_scan(table(spark, folder, "source_records"), "seq", ["raw_json"], _PATTERNS)


@query()
def secret_scan(spark, folder):
    """Secrets, payloads and fields that must not be published, at any depth of the source records."""
    return quality.record_scan(table(spark, folder, "source_records"), "seq", "raw_json")


@query()
def nested_triggers(spark, folder):
    fields = {"attachment": ["attachments", "file_size"], "withdrawn": ["withdrawn_notice"], "constraint": ["constraints"], "redirect": ["redirects"]}
    mask = quality.nested_mask(fields)
    return table(spark, folder, "source_records").select("seq", mask("raw_json").alias("mask"))


@query()
def without_evidence(spark, folder):
    prune = quality.without_fields(["evidence", "evidence_url", "evidence_sha256", "retrieved_at"])
    return table(spark, folder, "source_records").select("seq", F.sha2(prune("raw_json"), 256).alias("fingerprint"))


@query()
def record_checksums(spark, folder):
    return table(spark, folder, "candidates").select("candidate_id", quality.canonical_sha256("candidate_json").alias("sha256"))


@query("""WITH p AS (SELECT DISTINCT title_key, url FROM records WHERE title_key <> '' AND url <> '') SELECT 'title_key' AS side, title_key AS value, count(*) AS n FROM p GROUP BY title_key HAVING count(*) > 1
 UNION ALL SELECT 'url', url, count(*) FROM p GROUP BY url HAVING count(*) > 1""")
def pairing_conflicts(spark, folder):
    return quality.pairing_conflicts(table(spark, folder, "records"), "title_key", "url")


@query("""WITH a AS (SELECT url AS path, max(record_sha256) AS s FROM inputs WHERE role = 't0_enumeration' GROUP BY url), b AS (SELECT url AS path, max(record_sha256) AS s FROM inputs WHERE role = 't1_enumeration' GROUP BY url)
 SELECT coalesce(a.path, b.path) AS path, CASE WHEN b.s IS NULL THEN 'only_left' WHEN a.s IS NULL THEN 'only_right' ELSE 'changed' END AS difference FROM a FULL JOIN b ON a.path = b.path WHERE a.s IS DISTINCT FROM b.s""")
def tree_differences(spark, folder):
    rows = table(spark, folder, "inputs")
    side = lambda role: rows.where(F.col("role") == role).groupBy(F.col("url").alias("path")).agg(F.max("record_sha256").alias("sha256"))
    return quality.tree_differences(side("t0_enumeration"), side("t1_enumeration"))


@query("""WITH c AS (SELECT o_orderstatus AS g, sha256(o_orderpriority || '|' || o_custkey) AS h, count(*) AS k FROM orders GROUP BY ALL),
 v6 AS (SELECT g, left(h, 6) AS p, sum(k) AS n, sha256(string_agg(h || '*' || k, '' ORDER BY h)) AS d FROM c GROUP BY ALL), v4 AS (SELECT g, left(p, 4) AS q, sum(n) AS n, sha256(string_agg(d, '' ORDER BY p)) AS d FROM v6 GROUP BY ALL),
 v2 AS (SELECT g, left(q, 2) AS r, sum(n) AS n, sha256(string_agg(d, '' ORDER BY q)) AS d FROM v4 GROUP BY ALL) SELECT g AS o_orderstatus, CAST(sum(n) AS BIGINT) AS n, sha256(string_agg(d, '' ORDER BY r)) AS digest FROM v2 GROUP BY g""")
def ordered_digest(spark, folder):
    return quality.ordered_digest(table(spark, folder, "orders"), ["o_orderstatus"], F.concat_ws("|", "o_orderpriority", "o_custkey"))


@query("SELECT o_custkey, count(*) AS n, sha256(string_agg(o_orderkey || '|' || o_orderpriority, chr(10) ORDER BY o_orderkey || '|' || o_orderpriority)) AS digest FROM orders GROUP BY o_custkey")
def plain_digest(spark, folder):
    """A digest of each customer's orders."""
    return quality.plain_digest(table(spark, folder, "orders"), ["o_custkey"], F.concat_ws("|", "o_orderkey", "o_orderpriority"))


@query()
def closing_watermark(spark, folder):
    """The latest time of each disposition, its own or of its closing evidence, as its text stood: by validity, instant and text. Texts that are no time sort lowest; without any text it is empty."""
    return quality.watermark(table(spark, folder, "work_items"), ["coverage_disposition"], "input_json")


@query(f"""WITH {_RECORDS}, u AS (SELECT lower(regexp_extract(url, '^\\s*[A-Za-z]+://([^/?#:\\s]+)', 1)) AS host, lower(regexp_extract(url, '^\\s*([A-Za-z]+)://', 1)) AS scheme, open AS route, document_type AS kind FROM records_once),
 c AS (SELECT host, kind, count(*) AS n FROM u WHERE host <> '' GROUP BY ALL), r AS (SELECT DISTINCT host, route FROM u WHERE host <> '')
 SELECT c.host, CASE WHEN c.host = 'www.gov.example' THEN 'main' WHEN c.host = 'gov.example' OR c.host LIKE '%.gov.example' THEN 'domain_boundary' ELSE 'external' END AS host_kind, CAST(sum(n) AS BIGINT) AS n_rows,
 (SELECT list_sort(list(DISTINCT scheme)) FROM u WHERE u.host = c.host) AS schemes, list_sort(list(concat_ws('=', coalesce(kind, ''), n))) AS kinds,
 (SELECT list(route ORDER BY route) FROM (SELECT route FROM r WHERE r.host = c.host ORDER BY route LIMIT 3)) AS examples FROM c GROUP BY c.host""")
def host_topology(spark, folder):
    return facets.host_topology(catalogue(spark, folder), "url", "open", "document_type", "www.gov.example", "gov.example")


def _pages(spark, folder):
    """A page made of each document, whatever it lacks: its whole text, escaped, as a link where it has a path; a script that is no text, JSON-LD. A null text has a null page."""
    rows = table(spark, folder, "documents")
    path, body = web.escaped(F.col("base_path")), web.escaped(F.col("text"))
    page = F.concat(
        F.lit('<html lang="'), F.coalesce(web.escaped(F.col("lang")), F.lit("")), F.lit('"><head><script type="application/ld+json">{"@type": "WebPage"}</script><style>b {}</style></head><body>'),
        F.coalesce(F.concat(F.lit('<a href="'), path, F.lit('">'), body, F.lit("</a>")), body), F.lit(' &amp; more <script>x()</script>, end<img src="/media/'), F.col("doc_id").cast("string"), F.lit('.png"></body></html>'),
    )
    return rows.select("doc_id", page.alias("html"))


@query("""SELECT doc_id, CAST(0 AS INTEGER) AS position, 'a' AS tag, base_path AS href FROM documents WHERE text IS NOT NULL AND base_path <> '' UNION ALL
 SELECT doc_id, CAST(coalesce(base_path <> '', false) AS INTEGER), 'img', '/media/' || doc_id || '.png' FROM documents WHERE text IS NOT NULL""")
def html_links(spark, folder):
    return web.page_links(web.page_parts(_pages(spark, folder), "doc_id", "html"), "doc_id").select("doc_id", "position", "tag", "href")


@query()
def html_text(spark, folder):
    return web.page_parts(_pages(spark, folder), "doc_id", "html").select("doc_id", "language", "text", "types")


@query("SELECT n_regionkey AS k, 'url' AS kind, 'https://www.gov.example/' || lower(n_name) AS loc, CASE WHEN n_nationkey % 3 > 0 THEN '2024-01-' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') END AS lastmod FROM nation")
def sitemap_rows(spark, folder):
    """Sitemaps in which every third entry has no date."""
    rows = table(spark, folder, "nation")
    dated = F.concat(F.lit("<lastmod>2024-01-"), F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0"), F.lit("</lastmod>"))
    entry = F.concat(F.lit("<url><loc> https://www.gov.example/"), F.lower("n_name"), F.lit(" </loc>"), F.when(F.col("n_nationkey") % 3 > 0, dated).otherwise(""), F.lit("</url>"))
    maps = rows.groupBy("n_regionkey").agg(F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.array_sort(F.collect_list(entry)), ""), F.lit("</urlset>")).alias("xml"))
    return web.sitemap_entries(maps.select(F.col("n_regionkey").alias("k"), "xml"), "k", "xml")


_ROBOTS = "User-agent: *\nDisallow: /news/\nAllow: /news/*-canal*\nDisallow: /*archives$\nDisallow: # nothing\nUser-agent: other\nDisallow: /"


@query("""SELECT base_path, CASE WHEN regexp_matches(base_path, '^/news/.*-canal') THEN true WHEN regexp_matches(base_path, '^/.*archives$') AND NOT starts_with(base_path, '/news/') THEN false
 WHEN regexp_matches(base_path, '^/.*archives$') THEN false WHEN starts_with(base_path, '/news/') THEN false ELSE true END AS allowed FROM (SELECT DISTINCT base_path FROM documents WHERE base_path IS NOT NULL)""")
def robots_filter(spark, folder):
    rows = table(spark, folder, "documents").where("base_path IS NOT NULL").select("base_path").distinct()
    return rows.select("base_path", web.robots_allows(F.col("base_path"), web.robots_rules(_ROBOTS)).alias("allowed"))


@query("SELECT doc_id, count(*) AS n_lines, CAST(sum(regexp_matches(line, '^#{1,6}[ \\t]')::INT) AS BIGINT) AS n_headings FROM (SELECT doc_id, unnest(string_split(regexp_replace(regexp_replace(text, '\\r\\n', chr(10), 'g'), '\\r', chr(10), 'g'), chr(10))) AS line FROM documents WHERE text IS NOT NULL) GROUP BY doc_id")
def markdown_headings(spark, folder):
    lines = web.markdown_lines(table(spark, folder, "documents").where("text IS NOT NULL"), "doc_id", "text")
    return lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.sum((F.col("level") > 0).cast("int")).alias("n_headings"))


_LINE = "SELECT doc_id, unnest(generate_series(0, len(ls) - 1)) AS pos, unnest(ls) AS line FROM (SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '\\r\\n', chr(10), 'g'), '\\r', chr(10), 'g'), chr(10)) AS ls FROM documents WHERE text IS NOT NULL)"
_PLACES = ", ".join(f"coalesce(max(CASE WHEN level = {n} THEN pos END) OVER w, -1) AS p{n}, last_value(CASE WHEN level = {n} THEN title END IGNORE NULLS) OVER w AS t{n}" for n in range(1, 7))
_ABOVE = ", ".join(f"CASE WHEN p{n} >= 0" + "".join(f" AND p{n} > p{m}" for m in range(1, n)) + f" THEN t{n} END" for n in range(1, 7))


@query(f"""WITH l AS ({_LINE}), h AS (SELECT doc_id, pos, length(regexp_extract(line, '^(#{{1,6}})[ \\t]', 1)) AS level, trim(regexp_replace(regexp_replace(line, '^#{{1,6}}[ \\t]+', ''), '[ \\t]+#*\\s*$', ''), ' ') AS title FROM l),
 s AS (SELECT doc_id, pos, {_PLACES} FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)),
 r AS (SELECT doc_id, CAST(pos AS INTEGER) AS position, array_to_string(list_filter([{_ABOVE}], lambda x: x IS NOT NULL), ' > ') AS path FROM s) SELECT * FROM r WHERE path <> ''""")
def heading_paths(spark, folder):
    """The headings above each line of each document."""
    lines = web.markdown_lines(table(spark, folder, "documents").where("text IS NOT NULL").dropDuplicates(["doc_id"]), "doc_id", "text")
    return windows.heading_paths(lines, "doc_id", "position", "level", "title").where("path <> ''")


@query("""WITH RECURSIVE o AS (SELECT source AS g, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents),
 p AS (SELECT g, doc_id, n_chars, n, 0 AS shard, n_chars AS used FROM o WHERE n = 1 UNION ALL SELECT o.g, o.doc_id, o.n_chars, o.n, CASE WHEN p.used + o.n_chars > 20000 THEN p.shard + 1 ELSE p.shard END, CASE WHEN p.used + o.n_chars > 20000 THEN o.n_chars ELSE p.used + o.n_chars END FROM p JOIN o ON o.g = p.g AND o.n = p.n + 1)
 SELECT g AS source, doc_id, n_chars, CAST(shard AS INTEGER) AS shard FROM p""")
def greedy_shards(spark, folder):
    return packing.greedy_shards(table(spark, folder, "documents").select("source", "doc_id", "n_chars"), "source", ["doc_id"], "n_chars", 20_000)


@query("WITH r AS (SELECT doc_id, n_chars, sum(n_chars) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS running FROM documents) SELECT CAST(floor((running - n_chars) / 50000) AS BIGINT) AS shard, count(*) AS n, min(doc_id) AS first_key, max(doc_id) AS last_key FROM r GROUP BY 1")
def wide_shards(spark, folder):
    packed = packing.greedy_shards_wide(table(spark, folder, "documents").select("doc_id", "n_chars"), ["doc_id"], "n_chars", 50_000)
    return packing.shard_ranges(packed, ["shard"], "doc_id")


@query("SELECT seq, disposition FROM source_records")
def jsonl_round_trip(spark, folder):
    """Written as canonical JSON lines, its manifest verified, read again."""
    path = scratch(spark, "jsonl")
    packing.write_canonical(table(spark, folder, "source_records").select("seq", "disposition"), path, ["seq"])
    return jsonl.read_verified(spark, path, packing.manifest(spark, path), "disposition string, seq long")


@query("SELECT entity_class, count(*) AS n FROM candidates GROUP BY entity_class")
def paged_source(spark, folder):
    """A paged interface read as a data source, one partition a leaf; here its pages are those of a parquet file."""
    import json

    from ledgerloom.sources.paged import PagedSource

    spark.dataSource.register(PagedSource)
    files = f"{folder}/candidates.parquet"
    leaves = [json.dumps([files, i, 4]) for i in range(4)]
    rows = spark.read.format("paged").schema("entity_class string").option("leaves", json.dumps(leaves)).option("fetch", "ledgerloom.plans.analysis:page_of_file").option("limit", "500").load()
    return rows.groupBy("entity_class").agg(F.count(F.lit(1)).alias("n"))


@lru_cache(maxsize=1)
def _classes(path: str) -> list:
    import pyarrow.dataset as ds

    return ds.dataset(path.removeprefix("file://")).to_table(columns=["entity_class"]).column(0).to_pylist()


def page_of_file(leaf: str, offset: int, limit: int) -> list[dict]:
    """Rows offset.. of every n-th row of a parquet file or folder, as a service would page them. The file must be where the executors can open it."""
    import json

    path, part, parts = json.loads(leaf)
    rows = _classes(path)
    return [{"entity_class": x} for x in rows[part::parts][offset : offset + limit]]


@query("SELECT user_id, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id")
def stream_first_seen(spark, folder):
    """Insert-or-ignore over a stream; the answer is the batch one."""
    path = scratch(spark, "stream")
    seen = queue.run_available(queue.first_seen(queue.stream_of(spark, folder, "events").select("user_id", "event_type"), ["user_id", "event_type"]), f"{path}/rows", f"{path}/checkpoint")
    return seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_windowed_counts(spark, folder):
    """Hourly counts of a stream at its end, open windows too. The input is finite and its files come in no order of time, so nothing counts as late."""
    counts = queue.windowed_counts(queue.stream_of(spark, folder, "events"), "ts", ["event_type"], late=None)
    return queue.run_updates(counts, ["window_start", "event_type"])


@query()
def stream_task_states(spark, folder):
    """A state machine over a stream: views may lead to clicks, clicks to purchases, errors to views."""
    moves = {"": ["view", "click", "error", "purchase"], "view": ["click", "error"], "click": ["purchase", "view"], "purchase": ["view"], "error": ["view"]}
    events = queue.stream_of(spark, folder, "events").select(F.col("user_id").cast("string").alias("task"), F.col("event_id").alias("sequence"), F.col("event_type").alias("to"))
    return queue.run_updates(queue.task_states(events, moves), ["task"], "sequence")
