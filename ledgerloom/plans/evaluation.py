"""Queries: enumerator records, exports, filters, release checks, retrieval systems; with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.text import stable_id
from ledgerloom.operators import assign, enumerators, evaluate, facets, graph, quality, stored, systems
from ledgerloom.plans.relations import _SU, identifier_index
from ledgerloom.plans.text_search import _RECORDS, _index, catalogue
from ledgerloom.session import durable, table
from ledgerloom.sources import web

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_PATH = "coalesce(nullif(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), ''), nullif(CASE WHEN starts_with({0}, '/') THEN regexp_extract({0}, '^([^?#]*)', 1) END, ''), '/')"
_NAME = "nullif(array_to_string(list_transform(string_split(replace(list_extract(string_split(regexp_replace(p, '/+$', ''), '/'), -1), '-', ' '), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' '), '')"


@query(f"""WITH raw AS (SELECT 'search' AS s, 'search_result' AS k, canonical_path AS url, search_index_id AS native, content_id, parent_title AS title, document_type, CAST(NULL AS VARCHAR) AS schema_name, 'en' AS locale, CAST(NULL AS VARCHAR) AS ts, retrieved_at, evidence_url FROM search_parts
 UNION ALL SELECT 'sitemap', 'route', url, NULL, NULL, NULL, 'sitemap_route', 'unknown', 'en', strftime(delivered_at, '%Y-%m-%d'), NULL, NULL FROM inputs
 UNION ALL SELECT 'content', 'identity', base_path, content_id, content_id, title, document_type, NULL, locale, public_timestamp, NULL, NULL FROM acquisition
 UNION ALL SELECT 'organisations', 'organisation', 'https://www.gov.example/organisations/' || o, o, o, NULL, 'organisation', 'organisation', 'en', NULL, NULL, NULL FROM (SELECT DISTINCT unnest(organisations) AS o FROM acquisition) WHERE o <> ''),
 a AS (SELECT *, {_SU.format("url")} AS u, coalesce(nullif(locale, ''), 'en') AS l FROM raw WHERE url <> ''), b AS (SELECT *, coalesce(nullif(native, ''), u) AS own, {_PATH.format("u")} AS p FROM a)
 SELECT DISTINCT sha256(k || chr(0) || own || chr(0) || l || chr(0) || u) AS candidate_key, k AS entity_class, own AS source_native_id, s AS source_id, nullif(content_id, '') AS content_id, u AS canonical_url, p AS base_path,
 coalesce(nullif(title, ''), {_NAME}, 'Untitled') AS title, '' AS description, coalesce(nullif(document_type, ''), 'unknown') AS document_type, coalesce(nullif(schema_name, ''), nullif(document_type, ''), 'unknown') AS schema_name, l AS locale, nullif(ts, '') AS timestamp,
 nullif(retrieved_at, '') AS retrieved_at, nullif(evidence_url, '') AS evidence_url FROM b""")
def enumerated_records(spark, folder):
    """The rows of four enumerators in the one shape of records."""
    sitemap = table(spark, folder, "inputs").select(F.col("url").alias("loc"), F.date_format("delivered_at", "yyyy-MM-dd").alias("lastmod"))
    pages = table(spark, folder, "acquisition")
    bodies = pages.select(F.explode("organisations").alias("content_id")).where("content_id <> ''").distinct().select("content_id", F.concat(F.lit("https://www.gov.example/organisations/"), "content_id").alias("url"), F.lit(None).cast("string").alias("title"))
    return enumerators.enumerated(enumerators.from_search(table(spark, folder, "search_parts")), enumerators.from_sitemap(sitemap), enumerators.from_content(pages), enumerators.from_organisations(bodies))


@query(f"WITH {_RECORDS} SELECT * EXCLUDE (evidence_url) FROM records_once")
def result_documents(spark, folder):
    return enumerators.result_documents(catalogue(spark, folder))


@query(f"WITH {_RECORDS} SELECT " + ", ".join(f'{c} AS "{n}"' for n, c in enumerators.EXPORT.items()) + " FROM records_once")
def export_rows(spark, folder):
    return enumerators.export_rows(catalogue(spark, folder))


def _text(c: str, otherwise: str) -> str:
    return f"coalesce(nullif(trim(regexp_replace({c}, '\\s+', ' ', 'g'), ' '), ''), '{otherwise}')"


@query(f"""WITH {_RECORDS} SELECT open AS id, {_text("title", "Untitled")} AS title, {_text("description", "")} AS description, {_text("publisher", "unknown")} AS publisher, {_text("document_type", "unknown")} AS type, {_text("language", "en")} AS language,
 {_text("lifecycle", "published")} AS status, {_text("url", "")} AS canonical_url, list_sort(list_distinct(json_extract_string(tags, '$[*]'))) AS tags, coalesce(starts_with(confidence, 'source-observed'), false) AS source_observed,
 coalesce(nullif(upper(left(regexp_replace(title, '[^A-Za-z0-9]', '', 'g'), 1)), ''), '#') AS initial FROM records_once""")
def client_records(spark, folder):
    return enumerators.client_records(catalogue(spark, folder)).withColumn("tags", F.array_sort("tags"))


@query(f"WITH {_RECORDS} SELECT rid, confidence FROM records_once WHERE confidence NOT LIKE '%inferred%'")
def asserted_only(spark, folder):
    """Records whose status isn't an inferred one; a null status isn't known to be asserted."""
    return catalogue(spark, folder).where(~F.col("confidence").like("%inferred%")).select("rid", "confidence")


@query("SELECT DISTINCT p AS path, regexp_matches(p, '^(/api/|/search|/email-signup|/print/)') AS denied FROM (SELECT base_path AS p FROM acquisition UNION ALL SELECT '/search' || base_path FROM acquisition UNION ALL SELECT '/api' || base_path FROM acquisition) WHERE p IS NOT NULL")
def denied_routes(spark, folder):
    """Paths of pages, of their API and of searches below them, with whether they may be read."""
    paths = table(spark, folder, "acquisition").select(F.explode(F.array(F.col("base_path"), F.concat(F.lit("/search"), "base_path"), F.concat(F.lit("/api"), "base_path"))).alias("path")).where("path IS NOT NULL")
    return paths.distinct().select("path", web.denied(F.col("path")).alias("denied"))


_SUFFIX = "('pdf', 'csv', 'ods', 'odt', 'xls', 'xlsx', 'doc', 'docx', 'zip', 'json', 'xml', 'epub', 'geojson', 'ics', 'ppt', 'pptx', 'rdf', 'rtf', 'tsv', 'txt')"


@query(f"""WITH u AS (SELECT DISTINCT url, unnest(['', '.pdf', '.PDF?x=1', '/a.b/c', '.html']) AS e, unnest(['text/html', '', 'text/html', '', 'application/json']) AS mime FROM records), l AS (SELECT url || e AS url, mime FROM u)
 SELECT url, mime, regexp_extract(lower(list_extract(string_split(regexp_replace(url, '[?#].*$', ''), '/'), -1)), '\\.([a-z0-9]+)$', 1) IN {_SUFFIX} OR lower(mime) NOT IN ('', 'text/html', 'application/xhtml+xml') AS is_resource FROM l""")
def resource_links(spark, folder):
    """Addresses in several spellings and declared types, with whether they are resources."""
    forms = F.arrays_zip(F.array(*[F.lit(x) for x in ("", ".pdf", ".PDF?x=1", "/a.b/c", ".html")]).alias("e"), F.array(*[F.lit(x) for x in ("text/html", "", "text/html", "", "application/json")]).alias("m"))
    rows = table(spark, folder, "records").select("url").distinct().select("url", F.explode(forms).alias("f")).select(F.concat("url", "f.e").alias("url"), F.col("f.m").alias("mime"))
    return rows.select("url", "mime", web.is_resource(F.col("url"), F.col("mime"), ["assets.gov.example"], F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/?#]+)", 1))).alias("is_resource"))


_ASKS = ["", " Can you GUARANTEE it without the facts?", " A guarantee, please.", " This is not enough to answer safely.", " My personal outcome?"]


@query("WITH q AS (SELECT item_id, unnest([" + ", ".join(f"'{a}'" for a in _ASKS) + "]) AS ask, text FROM eval_items), w AS (SELECT item_id, ask, lower(text || ask) AS t FROM q) SELECT item_id, ask, (contains(t, 'guarantee') AND (contains(t, 'no case facts') OR contains(t, 'without the facts') OR contains(t, 'personal outcome'))) OR (contains(t, 'not enough to answer') AND contains(t, 'safely')) AS abstains FROM w")
def abstentions(spark, folder):
    """Every evaluation item with several endings, and whether it must be left unanswered."""
    rows = table(spark, folder, "eval_items").select("item_id", "text", F.explode(F.array(*[F.lit(a) for a in _ASKS])).alias("ask"))
    return rows.select("item_id", "ask", systems.abstains(F.concat("text", "ask")).alias("abstains"))


@query()
def link_contexts(spark, folder):
    """The links of all documents with the paragraph each stands in, and an id made of address and paragraph."""
    found = web.markdown_links_in_context(table(spark, folder, "documents"), "doc_id", "text")
    return found.select("doc_id", "paragraph", "position", "url", stable_id("LINK", F.col("url"), F.col("context")).alias("link_id"))


@query("""WITH s AS (SELECT c_mktsegment AS side, c_nationkey AS member, count(*) AS score FROM customer GROUP BY ALL), p AS (SELECT a.side AS a, b.side AS b FROM (SELECT DISTINCT side FROM s) a JOIN (SELECT DISTINCT side FROM s) b ON a.side < b.side)
 SELECT a, b, member, score FROM (SELECT p.a, p.b, l.member, CAST(l.score + r.score AS BIGINT) AS score, row_number() OVER (PARTITION BY p.a, p.b ORDER BY l.score + r.score DESC, l.member) AS n FROM p JOIN s l ON l.side = p.a JOIN s r ON r.side = p.b AND r.member = l.member) WHERE n = 1""")
def best_for_pairs(spark, folder):
    """For each pair of market segments the nation with most customers in both."""
    scores = table(spark, folder, "customer").groupBy(F.col("c_mktsegment").alias("side"), F.col("c_nationkey").alias("member")).agg(F.count(F.lit(1)).alias("score"))
    pairs = assign.combinations(scores.withColumn("g", F.lit(1)), "g", "side").select("a", "b")
    return assign.best_for_pair(pairs, scores, "member", "score")


@query("SELECT * FROM (SELECT unnest(['attempts', 'linked_discovered', 'probe_performed']) AS \"column\", unnest([coalesce(sum(attempts), 0)::DOUBLE, coalesce(sum(linked_discovered), 0)::DOUBLE, coalesce(sum(probe_performed), 0)::DOUBLE]) AS total FROM work_items) WHERE total <> 0")
def usage_faults(spark, folder):
    """Counters whose total isn't zero."""
    return systems.usage_faults(table(spark, folder, "work_items"), ["attempts", "linked_discovered", "probe_performed"])


_GATE = f"""WITH {_RECORDS}, s AS (SELECT publisher, max((lifecycle = 'withdrawn')::INT) AS w FROM records_once WHERE publisher IS NOT NULL GROUP BY publisher), v AS (SELECT title_key, count(*) AS n, sum((language = 'en')::INT) AS a FROM records_once GROUP BY title_key),
 c AS (SELECT rid, coalesce(regexp_matches(evidence_sha256, '^[0-9a-f]{{64}}$'), false) AS e, s.publisher IS NOT NULL AS k, coalesce(w = 0, false) AS o, coalesce(v.n = 1, false) AS r1, coalesce(v.a = 1, false) AS ra, language = 'cy' AS lifted FROM records_once r LEFT JOIN s USING (publisher) LEFT JOIN v USING (title_key)),
 f AS (SELECT rid, list_sort(list_filter([CASE WHEN NOT e THEN 'evidence' END, CASE WHEN NOT k THEN 'source_known' END, CASE WHEN NOT o AND NOT coalesce(lifted, false) THEN 'source_current' END, CASE WHEN NOT r1 THEN 'claim_reviewed_once' END, CASE WHEN NOT ra THEN 'claim_accepted' END], lambda x: x IS NOT NULL)) AS failed FROM c)
 SELECT rid AS citation_id, len(failed) = 0 AS released, failed FROM f"""


@query(_GATE)
def citation_gate(spark, folder):
    """Records as citations of their publishers, each record a review of its title: which may be released, and what holds the others."""
    rows = catalogue(spark, folder)
    citations = rows.select(F.col("rid").alias("citation_id"), F.col("publisher").alias("source_id"), F.col("title_key").alias("claim_id"), "evidence_sha256")
    sources = rows.where("publisher IS NOT NULL").select(F.col("publisher").alias("source_id"), (F.col("lifecycle") == "withdrawn").alias("withdrawn"))
    reviews = rows.select(F.col("title_key").alias("claim_id"), (F.col("language") == "en").alias("accepted"))
    waivers = rows.where("language = 'cy'").select(F.col("rid").alias("citation_id"), F.lit("source_current").alias("check"))
    return quality.citation_gate(citations, sources, reviews, waivers, {"evidence": F.col("evidence_sha256").rlike("^[0-9a-f]{64}$")})


@query(f"""WITH {_RECORDS}, ix AS (SELECT DISTINCT identifier, kind, rid FROM (SELECT open AS identifier, 'open' AS kind, rid FROM records_once UNION ALL SELECT url, 'url', rid FROM records_once UNION ALL SELECT content_id, 'content_id', rid FROM records_once) WHERE identifier <> ''),
 asked AS (SELECT DISTINCT identifier, CASE WHEN starts_with(identifier, 'dataset/') THEN 'open' WHEN starts_with(identifier, 'https://') THEN 'url' END AS kind FROM (SELECT open AS identifier FROM records UNION ALL SELECT url FROM records UNION ALL SELECT content_id FROM records UNION ALL SELECT 'dataset/none') WHERE identifier IS NOT NULL),
 m AS (SELECT a.identifier, a.kind, count(DISTINCT rid) AS n, min(rid) AS rid FROM asked a LEFT JOIN ix ON ix.identifier = a.identifier AND (a.kind IS NULL OR ix.kind = a.kind) GROUP BY a.identifier, a.kind)
 SELECT identifier, kind, CASE WHEN n = 1 THEN rid END AS rid, CASE WHEN n = 0 THEN 'unknown' WHEN n > 1 THEN 'ambiguous' END AS fault FROM m""")
def one_match(spark, folder):
    """All identifiers of the records, their kinds taken from how they begin: the one row each names, or why there is none."""
    rows = table(spark, folder, "records")
    asked = rows.select(F.explode(F.array("open", "url", "content_id")).alias("identifier")).where("identifier IS NOT NULL").union(spark.createDataFrame([("dataset/none",)], "identifier string"))
    return graph.one_match(asked.withColumn("kind", F.lit(None).cast("string")), identifier_index(spark, folder), "rid", {"dataset/": "open", "https://": "url"})


@query()
def posting_partitions(spark, folder):
    """The partitions of the stored postings by exact bytes: a token never stands in two."""
    lists = _index(spark, folder).table("postings")
    sizes = stored.entry_bytes(lists).join(lists.select("shard", "token", "part").distinct(), ["shard", "token"])
    return sizes.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n_tokens"), F.sum("bytes").alias("bytes"), F.min("token").alias("first_token"), F.max("token").alias("last_token"))


_ASIDE = ["language", "document_type", "schema_name", "lifecycle", "jurisdiction", "publisher", "title_key"]


def _questions(rows):
    """A known-item question for every record whose id is divisible by 100, with what slices go by."""
    asked = F.concat(F.lit('Which record is "'), "title", F.lit('" published by '), F.coalesce("publisher", F.lit("nobody")), F.lit("?"))
    return rows.where("rid % 100 = 0").select(F.col("rid").cast("long").alias("query_id"), asked.alias("text"), *_ASIDE)


def _outcomes(spark, folder):
    rows = systems.searchable(catalogue(spark, folder)).select("rid", "title", "url", "evidence_sha256", *_ASIDE, *systems.LAYERS, "single")
    rows = durable(rows, "records-once")  # repeated rows are removed and texts are cut into tokens only once
    questions = durable(_questions(rows), "questions")
    first = rows.where("publisher <> ''").groupBy("publisher").agg(F.min("rid").alias("target"))
    edges = rows.select("rid", "publisher").join(first, "publisher").where("rid <> target").select(F.col("rid").alias("source"), "target")
    results = systems.run_systems(list(systems.SYSTEMS), questions.select("query_id", "text"), rows, edges)
    own = questions.select("query_id", F.col("query_id").alias("item"), F.lit(2).alias("grade"))
    same = questions.select("query_id", "title_key").join(rows.select(F.col("rid").cast("long").alias("item"), "title_key"), "title_key").where("query_id <> item").select("query_id", "item", F.lit(1).alias("grade"))
    return systems.outcomes(questions.drop("title_key"), durable(results, "system-results"), own.unionByName(same))


@query()
def system_outcomes(spark, folder):
    """The ten retrieval systems on all questions: what each scores on each."""
    return _outcomes(spark, folder).drop("text")


@query()
def system_slices(spark, folder):
    """Means of all measures over the values of every dimension, by system; the dimension `all` is the whole."""
    rows = durable(_outcomes(spark, folder), "outcomes").withColumn("all", F.lit("all"))
    return evaluate.slices(rows, "system", ["all", "language", "document_type", "schema_name", "lifecycle", "jurisdiction", "publisher"], ["recall", "mrr", "ndcg", "n_results", "abstained"])


@query()
def topology_faults(spark, folder):
    """A written host topology against one made anew; it was written without Welsh records on purpose."""
    def made(rows):
        return facets.host_topology(rows, "url", "open", "document_type", "www.gov.example", "gov.example")

    rows = catalogue(spark, folder)
    return quality.topology_faults(durable(made(rows.where("language <> 'cy'")), "topology"), made(rows))
