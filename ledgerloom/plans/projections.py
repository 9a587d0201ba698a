"""Queries: projections of source records, linked data, exports, staged search, three-way delta; with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.identity import predicate_name
from ledgerloom.operators import assign, evaluate, facets, graph, packing, projection, snapshots
from ledgerloom.plans.relations import _EDGES, trade_edges
from ledgerloom.plans.text_search import _RECORDS, _SEARCH, _index, _results, catalogue
from ledgerloom.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_AT = "nullif(json_extract_string(raw_json, '$.{}'), '')"
_V = "SELECT * FROM source_records WHERE json_valid(raw_json) AND starts_with(trim(raw_json), '{')"


_PATH = f"coalesce({_AT.format('base_path')}, '/')"
_LAST = f"list_extract(string_split(regexp_replace({_PATH}, '/+$', ''), '/'), -1)"
_NAMED = f"array_to_string(list_transform(string_split(replace({_LAST}, '-', ' '), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')"


@query(f"""WITH v AS ({_V}), p AS (SELECT *, coalesce({_AT.format("canonical_url")}, 'https://www.gov.example' || {_PATH}) AS u, coalesce({_AT.format("document_type")}, 'unknown') AS k, coalesce({_AT.format("locale")}, 'en') AS l,
 coalesce(json_extract_string(raw_json, '$.redirects'), '[]') <> '[]' AS red, json_extract_string(raw_json, '$.content_id') AS cid, lower(regexp_extract(coalesce({_AT.format("canonical_url")}, 'https://www.gov.example/'), '^\\s*[A-Za-z]+://([^/?#:\\s]+)', 1)) AS host FROM v)
 SELECT seq, 'dataset/' || coalesce(nullif(lower(regexp_replace(coalesce(cid, ''), '[^A-Za-z0-9-]', '', 'g')), ''), 'route-' || left(sha256(u), 24)) || '-' || lower(l) AS open, u AS url, {_PATH} AS base_path, cid AS content_id,
 coalesce({_AT.format("title")}, nullif({_NAMED}, ''), 'Untitled') AS title, coalesce(json_extract_string(raw_json, '$.description'), '') AS description, k AS document_type, coalesce({_AT.format("schema_name")}, k) AS schema_name, l AS language,
 CASE WHEN red THEN 'redirect' WHEN json_extract_string(raw_json, '$.withdrawn_notice') IS NOT NULL THEN 'withdrawn' ELSE 'published' END AS lifecycle,
 CASE WHEN red THEN 'redirect' WHEN k IN ('external_content', 'external_boundary') THEN 'external_boundary' WHEN k = 'gone' THEN 'tombstone' ELSE 'canonical' END AS routing_kind,
 coalesce({_AT.format("public_updated_at")}, {_AT.format("updated_at")}, {_AT.format("lastmod")}, {_AT.format("first_published_at")}) AS timestamp,
 CASE WHEN host = 'www.gov.example' THEN 'main' WHEN host = 'gov.example' OR host LIKE '%.gov.example' THEN 'domain_boundary' ELSE 'external' END AS host_kind FROM p""")
def normalised_records(spark, folder):
    """All source records that are JSON objects as catalogue rows; those without a title are named by their path, else Untitled."""
    return projection.normalised(table(spark, folder, "source_records"), "seq", "raw_json")


@query()
def anchor_pool(spark, folder):
    """A min-hash pool of the source records, with those of the scarce classes: links, resources, lifecycle, language."""
    rows = projection.normalised(table(spark, folder, "source_records"), "seq", "raw_json").join(table(spark, folder, "source_records").select("seq", "raw_json"), "seq")
    at = lambda p: F.get_json_object("raw_json", "$." + p)
    holds = lambda p: ~F.coalesce(at(p), F.lit("")).isin("", "[]", "{}", "false", "0")
    own = F.when(F.col("content_id") != "", F.concat(F.lit("content:"), "content_id", F.lit(":"), "language")).otherwise(F.concat(F.lit("url:"), "url", F.lit(":"), "language"))
    links = F.exists(F.map_values(F.from_json(at("links"), "map<string,string>")), lambda v: v.rlike(r"^\[\s*[^\]\s]"))
    return assign.min_hash_pool(
        rows, own,
        {"links": links, "resources": holds("details.attachments"), "lifecycle": F.col("document_type").isin("redirect", "gone", "vanish", "substitute") | holds("redirects"), "language": (F.col("language") != "en") | holds("links.available_translations")},
    )


@query(f"""WITH v AS (SELECT seq, CAST(json_extract_string(raw_json, '$.details.attachments') AS JSON) AS a FROM ({_V}) WHERE starts_with(json_extract_string(raw_json, '$.details.attachments'), '[')),
 e AS (SELECT seq, CAST(i AS INTEGER) AS position, json_extract(a, '$[' || i || ']') AS x FROM v, range(0, 50) r(i) WHERE i < json_array_length(a))
 SELECT seq, position, json_extract_string(x, '$.id') AS id, json_extract_string(x, '$.content_type') AS content_type, json_extract_string(x, '$.url') AS url FROM e WHERE regexp_matches(json_extract_string(x, '$.url'), '^https?://')""")
def attachment_rows(spark, folder):
    rows = table(spark, folder, "source_records").where(F.try_parse_json("raw_json").isNotNull())
    return projection.attachment_rows(rows, "seq", "raw_json").select("seq", "position", "id", "content_type", "url")


@query(f"""WITH v AS (SELECT seq, CAST(json_extract_string(raw_json, '$.redirects') AS JSON) AS a FROM ({_V}) WHERE starts_with(json_extract_string(raw_json, '$.redirects'), '[')),
 e AS (SELECT seq, CAST(i AS INTEGER) AS ordinal, json_extract(a, '$[' || i || ']') AS x FROM v, range(0, 50) r(i) WHERE i < json_array_length(a))
 , p AS (SELECT seq, ordinal, json_extract_string(x, '$.path') AS path, json_extract_string(x, '$.destination') AS destination FROM e)
 SELECT seq, ordinal, path, destination, CASE WHEN regexp_matches(destination, '^https?://') THEN destination WHEN starts_with(destination, '/') THEN 'https://www.gov.example' || destination ELSE '' END AS destination_url,
 CASE WHEN regexp_matches(coalesce(nullif(destination, ''), path), '^https?://') THEN coalesce(nullif(destination, ''), path) ELSE 'https://www.gov.example' || coalesce(nullif(destination, ''), path) END AS edge_target FROM p""")
def redirect_rows(spark, folder):
    rows = table(spark, folder, "source_records").where(F.try_parse_json("raw_json").isNotNull())
    return projection.redirect_rows(rows, "seq", "raw_json")


@query()
def boundary_references(spark, folder):
    """Links of work items to pages outside the acquisition table, counted by predicate."""
    links = graph.json_links(table(spark, folder, "work_items"), "work_id", "input_json")
    seeds = table(spark, folder, "acquisition").select("content_id", F.col("base_path").alias("url")).distinct()
    return projection.boundary_references(links, seeds).groupBy("predicate").agg(F.count(F.lit(1)).alias("n"))


def _nodes(spark, folder):
    own = projection.iri("https://id.example/", F.lit("record"), F.col("rid"))
    publisher = F.when(F.col("publisher") != "", projection.iri("https://id.example/", F.lit("publisher"), F.col("publisher")))
    assertion = F.when(F.col("publisher") != "", projection.iri("https://id.example/", F.lit("assertion"), F.col("rid")))
    return projection.linked_nodes(
        catalogue(spark, folder),
        {"Record": (own, {"title": F.col("title"), "identifier": F.col("content_id")}), "Organisation": (publisher, {"name": F.col("publisher")}), "Assertion": (assertion, {"subject": F.struct(own.alias("@id")), "object": F.struct(publisher.alias("@id"))})},
    )


@query(f"""WITH {_RECORDS} SELECT 'https://id.example/record/' || rid AS id, 'Record' AS type FROM records_once UNION ALL SELECT 'https://id.example/assertion/' || rid, 'Assertion' FROM records_once WHERE publisher <> ''
 UNION ALL SELECT 'https://id.example/publisher/' || replace(publisher, ' ', '%20'), 'Organisation' FROM records_once WHERE publisher <> ''""")
def linked_nodes(spark, folder):
    return _nodes(spark, folder).select("id", "type")


@query(f"WITH {_RECORDS} SELECT DISTINCT 'https://id.example/assertion/' || rid AS id, unnest(['https://id.example/record/' || rid, 'https://id.example/publisher/' || replace(publisher, ' ', '%20')]) AS reference FROM records_once WHERE publisher <> ''")
def node_references(spark, folder):
    return projection.node_references(_nodes(spark, folder))


@query(f"WITH {_RECORDS} SELECT 'https://id.example/assertion/' || rid AS id, 'https://id.example/publisher/' || replace(publisher, ' ', '%20') AS reference FROM records_once WHERE publisher <> '' AND language = 'cy' AND publisher NOT IN (SELECT publisher FROM records_once WHERE language <> 'cy' AND publisher IS NOT NULL)")
def dangling_references(spark, folder):
    """References of Welsh records that the nodes of the other records don't resolve (but for the records themselves)."""
    nodes, welsh = _nodes(spark, folder), catalogue(spark, folder).where("language = 'cy'").select(projection.iri("https://id.example/", F.lit("assertion"), F.col("rid")).alias("id"))
    others = catalogue(spark, folder).where("language <> 'cy' AND publisher <> ''").select(projection.iri("https://id.example/", F.lit("publisher"), F.col("publisher")).alias("reference"))
    found = projection.node_references(nodes).join(welsh, "id", "left_semi").where(F.col("reference").contains("/publisher/"))
    return found.join(others, "reference", "left_anti").select("id", "reference")


@query(f"""WITH {_SEARCH}, rel AS (SELECT rid AS ordinal, CAST(count(DISTINCT token) AS BIGINT) AS n_relations FROM be GROUP BY rid), j AS (SELECT query_id, r.ordinal, rank, coalesce(n_relations, 0) AS n_relations FROM results r LEFT JOIN rel USING (ordinal)),
 b AS (SELECT *, coalesce(sum(n_relations) OVER (PARTITION BY query_id ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM j)
 SELECT query_id, ordinal, rank, n_relations, CAST(least(n_relations, greatest(0, 40 - before)) AS BIGINT) AS taken FROM b""")
def evidence_packs(spark, folder):
    relations = table(spark, folder, "be").groupBy(F.col("rid").alias("ordinal")).agg(F.countDistinct("token").alias("n_relations"))
    return projection.evidence_packs(_results(spark, folder).select("query_id", "ordinal", "rank"), relations, 40)


@query(f"""WITH {_SEARCH} SELECT query_id, string_agg('## ' || title || chr(10) || chr(10) || description || chr(10) || chr(10) || 'Source: <' || url || '>' || chr(10), chr(10) ORDER BY rank) AS document FROM results JOIN records_once ON rid = ordinal GROUP BY query_id""")
def context_export(spark, folder):
    """The answer of each query as one Markdown text."""
    shown = catalogue(spark, folder).select(F.col("rid").alias("ordinal"), "title", "description", "url")
    return projection.markdown_export(_results(spark, folder).join(shown, "ordinal"), "query_id", "rank", F.col("title"), F.col("url"), F.col("description"))


@query(f"WITH {_RECORDS} SELECT rid, concat_ws('. ', nullif(title, ''), nullif(publisher, ''), nullif(url, '')) AS citation FROM records_once")
def citations(spark, folder):
    return catalogue(spark, folder).select("rid", projection.citation(F.col("title"), F.col("publisher"), F.col("url"), F.lit("")).alias("citation"))


@query(f"WITH {_RECORDS} SELECT rid, operation, replace(t, '{{}}', title) AS wording FROM records_once, (VALUES ('lookup', 'What is {{}}?'), ('compare', 'How does {{}} differ?')) w(operation, t)")
def worded_questions(spark, folder):
    rows = catalogue(spark, folder)
    return projection.worded(rows.select("rid", "title"), {"lookup": "What is {}?", "compare": "How does {} differ?"}, F.col("title")).select("rid", "operation", "wording")


@query()
def noisy_titles(spark, folder):
    return catalogue(spark, folder).select("rid", projection.noisy_title("title").alias("title"))


@query()
def flattened_texts(spark, folder):
    return table(spark, folder, "source_records").select("seq", F.sha2(projection.flattened_text("raw_json"), 256).alias("text_sha256"))


@query("SELECT candidate_id, json_extract_string(candidate_json, '$.source_memberships[0]') AS first_source FROM candidates WHERE json_valid(candidate_json)")
def pointer_lookup(spark, folder):
    rows = table(spark, folder, "candidates").where(F.try_parse_json("candidate_json").isNotNull())
    return rows.select("candidate_id", F.get_json_object("candidate_json", projection.json_pointer("/source_memberships/0")).alias("first_source"))


@query("WITH d AS (SELECT source, doc_id, lang = 'cy' AS w FROM documents), f AS (SELECT source, bool_or(coalesce(w, false)) AS s FROM d GROUP BY source) SELECT doc_id, source FROM d JOIN f USING (source) WHERE NOT s OR w")
def pool_or_all(spark, folder):
    return projection.pool_or_all(table(spark, folder, "documents").select("doc_id", "source", "lang"), ["source"], F.col("lang") == "cy").select("doc_id", "source")


@query("""WITH a AS (SELECT url, locale, record_sha256, delivered_at, input_id FROM inputs) SELECT url, locale, record_sha256 FROM (SELECT *, row_number() OVER (PARTITION BY url, locale ORDER BY delivered_at DESC, (role = 't1_enumeration') DESC, record_sha256 DESC) AS rn
 FROM (SELECT role, url, locale, record_sha256, delivered_at FROM inputs WHERE role IN ('t0_enumeration', 't1_enumeration'))) WHERE rn = 1""")
def upserted(spark, folder):
    """The table of the first snapshot after the rows of the second."""
    rows = table(spark, folder, "inputs")
    side = lambda role: rows.where(F.col("role") == role).select("url", "locale", "record_sha256", "delivered_at")
    return projection.upsert(side("t0_enumeration"), side("t1_enumeration"), ["url", "locale"], "delivered_at").select("url", "locale", "record_sha256")


@query("""WITH RECURSIVE e AS (SELECT 'region/' || n_regionkey AS s, 'nation/' || n_nationkey AS t FROM nation UNION SELECT 'nation/' || s_nationkey, 'supplier/' || s_suppkey FROM supplier),
 n AS (SELECT s AS node FROM e UNION SELECT t FROM e), l AS (SELECT node, 0 AS level FROM n WHERE node NOT IN (SELECT t FROM e) UNION SELECT e.t, l.level + 1 FROM l JOIN e ON e.s = l.node) SELECT node, max(level) AS level FROM l GROUP BY node""")
def topological_levels(spark, folder):
    node = lambda kind, c: F.concat(F.lit(kind + "/"), c)
    down = table(spark, folder, "nation").select(node("region", "n_regionkey").alias("source"), node("nation", "n_nationkey").alias("target"))
    return projection.topological_levels(down.unionByName(table(spark, folder, "supplier").select(node("nation", "s_nationkey").alias("source"), node("supplier", "s_suppkey").alias("target"))))


@query(f"""WITH {_EDGES}, h AS (SELECT 'part/17' AS centre, * FROM edges WHERE source = 'part/17' OR target = 'part/17') SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY source, kind, target) - 1 AS INTEGER) AS place FROM h) WHERE place < 500""")
def centre_view(spark, folder):
    hop = graph.one_hop(trade_edges(spark, folder), spark.createDataFrame([("part/17",)], "node string"))
    return projection.centre_views(hop.withColumn("centre", F.lit("part/17")), 250, 500)


@query()
def staged_search(spark, folder):
    """All evaluation items: BM25, a bonus for titles that the question quotes whole, neighbours of the best results over shared publishers."""
    rows, items = catalogue(spark, folder), table(spark, folder, "eval_items").select(F.col("item_id").alias("query_id"), "text")
    ranked = _index(spark, folder).bm25(items, 50)
    first = rows.where("publisher <> ''").groupBy("publisher").agg(F.min("rid").alias("target"))
    edges = rows.join(first, "publisher").where("rid <> target").select(F.col("rid").alias("source"), "target")
    titles = ranked.join(rows.select(F.col("rid").alias("ordinal"), "title"), "ordinal").join(items, "query_id")
    bonus = titles.where(F.contains(F.lower("text"), F.lower("title"))).select("query_id", "ordinal", F.lit(10_000).alias("bonus"))
    return projection.staged_search(ranked.select("query_id", "ordinal", "rank"), edges, bonus=bonus)


_KEY = "regexp_replace(lower(url), '[^\\p{L}\\p{N}]+', '', 'g')"
_FPR = "regexp_replace(regexp_replace(lower(coalesce(fingerprint, '')), '[\\s\\x{00A0}]+', '', 'g'), '^[a-z][a-z0-9_\\-]*:', '')"


@query(f"""WITH r AS (SELECT *, {_KEY} AS k, {_FPR} AS fp, row_number() OVER (PARTITION BY role, {_KEY}, locale ORDER BY delivered_at DESC, input_id DESC) AS rn FROM inputs), l AS (SELECT * FROM r WHERE rn = 1),
 a AS (SELECT * FROM l WHERE role = 't0_enumeration'), b AS (SELECT * FROM l WHERE role = 't1_enumeration'), h AS (SELECT * FROM l WHERE role = 't0_hydrated')
 SELECT coalesce(a.k, b.k) AS url_key, coalesce(a.locale, b.locale) AS locale, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' WHEN a.fp = b.fp THEN 'unchanged' ELSE 'changed' END AS delta_class,
 b.k IS NOT NULL AND h.k IS NOT NULL AND coalesce(h.fp = b.fp, false) AS reusable FROM a FULL JOIN b ON a.k = b.k AND a.locale = b.locale LEFT JOIN h ON h.k = coalesce(a.k, b.k) AND h.locale = coalesce(a.locale, b.locale)""")
def three_way_delta(spark, folder):
    """Every record of two enumerations with its class, and whether the detailed record held from before may be used again."""
    rows = table(spark, folder, "inputs").select("role", snapshots.folded_url("url").alias("url_key"), "locale", snapshots.folded_fingerprint("fingerprint").alias("fp"), F.struct("delivered_at", "input_id").alias("v"))
    last = rows.groupBy("url_key", "locale", "role").agg(F.max(F.struct("v", "fp")).alias("m")).select("url_key", "locale", "role", F.col("m.fp").alias("fp"))
    one = lambda role: F.max(F.when(F.col("role") == role, F.col("fp")))
    wide = last.groupBy("url_key", "locale").agg(one("t0_enumeration").alias("a"), one("t1_enumeration").alias("b"), one("t0_hydrated").alias("h")).where("a IS NOT NULL OR b IS NOT NULL")
    kind = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "removed").when(F.col("a") == F.col("b"), "unchanged").otherwise("changed")
    return wide.select("url_key", "locale", kind.alias("delta_class"), F.coalesce(F.col("h") == F.col("b"), F.lit(False)).alias("reusable"))


@query("""WITH RECURSIVE o AS (SELECT source AS g, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents),
 p AS (SELECT g, doc_id, n_chars, n, 0 AS shard, n_chars AS used FROM o WHERE n = 1 UNION ALL SELECT o.g, o.doc_id, o.n_chars, o.n, CASE WHEN p.used + o.n_chars > 20000 THEN p.shard + 1 ELSE p.shard END, CASE WHEN p.used + o.n_chars > 20000 THEN o.n_chars ELSE p.used + o.n_chars END FROM p JOIN o ON o.g = p.g AND o.n = p.n + 1)
 SELECT g AS source, doc_id, CAST(used - n_chars AS BIGINT) AS offset FROM p""")
def pack_offsets(spark, folder):
    packed = packing.greedy_shards(table(spark, folder, "documents").select("source", "doc_id", "n_chars"), "source", ["doc_id"], "n_chars", 20_000)
    return projection.pack_offsets(packed, ["source", "shard"], ["doc_id"], "n_chars").select("source", "doc_id", "offset")


@query("SELECT facet, value, count(DISTINCT doc_id) AS n_holders FROM (SELECT 'lang' AS facet, lang AS value, doc_id FROM documents UNION ALL SELECT 'source', source, doc_id FROM documents UNION ALL SELECT 'publisher', publisher, doc_id FROM documents) WHERE value <> '' GROUP BY facet, value")
def coverage_cells(spark, folder):
    """How many holders each value of each dimension has."""
    once = table(spark, folder, "documents").select("doc_id", "lang", "source", "publisher").distinct()
    return facets.facet_counts(once, {c: F.col(c) for c in ("lang", "source", "publisher")}).withColumnRenamed("n", "n_holders")


@query("SELECT split, count(*) AS n, count(DISTINCT question_id) AS n_questions, count(DISTINCT text) AS n_texts, count(*) FILTER (question_id IN (SELECT question_id FROM eval_items GROUP BY question_id HAVING count(DISTINCT split) > 1)) AS n_in_several FROM eval_items GROUP BY split")
def split_audit(spark, folder):
    """Uniqueness within each split, and questions that stand in several."""
    rows = table(spark, folder, "eval_items")
    several = rows.groupBy("question_id").agg((F.countDistinct("split") > 1).alias("several"))
    joined = rows.join(several, "question_id")
    return joined.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("question_id").alias("n_questions"), F.countDistinct("text").alias("n_texts"), F.sum(F.col("several").cast("int")).alias("n_in_several"))


@query("SELECT event_id, event_type, regexp_replace(regexp_replace(lower(props), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS props FROM events WHERE event_type IN ('view', 'click', 'purchase')")
def telemetry_allowlist(spark, folder):
    """Events of the kinds allowed, with the columns allowed."""
    return table(spark, folder, "events").where(F.col("event_type").isin("view", "click", "purchase")).select("event_id", "event_type", predicate_name(F.col("props")).alias("props"))


@query("""WITH i AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM eval_items), o AS (SELECT operation, list_distinct(regexp_extract_all(lower(string_agg(text, ' ')), '[a-z0-9]+')) AS f FROM eval_items WHERE split = 'held_out' GROUP BY operation)
 SELECT item_id, round(len(list_intersect(w, f)) / greatest(1, len(w)), 6) AS overlap FROM i JOIN eval_items USING (item_id) JOIN o USING (operation)""")
def term_overlap(spark, folder):
    """Share of each item's terms that held-out items of its operation use."""
    rows = table(spark, folder, "eval_items")
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z0-9]+)"), 1))
    held = rows.where("split = 'held_out'").select("operation", F.explode(words).alias("t")).groupBy("operation").agg(F.collect_set("t").alias("found"))
    return rows.withColumn("wanted", words).join(held, "operation").select("item_id", F.round(evaluate.best_overlap(F.col("wanted"), F.col("found")), 6).alias("overlap"))
