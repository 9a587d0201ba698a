"""Queries: tokens, index, ranked search, facets, identity rules; with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import identity, urls
from ledgerloom.functions.text import LEXICAL_STOP_WORDS, STOP_WORDS, TOKEN, browser_tokens, tokens
from ledgerloom.operators import facets, index, quality
from ledgerloom.operators.stored import SearchIndex, write_index
from ledgerloom.session import durable, stored, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: Asked of the index by the search queries: (query_id, text).
ASKED = [
    (1, "seasonal contractor register rules"), (2, "Public notice: claim rules for Ashlode"), (3, "guidance published"), (4, "zzzunknown word"), (5, "the of and"),
    (6, "canal"), (7, "Withdraw a partial apprentice"), (8, "detailed_guide en water"), (9, "early-claim-archives quarry dataset"), (10, ""),
]
CAP = index.POSTING_CAP


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct records."""
    return table(spark, folder, "records").dropDuplicates(["rid"])


def _fields():
    return {
        "title": F.col("title"), "publisher": F.col("publisher"), "description": F.col("description"), "record_type": F.col("document_type"),
        "schema": F.col("schema_name"), "tags": F.array_join(F.from_json("tags", "array<string>"), " "), "url": F.col("url"), "language": F.col("language"), "lifecycle": F.col("lifecycle"),
    }


def _asked(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ASKED, "query_id int, text string")


def _postings(spark: SparkSession, folder: str) -> DataFrame:
    return durable(index.postings(catalogue(spark, folder), "rid", _fields()), "postings")


def _index(spark: SparkSession, folder: str) -> SearchIndex:
    """The index of the records, written when it is first asked for."""

    def build(path: str) -> None:
        names = {"open": F.col("open"), "url": F.col("url"), "content_id": F.col("content_id"), "title_key": F.col("title_key")}
        write_index(catalogue(spark, folder), "rid", _fields(), F.concat_ws(" ", "title", "description"), names, path)

    return SearchIndex(spark, stored("index", table(spark, folder, "records"), build))


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_FOLD = "lower(regexp_replace(strip_accents({}), '[^\\x00-\\x7F]', '', 'g'))"
_RUNS = "list_filter(list_transform(regexp_extract_all(" + _FOLD + ", '" + TOKEN + "'), lambda t: regexp_replace(t, '^[._-]+|[._-]+$', '', 'g')), lambda t: length(t) >= 2 AND t NOT IN (" + _STOP + "))"
_RECORDS = "records_once AS (SELECT DISTINCT ON (rid) * FROM records)"
_FIELD_ROWS = " UNION ALL ".join(
    f"SELECT rid AS ordinal, {w} AS w, {m} AS m, {c} AS x FROM records_once" for (w, m), c in ((index.FIELDS[f], c) for f, c in (("title", "title"), ("publisher", "publisher"), ("description", "description"), ("record_type", "document_type"), ("schema", "schema_name"), ("tags", "array_to_string(json_extract_string(tags, '$[*]'), ' ')"), ("url", "url"), ("language", "language"), ("lifecycle", "lifecycle")))
)
_POSTINGS = f"""{_RECORDS}, field_rows AS ({_FIELD_ROWS}),
 ft AS (SELECT DISTINCT ordinal, w, m, unnest({_RUNS.format("x")}) AS token FROM field_rows WHERE x <> ''),
 postings AS (SELECT token, ordinal, CAST(sum(w) AS INTEGER) AS score, CAST(bit_or(m) AS INTEGER) AS mask FROM ft GROUP BY token, ordinal),
 lexicon AS (SELECT token, count(*) AS df FROM postings GROUP BY token),
 lists AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY score DESC, ordinal) AS rank FROM postings) WHERE rank <= {CAP})"""
_ASKED = "asked(query_id, text) AS (VALUES " + ", ".join(f"({i}, '{t}')" for i, t in ASKED) + ")"
_SEARCH = f"""{_POSTINGS}, {_ASKED},
 qt AS (SELECT query_id, unnest(list_distinct({_RUNS.format("text")})) AS token, len(list_distinct({_RUNS.format("text")})) AS n_tokens FROM asked),
 known AS (SELECT qt.*, df, df <= {CAP} AS complete, sum(CASE WHEN df <= {CAP} THEN 1 ELSE 0 END) OVER (PARTITION BY query_id) AS n_complete,
           row_number() OVER (PARTITION BY query_id ORDER BY df, qt.token) AS rarity FROM qt JOIN lexicon USING (token)),
 scored AS (SELECT query_id, ordinal, sum(score + CASE WHEN mask & 1 > 0 THEN 4 ELSE 0 END) AS search_score, count(*) AS matched_tokens, max(n_tokens) AS n_tokens,
            sum(CASE WHEN n_complete > 0 THEN complete::INT ELSE (rarity = 1)::INT END) AS held, max(greatest(n_complete, 1)) AS wanted
            FROM known JOIN lists USING (token) GROUP BY query_id, ordinal),
 eligible AS (SELECT *, held = wanted AS whole, bool_or(held = wanted) OVER (PARTITION BY query_id) AS some_whole FROM scored WHERE held > 0),
 results AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY search_score DESC, ordinal) AS rank FROM eligible WHERE whole OR NOT some_whole) WHERE rank <= 20)"""


@query(f"WITH {_POSTINGS} SELECT token, df FROM lexicon")
def token_df(spark, folder):
    return index.lexicon(index.postings(catalogue(spark, folder), "rid", _fields()))


@query(f"WITH {_POSTINGS} SELECT token, ordinal, score, mask, rank FROM lists")
def postings_topk(spark, folder):
    return index.capped(index.postings(catalogue(spark, folder), "rid", _fields())).select("token", "ordinal", "score", "mask", "rank")


_PREFIXES = f"""cut AS (SELECT left(token, CAST(n AS BIGINT)) AS prefix, token, df FROM lexicon, range(3, 13) r(n) WHERE n <= length(token)),
 completions AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY prefix ORDER BY df DESC, token) AS rank FROM cut) WHERE rank <= {index.PREFIX_CAP})"""


@query(f"WITH {_POSTINGS}, {_PREFIXES} SELECT prefix, token, df, rank FROM completions")
def prefix_completions(spark, folder):
    return index.prefixes(index.lexicon(index.postings(catalogue(spark, folder), "rid", _fields()))).select("prefix", "token", "df", "rank")


def _results(spark, folder):
    return _index(spark, folder).search(_asked(spark))


@query(f"""WITH {_SEARCH} SELECT query_id, ordinal, CAST(search_score AS BIGINT) AS search_score, matched_tokens, rank, r.open, r.title,
 'matched ' || matched_tokens || ' of ' || n_tokens || ' query tokens' AS why FROM results JOIN records_once r ON r.rid = ordinal""")
def keyword_search(spark, folder):
    """Ranked search, documents fetched after the ranking."""
    shown = _index(spark, folder).table("documents").select(F.col("rid").alias("ordinal"), "open", "title")
    why = F.format_string("matched %d of %d query tokens", "matched_tokens", "n_tokens")
    return _results(spark, folder).join(shown, "ordinal").select("query_id", "ordinal", F.col("search_score").cast("long").alias("search_score"), "matched_tokens", "rank", "open", "title", why.alias("why"))


@query(f"""WITH {_SEARCH} SELECT a.query_id, CAST(coalesce(n, 0) AS BIGINT) AS n_results,
 CASE WHEN len({_RUNS.format("a.text")}) = 0 THEN 'no_supported_query' WHEN n IS NULL THEN 'no_supported_result' ELSE 'metadata_discovery' END AS answerability
 FROM asked a LEFT JOIN (SELECT query_id, count(*) AS n FROM results GROUP BY query_id) USING (query_id)""")
def search_answerability(spark, folder):
    return index.answerability(_asked(spark), _results(spark, folder))


_WORDS = ["canal", "regist", "publi", "watercourse", "zzz", "dat", "en"]


@query(f"""WITH {_POSTINGS}, {_PREFIXES}, words(word) AS (VALUES {", ".join(f"('{w}')" for w in _WORDS)}),
 tries AS (SELECT word, completions.*, max(length(prefix)) OVER (PARTITION BY word) AS longest FROM words JOIN completions ON starts_with(word, prefix) AND length(prefix) <= 8),
 ranked AS (SELECT word, token, df, row_number() OVER (PARTITION BY word ORDER BY token = word DESC, df DESC, token) AS rank FROM tries WHERE length(prefix) = longest)
 SELECT * FROM ranked WHERE rank <= 3""")
def suggestions(spark, folder):
    words = spark.createDataFrame([(w,) for w in _WORDS], "word string")
    return _index(spark, folder).suggest(words)


@query(f"""WITH {_POSTINGS}, {_PREFIXES}, words(query_id, token) AS (VALUES (1, 'canal'), (1, 'licens'), (2, 'quarr'), (2, 'seasonal'), (3, 'zzz')),
 missing AS (SELECT * FROM words WHERE token NOT IN (SELECT token FROM lexicon)),
 tries AS (SELECT m.token AS word, c.*, max(length(prefix)) OVER (PARTITION BY m.token) AS longest FROM (SELECT DISTINCT token FROM missing) m JOIN completions c ON starts_with(m.token, prefix) AND length(prefix) <= 8),
 offered AS (SELECT word, token AS member FROM (SELECT word, token, row_number() OVER (PARTITION BY word ORDER BY token = word DESC, df DESC, token) AS rank FROM tries WHERE length(prefix) = longest) WHERE rank <= 3),
 groups AS (SELECT query_id, token, token AS member FROM words WHERE token IN (SELECT token FROM lexicon) UNION ALL SELECT query_id, token, member FROM missing JOIN offered ON word = token),
 hits AS (SELECT query_id, ordinal, groups.token, max(score) AS score FROM groups JOIN lists ON lists.token = member GROUP BY ALL),
 whole AS (SELECT query_id, ordinal, count(*) AS held, sum(score) AS score FROM hits GROUP BY query_id, ordinal),
 wanted AS (SELECT query_id, count(DISTINCT token) AS wanted FROM groups GROUP BY query_id)
 SELECT query_id, ordinal, CAST(score AS BIGINT) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, ordinal) AS rank FROM whole JOIN wanted USING (query_id) WHERE held = wanted) WHERE rank <= 20""")
def prefix_group_search(spark, folder):
    """Search where a token that the lexicon lacks stands for its best completions."""
    asked = spark.createDataFrame([(1, "canal"), (1, "licens"), (2, "quarr"), (2, "seasonal"), (3, "zzz")], "query_id int, token string")
    own = _index(spark, folder)
    return own.grouped_search(own.groups(asked)).select("query_id", "ordinal", F.col("score").cast("long").alias("score"), "rank")


def _bm25(asked: str) -> str:
    return f"""WITH {_RECORDS}, {asked}, spread AS (SELECT rid AS ordinal, {_RUNS.format("concat_ws(' ', title, description)")} AS ts FROM records_once),
 sizes AS (SELECT ordinal, len(ts) AS len FROM spread WHERE len(ts) > 0), st AS (SELECT count(*) AS n, avg(len) AS av FROM sizes),
 counts AS (SELECT ordinal, token, count(*) AS tf FROM (SELECT ordinal, unnest(ts) AS token FROM spread) GROUP BY ALL),
 dfs AS (SELECT token, count(*) AS df FROM counts GROUP BY token),
 qt AS (SELECT query_id, unnest(list_distinct({_RUNS.format("text")})) AS token FROM asked),
 hits AS (SELECT query_id, ordinal, round(sum(greatest(ln((n - df + 0.5) / (df + 0.5)), 1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / av))), 6) AS score
          FROM qt JOIN counts USING (token) JOIN dfs USING (token) JOIN sizes USING (ordinal), st GROUP BY query_id, ordinal)
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, ordinal) AS rank FROM hits) WHERE rank <= 10"""


@query(_bm25(_ASKED))
def bm25_topk(spark, folder):
    return _index(spark, folder).bm25(_asked(spark))


_FACETS = ("document_type", "schema_name", "language", "lifecycle", "publisher", "jurisdiction")


@query(f"WITH {_RECORDS} SELECT facet, value, count(*) AS n FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS facet, {f} AS value FROM records_once" for f in _FACETS) + ") WHERE value <> '' GROUP BY facet, value")
def facet_counts(spark, folder):
    return facets.facet_counts(catalogue(spark, folder), {f: F.col(f) for f in _FACETS})


@query("SELECT 'organisations' AS facet, value, count(*) AS n FROM (SELECT DISTINCT acquisition_id, unnest(organisations) AS value FROM (SELECT DISTINCT ON (acquisition_id) * FROM acquisition)) WHERE value <> '' GROUP BY value")
def facet_list_counts(spark, folder):
    return facets.facet_counts(table(spark, folder, "acquisition").dropDuplicates(["acquisition_id"]), {"organisations": F.col("organisations")})


@query(f"WITH {_RECORDS} SELECT rid, open FROM records_once WHERE language IN ('cy') AND document_type IN ('guidance', 'form', 'manual')")
def facet_filter(spark, folder):
    return facets.facet_filter(catalogue(spark, folder), {"language": ["cy"], "document_type": ["guidance", "form", "manual"]}).select("rid", "open")


@query(f"WITH {_RECORDS}, r AS (SELECT rid, {_RUNS.format('title')} AS ts FROM records_once) SELECT rid FROM r WHERE len(list_filter(['regis', 'rul'], lambda q: len(list_filter(ts, lambda t: starts_with(t, q))) = 0)) = 0")
def prefix_filter(spark, folder):
    asked = F.array(F.lit("regis"), F.lit("rul"))
    return catalogue(spark, folder).withColumn("_t", tokens(F.col("title"))).where(facets.prefix_match(asked, F.col("_t"))).select("rid")


@query(f"WITH {_RECORDS} SELECT rid, list_sort(list_distinct({_RUNS.format('title')})) AS tokens FROM records_once")
def title_tokens(spark, folder):
    return catalogue(spark, folder).select("rid", F.array_sort(tokens(F.col("title"))).alias("tokens"))


_FNV = "list_reduce(list_prepend(2166136261::UBIGINT, list_transform(string_split(open, ''), lambda c: ascii(c)::UBIGINT)), lambda a, b: (xor(a, b) * 16777619::UBIGINT) & 4294967295::UBIGINT)"


@query(f"WITH {_RECORDS} SELECT rid, CAST({_FNV} AS BIGINT) AS hash, lower(lpad(to_hex({_FNV} >> 24), 2, '0')) AS bucket FROM records_once")
def fnv_bucket(spark, folder):
    return catalogue(spark, folder).select("rid", identity.fnv1a32(F.col("open")).alias("hash"), identity.adjacency_bucket(F.col("open")).alias("bucket"))


@query("SELECT c_custkey FROM customer WHERE cast(concat('0x', substr(sha256(c_name), 1, 16)) AS UBIGINT) % 100 < 1")
def hash_sample_1pct(spark, folder):
    return table(spark, folder, "customer").where(identity.hash_sample(F.col("c_name"), 1)).select("c_custkey")


@query("SELECT l_orderkey, l_linenumber, 'assertion-' || sha256('order/' || l_orderkey || chr(0) || 'contains' || chr(0) || 'part/' || l_partkey || chr(0) || 'lineitem' || chr(0) || 'l_partkey' || chr(0) || '/' || l_linenumber) AS assertion_id FROM lineitem")
def assertion_ids(spark, folder):
    rows = table(spark, folder, "lineitem")
    own = identity.assertion_id(F.concat(F.lit("order/"), "l_orderkey"), F.lit("contains"), F.concat(F.lit("part/"), "l_partkey"), F.lit("lineitem"), F.lit("l_partkey"), F.concat(F.lit("/"), "l_linenumber"))
    return rows.select("l_orderkey", "l_linenumber", own.alias("assertion_id"))


_SLUG = "coalesce(nullif(left(regexp_replace(regexp_replace(" + _FOLD + ", '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 120), ''), 'item')"


@query(f"WITH {_RECORDS} SELECT rid, {_SLUG.format('title')} AS slug, {_SLUG.format('publisher')} AS publisher_slug FROM records_once WHERE publisher IS NOT NULL")
def title_slugs(spark, folder):
    return catalogue(spark, folder).where("publisher IS NOT NULL").select("rid", identity.slug(F.col("title")).alias("slug"), identity.slug(F.col("publisher")).alias("publisher_slug"))


@query(f"""WITH {_RECORDS} SELECT rid, 'dataset/' || coalesce(nullif(lower(regexp_replace(coalesce(content_id, ''), '[^A-Za-z0-9-]', '', 'g')), ''), 'route-' || left(sha256(url), 24)) || '-' || language AS route,
 sha256('route' || chr(0) || url || chr(0) || language || chr(0) || url) AS candidate_key FROM records_once""")
def record_identities(spark, folder):
    none = F.lit(None).cast("string")
    return catalogue(spark, folder).select(
        "rid", identity.dataset_route(F.col("content_id"), F.col("url"), F.col("language")).alias("route"), identity.candidate_key(F.lit("route"), none, F.col("url"), F.col("language")).alias("candidate_key")
    )


@query("SELECT DISTINCT part_key, sha256(search_index_id || chr(0) || part_index || chr(0) || coalesce(nullif(part_link, ''), nullif(part_slug, ''), CAST(part_index AS VARCHAR))) AS own_key FROM search_parts")
def part_keys(spark, folder):
    rows = table(spark, folder, "search_parts")
    return rows.select("part_key", identity.part_key(F.col("search_index_id"), F.col("part_index"), F.col("part_link"), F.col("part_slug")).alias("own_key")).distinct()


@query(f"""WITH {_RECORDS} SELECT rid, array_to_string(list_transform(string_split(replace(list_extract(string_split(url, '/'), -1), '-', ' '), ' '), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') AS title,
 regexp_replace(regexp_replace(lower(confidence), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS predicate, coalesce(nullif(left(regexp_replace(lower(schema_name), '[^a-z0-9]', '', 'g'), 2), ''), '_') AS shard FROM records_once""")
def path_titles(spark, folder):
    return catalogue(spark, folder).select("rid", identity.title_from_path(F.col("url")).alias("title"), identity.predicate_name(F.col("confidence")).alias("predicate"), identity.search_shard(F.col("schema_name")).alias("shard"))


_BARE = "regexp_replace(regexp_replace(url, '^\\s+|\\s+$', '', 'g'), '#.*$', '')"


@query(f"""SELECT input_id, lower(regexp_extract({_BARE}, '^([A-Za-z]+://[^/?]*)', 1)) || regexp_replace(regexp_replace(regexp_replace({_BARE}, '^[A-Za-z]+://[^/?]*', ''), '/{{2,}}', '/', 'g'), '/$', '') AS url,
 lower(regexp_extract(url, '^\\s*[A-Za-z]+://([^/?#:\\s]+)', 1)) AS host FROM inputs""")
def simple_urls(spark, folder):
    return table(spark, folder, "inputs").select("input_id", urls.simple_url(F.col("url")).alias("url"), urls.host_of(F.col("url")).alias("host"))


@query()
def normal_urls(spark, folder):
    """The exact URL rules, on distinct texts only."""
    distinct = table(spark, folder, "inputs").select("url").distinct()
    return distinct.select("url", urls.normalise_url(F.trim("url")).alias("normal_url"))


@query()
def resolved_links(spark, folder):
    rows = table(spark, folder, "search_parts").where(F.col("part_link").isNotNull()).select("part_key", "evidence_url", "part_link").distinct()
    return rows.select("part_key", urls.resolve_url("evidence_url", "part_link").alias("target"))


@query("SELECT doc_id, CASE lower(lang) WHEN 'en-gb' THEN 'en-GB' ELSE lower(lang) END AS tag, left(trim(regexp_replace(text, '[\\x00-\\x20\\x7f]+', ' ', 'g'), ' '), 80) AS start FROM documents WHERE lang IS NOT NULL")
def language_tags(spark, folder):
    return table(spark, folder, "documents").where("lang IS NOT NULL").select("doc_id", identity.language_tag(F.col("lang")).alias("tag"), identity.clean_text(F.col("text"), 80).alias("start"))


@query("""WITH t AS (SELECT doc_id, text, regexp_extract_all(text, '["“]([^"”]+)["”]', 1) AS phrases FROM documents WHERE text IS NOT NULL) SELECT doc_id, phrases FROM t WHERE len(phrases) > 0""")
def quoted_phrases(spark, folder):
    rows = table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", identity.quoted_phrases(F.col("text")).alias("phrases"))
    return rows.where(F.size("phrases") > 0)


_LEXICAL = ", ".join(f"'{w}'" for w in LEXICAL_STOP_WORDS)


@query(f"""WITH w AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS ws FROM eval_items)
 SELECT item_id, list_slice(list_distinct_in_order, 1, 32) AS terms FROM (SELECT item_id, list_filter(ws, lambda w, i: length(w) >= 2 AND w NOT IN ({_LEXICAL}) AND NOT regexp_full_match(w, '[0-9]+') AND list_position(ws, w) = i) AS list_distinct_in_order FROM w)""")
def lexical_terms(spark, folder):
    """The first 32 distinct words of two letters or more that are neither stop words nor numbers, in order."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]+)"), 1))
    return table(spark, folder, "eval_items").select("item_id", F.slice(F.filter(words, lambda w: (F.length(w) >= 2) & ~w.isin(LEXICAL_STOP_WORDS) & ~w.rlike("^[0-9]+$")), 1, 32).alias("terms"))


@query(_bm25("asked AS (SELECT item_id AS query_id, text FROM eval_items)"))
def evaluation_search(spark, folder):
    """All evaluation items as queries at once, top 10 of each by BM25."""
    asked = table(spark, folder, "eval_items").select(F.col("item_id").alias("query_id"), "text")
    return _index(spark, folder).bm25(asked)


_TITLE = "seasonal contractor: register rules for hexcombe"


@query(f"""WITH {_RECORDS} SELECT identifier, kind, rid AS ordinal FROM (SELECT title_key AS identifier, 'title_key' AS kind, rid FROM records_once UNION ALL SELECT url, 'url', rid FROM records_once)
 WHERE identifier IN ('{_TITLE}', 'https://www.gov.example/none') OR kind = 'url' AND identifier = (SELECT min(url) FROM records_once)""")
def exact_search(spark, folder):
    """Records whose title (without letter case) or address equals what is asked, from the buckets of these."""
    first = table(spark, folder, "records").agg(F.min("url").alias("u")).first()["u"]
    return _index(spark, folder).exact([_TITLE, "https://www.gov.example/none", *([first] if first else [])], ["title_key", "url"])


@query(f"WITH {_RECORDS} SELECT rid, open, url, title FROM records_once WHERE open = (SELECT min(open) FROM records_once)")
def fetched_record(spark, folder):
    """One record by its route: a bucket of the route index, then its chunk of documents."""
    first = table(spark, folder, "records").agg(F.min("open").alias("o")).first()["o"]
    row = _index(spark, folder).fetch(first, "open") if first else {}
    return spark.createDataFrame([tuple(row[c] for c in ("rid", "open", "url", "title"))] if row else [], "rid int, open string, url string, title string")


@query()
def browser_title_tokens(spark, folder):
    return catalogue(spark, folder).select("rid", browser_tokens(F.col("title")).alias("tokens"))


@query()
def index_faults(spark, folder):
    """The index that was written, read again and held against postings made anew; a whole one has no rows."""
    found = _postings(spark, folder)
    lists, terms = durable(index.capped(found), "lists"), durable(index.lexicon(found), "terms")
    return quality.index_faults(lists, terms, index.postings(catalogue(spark, folder), "rid", _fields()), index.POSTING_CAP)
