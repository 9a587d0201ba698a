"""Queries: graph, census, windows, sets, sorts; with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import urls
from ledgerloom.operators import assign, census, graph, hierarchy, windows
from ledgerloom.operators.stored import traverse, write_adjacency
from ledgerloom.plans.general import _TREE
from ledgerloom.plans.text_search import _RECORDS, catalogue
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


def trade_edges(spark: SparkSession, folder: str, distinct: bool = True) -> DataFrame:
    """Typed edges of the order tables: orders contain parts, parts are supplied by suppliers, orders are placed by customers. Operators that drop repeats
    themselves take them as they come."""
    node = lambda kind, c: F.concat(F.lit(kind + "/"), c)
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    parts = [
        lines.select(node("order", "l_orderkey").alias("source"), F.lit("contains").alias("kind"), node("part", "l_partkey").alias("target")),
        lines.select(node("part", "l_partkey").alias("source"), F.lit("supplied by").alias("kind"), node("supplier", "l_suppkey").alias("target")),
        orders.select(node("order", "o_orderkey").alias("source"), F.lit("placed by").alias("kind"), node("customer", "o_custkey").alias("target")),
    ]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.distinct() if distinct else whole


_EDGES = """edges AS (SELECT DISTINCT 'order/' || l_orderkey AS source, 'contains' AS kind, 'part/' || l_partkey AS target FROM lineitem
 UNION SELECT 'part/' || l_partkey, 'supplied by', 'supplier/' || l_suppkey FROM lineitem UNION SELECT 'order/' || o_orderkey, 'placed by', 'customer/' || o_custkey FROM orders)"""


@query(f"WITH {_EDGES} SELECT kind, count(*) AS n_edges, count(DISTINCT source) AS n_sources, count(DISTINCT target) AS n_targets FROM edges GROUP BY kind")
def edge_kinds(spark, folder):
    return graph.kind_counts(trade_edges(spark, folder))


_BUCKET = "lower(lpad(to_hex(list_reduce(list_prepend(2166136261::UBIGINT, list_transform(string_split(route, ''), lambda c: ascii(c)::UBIGINT)), lambda a, b: (xor(a, b) * 16777619::UBIGINT) & 4294967295::UBIGINT) >> 24), 2, '0'))"


@query(f"WITH {_EDGES}, a AS (SELECT source AS route, * FROM edges UNION ALL SELECT target, * FROM edges WHERE source <> target), r AS (SELECT route, count(*) AS n FROM a GROUP BY route) SELECT {_BUCKET} AS bucket, CAST(sum(n) AS BIGINT) AS n_entries, count(*) AS n_routes FROM r GROUP BY bucket")
def adjacency_buckets(spark, folder):
    return graph.adjacency_routes(trade_edges(spark, folder)).groupBy("bucket").agg(F.sum("n_entries").alias("n_entries"), F.count(F.lit(1)).alias("n_routes"))


@query(f"WITH {_EDGES} SELECT source, kind, target FROM edges WHERE source IN ('part/17', 'order/100') OR target IN ('part/17', 'order/100')")
def one_hop(spark, folder):
    seeds = spark.createDataFrame([("part/17",), ("order/100",)], "node string")
    return graph.one_hop(trade_edges(spark, folder, False), seeds).select("source", "kind", "target")


@query(f"WITH {_EDGES}, hit AS (SELECT * FROM edges WHERE source = 'part/17' OR target = 'part/17') SELECT source, kind, target FROM hit WHERE kind IN ('supplied by')")
def bucket_traverse(spark, folder):
    """One node's edges of some kinds, from the one bucket of the written adjacency that holds it."""
    lines, orders = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("k")), table(spark, folder, "orders").select(F.col("o_orderkey").alias("k"))
    path = stored("adjacency", lines.union(orders), lambda to: write_adjacency(trade_edges(spark, folder), to))
    return traverse(spark, path, "part/17", ["supplied by"])


@query(f"""WITH {_EDGES}, e AS (SELECT source AS a, target AS b FROM edges UNION SELECT target, source FROM edges), s(seed) AS (VALUES ('customer/5'), ('supplier/3')),
 h1 AS (SELECT DISTINCT seed, b AS node FROM s JOIN e ON a = seed), h2 AS (SELECT DISTINCT seed, b AS node FROM h1 JOIN e ON a = node)
 SELECT seed, node, min(hop) AS hop FROM (SELECT seed, seed AS node, 0 AS hop FROM s UNION ALL SELECT *, 1 FROM h1 UNION ALL SELECT *, 2 FROM h2) GROUP BY seed, node""")
def two_hop(spark, folder):
    seeds = spark.createDataFrame([("customer/5",), ("supplier/3",)], "node string")
    return graph.bounded_bfs(trade_edges(spark, folder, False), seeds, 2)


@query(f"""WITH {_EDGES}, e AS (SELECT source AS a, target AS b FROM edges UNION SELECT target, source FROM edges), s(seed) AS (VALUES ('customer/5'), ('supplier/3')),
 h1 AS (SELECT DISTINCT seed, b AS node FROM s JOIN e ON a = seed), h2 AS (SELECT DISTINCT seed, b AS node FROM h1 JOIN e ON a = node),
 r AS (SELECT seed, node, min(hop) AS hop FROM (SELECT seed, seed AS node, 0 AS hop FROM s UNION ALL SELECT *, 1 FROM h1 UNION ALL SELECT *, 2 FROM h2) GROUP BY seed, node)
 SELECT seed, node, hop, truncated FROM (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY hop, node) AS k, count(*) OVER (PARTITION BY seed) > 50 AS truncated FROM r) WHERE k <= 50""")
def budgeted_traverse(spark, folder):
    """Nearest 50 nodes of each seed within two steps, with whether there were more: a report of a stated size."""
    seeds = spark.createDataFrame([("customer/5",), ("supplier/3",)], "node string")
    return graph.bounded_bfs(trade_edges(spark, folder, False), seeds, 2, 50)


@query("""WITH RECURSIVE up AS (SELECT 'nation/' || n_nationkey AS s, 'region/' || n_regionkey AS t FROM nation UNION SELECT 'supplier/' || s_suppkey, 'nation/' || s_nationkey FROM supplier
 UNION SELECT 'customer/' || c_custkey, 'nation/' || c_nationkey FROM customer), r AS (SELECT 'region/1' AS node, 0 AS round UNION ALL SELECT up.s, r.round + 1 FROM r JOIN up ON up.t = r.node) SELECT node, round FROM r""")
def recursive_closure(spark, folder):
    """Everything below one region."""
    node = lambda kind, c: F.concat(F.lit(kind + "/"), c)
    nation, supplier, customer = (table(spark, folder, t) for t in ("nation", "supplier", "customer"))
    down = nation.select(node("region", "n_regionkey").alias("source"), node("nation", "n_nationkey").alias("target"))
    down = down.unionByName(supplier.select(node("nation", "s_nationkey").alias("source"), node("supplier", "s_suppkey").alias("target")))
    down = down.unionByName(customer.select(node("nation", "c_nationkey").alias("source"), node("customer", "c_custkey").alias("target")))
    return graph.closure(spark.createDataFrame([("region/1",)], "node string"), down)


@query(f"WITH {_EDGES}, nodes AS (SELECT 'order/' || o_orderkey AS node FROM orders WHERE o_orderstatus <> 'F' UNION SELECT 'part/' || p_partkey FROM part UNION SELECT 'customer/' || c_custkey FROM customer) SELECT 'source' AS side, * FROM edges WHERE source NOT IN (SELECT node FROM nodes) UNION ALL SELECT 'target', * FROM edges WHERE target NOT IN (SELECT node FROM nodes)")
def dangling_edges(spark, folder):
    """Edges with an end outside a node table that lacks suppliers and finished orders."""
    node = lambda kind, c: F.concat(F.lit(kind + "/"), c).alias("node")
    nodes = table(spark, folder, "orders").where("o_orderstatus <> 'F'").select(node("order", "o_orderkey")).union(table(spark, folder, "part").select(node("part", "p_partkey"))).union(table(spark, folder, "customer").select(node("customer", "c_custkey")))
    return graph.dangling(trade_edges(spark, folder), nodes)


@query("WITH a AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT p_partkey AS k FROM part WHERE p_size > 5) SELECT k, 'left' AS side FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT k, 'right' FROM (SELECT k FROM b EXCEPT SELECT k FROM a)")
def exact_cover(spark, folder):
    a = table(spark, folder, "lineitem").where("l_returnflag = 'R'").select(F.col("l_partkey").alias("k")).distinct()
    return graph.cover_differences(a, table(spark, folder, "part").where("p_size > 5").select(F.col("p_partkey").alias("k")))


@query(f"WITH {_EDGES} SELECT source, kind, target, CAST(CASE WHEN source = target THEN 1 ELSE 2 END - 1 AS BIGINT) AS n, CAST(CASE WHEN source = target THEN 1 ELSE 2 END AS BIGINT) AS wanted FROM edges WHERE target = 'supplier/7' AND source <> target")
def adjacency_faults(spark, folder):
    """The check finds the entries that were taken away on purpose: those of one supplier."""
    edges = trade_edges(spark, folder)
    return graph.adjacency_faults(edges, graph.adjacency(edges).where("route <> 'supplier/7'"))


_LISTS = ("organisations", "parent_taxons", "child_taxons", "second_level_browse_pages")
_PAGES = "pages AS (SELECT DISTINCT ON (acquisition_id) * FROM acquisition)"
_ITEMS = " UNION ALL ".join(f"SELECT acquisition_id AS source, '{c}' AS predicate, unnest(generate_series(0, len({c}) - 1)) AS position, unnest({c}) AS target FROM pages" for c in _LISTS)
_KIND = "CASE predicate WHEN 'organisations' THEN 'associated with organisation' WHEN 'parent_taxons' THEN 'child of' ELSE 'parent of' END"


@query(f"WITH {_PAGES}, i AS ({_ITEMS}) SELECT CAST(source AS VARCHAR) AS source, predicate, {_KIND} AS kind, CAST(position AS INTEGER) AS position, trim(target) AS target FROM i WHERE target <> ''")
def list_edges(spark, folder):
    rows = table(spark, folder, "acquisition").dropDuplicates(["acquisition_id"]).withColumn("id", F.col("acquisition_id").cast("string"))
    return graph.list_edges(rows, "id", _LISTS)


@query(f"""WITH {_PAGES}, i AS ({_ITEMS}), e AS (SELECT CAST(source AS VARCHAR) AS source, {_KIND} AS kind, trim(target) AS target, predicate, position FROM i WHERE target <> '')
 SELECT 'assertion-' || sha256(source || chr(0) || kind || chr(0) || target || chr(0) || 'pages' || chr(0) || predicate || chr(0) || '/') AS assertion_id, source, kind, target, predicate, CAST(max(position) AS INTEGER) AS position, count(*) AS observations FROM e GROUP BY source, kind, target, predicate""")
def edge_assertions(spark, folder):
    return graph.asserted(list_edges(spark, folder), F.lit("pages"))


_RESOLVED = f"""{_PAGES}, i AS ({_ITEMS}), e AS (SELECT CAST(source AS VARCHAR) AS source, predicate, trim(target) AS target FROM i WHERE target <> '' AND predicate <> 'organisations'),
 by_id AS (SELECT content_id AS name, min(content_id) AS node FROM pages WHERE content_id IS NOT NULL GROUP BY 1), by_url AS (SELECT lower(base_path) AS name, min(content_id) AS node FROM pages WHERE content_id IS NOT NULL GROUP BY 1),
 r AS (SELECT e.*, coalesce(a.node, b.node) AS node FROM e LEFT JOIN by_id a ON a.name = target LEFT JOIN by_url b ON b.name = regexp_replace(lower(target), '/+$', ''))"""


def _resolved(spark, folder):
    pages = table(spark, folder, "acquisition").where("content_id IS NOT NULL")
    by_id = pages.select(F.col("content_id").alias("name"), F.col("content_id").alias("node")).distinct()
    by_url = pages.groupBy(F.lower("base_path").alias("name")).agg(F.min("content_id").alias("node"))
    return graph.resolve_targets(list_edges(spark, folder).where("predicate <> 'organisations'").select("source", "predicate", "target"), by_id, by_url)


@query(f"WITH {_RESOLVED} SELECT source, predicate, target, node FROM r")
def resolved_targets(spark, folder):
    """Link targets to nodes: by id, else by address."""
    return _resolved(spark, folder).select("source", "predicate", "target", "node")


@query(f"WITH {_RESOLVED} SELECT 'stub/' || left(sha256(target), 24) AS node, count(*) AS n_links FROM r WHERE node IS NULL GROUP BY 1")
def stub_nodes(spark, folder):
    return graph.stubs(_resolved(spark, folder))


@query()
def json_link_rows(spark, folder):
    """One row per link of the links map of work items."""
    return graph.json_links(table(spark, folder, "work_items").dropDuplicates(["work_id"]), "work_id", "input_json")


@query(f"WITH {_RECORDS} SELECT DISTINCT identifier, kind, rid FROM (SELECT open AS identifier, 'open' AS kind, rid FROM records_once UNION ALL SELECT url, 'url', rid FROM records_once UNION ALL SELECT content_id, 'content_id', rid FROM records_once) WHERE identifier <> ''")
def identifier_index(spark, folder):
    return graph.identifiers(catalogue(spark, folder), "rid", {"open": F.col("open"), "url": F.col("url"), "content_id": F.col("content_id")})


@query(f"""WITH {_RECORDS}, ix AS (SELECT DISTINCT identifier, rid FROM (SELECT open AS identifier, rid FROM records_once UNION ALL SELECT url, rid FROM records_once UNION ALL SELECT content_id, rid FROM records_once) WHERE identifier <> ''),
 asked AS (SELECT DISTINCT base_path AS identifier FROM acquisition UNION SELECT DISTINCT content_id FROM records WHERE content_id IS NOT NULL UNION SELECT 'dataset/none')
 SELECT identifier, count(rid) AS n_matches, CASE WHEN count(rid) = 1 THEN min(rid) END AS rid FROM asked LEFT JOIN ix USING (identifier) GROUP BY identifier""")
def resolve_identifiers(spark, folder):
    asked = table(spark, folder, "acquisition").select(F.col("base_path").alias("identifier")).union(table(spark, folder, "records").where("content_id IS NOT NULL").select("content_id")).union(spark.createDataFrame([("dataset/none",)], "identifier string"))
    return graph.resolve(asked, identifier_index(spark, folder), "rid")


@query(f"""WITH {_RECORDS}, p AS (SELECT publisher, rid, language, lifecycle FROM records_once WHERE publisher <> '')
 SELECT publisher, arg_min(language, rid) FILTER (language <> '') AS language, arg_min(lifecycle, rid) FILTER (lifecycle <> '') AS lifecycle,
 count(DISTINCT nullif(language, '')) > 1 OR count(DISTINCT nullif(lifecycle, '')) > 1 AS conflict, count(*) AS n_rows FROM p GROUP BY publisher""")
def retained_publishers(spark, folder):
    """First wins, later rows fill what is empty, disagreement is reported."""
    return graph.retained(catalogue(spark, folder), "publisher", ["rid"], ["language", "lifecycle"])


_SU = "lower(regexp_extract({0}, '^\\s*([A-Za-z]+://[^/?]*)', 1)) || regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '^\\s+|\\s+$', '', 'g'), '#.*$', ''), '^[A-Za-z]+://[^/?]*', ''), '/{{2,}}', '/', 'g'), '/$', '')"
_SOURCES = {"datasets": (30, "url", "open"), "inputs": (20, "url", "record_sha256"), "work_items": (10, "url", "work_kind")}


def _sources(spark, folder):
    return {n: (p, table(spark, folder, n).select(urls.simple_url(F.col(u)).alias("url"), F.col(c).alias("label"), F.col("locale").alias("locale") if n != "datasets" else F.lit("").alias("locale"))) for n, (p, u, c) in _SOURCES.items()}


_UNION = "u AS (" + " UNION ALL ".join(f"SELECT {_SU.format(u)} AS url, {c} AS label, {'locale' if n != 'datasets' else chr(39) * 2} AS locale, {-p} AS p, '{n}' AS src FROM {n}" for n, (p, u, c) in _SOURCES.items()) + ")"


@query(f"""WITH {_UNION} SELECT url, min({{'p': p, 'v': label}}) FILTER (label <> '' AND label <> 'unknown')['v'] AS label, min({{'p': p, 'v': locale}}) FILTER (locale <> '' AND locale <> 'unknown')['v'] AS locale,
 list_sort(list(DISTINCT src)) AS source_memberships, count(*) AS n_rows FROM u WHERE url <> '' GROUP BY url""")
def union_by_priority(spark, folder):
    """Four-way union of enumerators by address, each field from the best source that has it."""
    return census.union_by_priority(_sources(spark, folder), "url", ["label", "locale"])


_FLAGS = "f AS (SELECT url, " + ", ".join(f"bool_or(src = '{n}') AS in_{n}" for n in _SOURCES) + " FROM u GROUP BY url)"


@query(f"WITH {_UNION}, {_FLAGS} SELECT in_datasets, in_inputs, in_work_items, count(*) AS n_keys FROM f GROUP BY ALL")
def reconciliation(spark, folder):
    flags = census.membership_flags({n: df for n, (_, df) in _sources(spark, folder).items()}, "url")
    return census.reconciliation(flags, list(_SOURCES))


@query(f"WITH {_UNION}, {_FLAGS} SELECT url, in_datasets, in_inputs, in_work_items FROM f WHERE NOT (in_datasets AND in_inputs AND in_work_items)")
def set_differences(spark, folder):
    return census.membership_flags({n: df for n, (_, df) in _sources(spark, folder).items()}, "url").where("NOT (in_datasets AND in_inputs AND in_work_items)")


@query(f"""WITH {_RECORDS}, c AS (SELECT url, language AS locale, 'route' AS entity_class, NULL AS native_id FROM records_once UNION ALL SELECT url, language, unnest(['identity', 'document']), content_id FROM records_once WHERE content_id <> ''
 UNION ALL SELECT url, language, 'edition', content_id FROM records_once WHERE content_id <> '' AND lifecycle = 'published')
 SELECT DISTINCT sha256(entity_class || chr(0) || coalesce(native_id, url) || chr(0) || locale || chr(0) || url) AS candidate_key, entity_class, native_id, url, locale FROM c""")
def candidate_rows(spark, folder):
    return census.candidates(catalogue(spark, folder), F.col("url"), F.col("content_id"), F.col("language"), F.col("lifecycle") == "published", F.lit(None).cast("array<string>"))


@query("""SELECT entity_class, source_native_id, locale, candidate_key, first_value(candidate_key) OVER w AS represented_by, CASE WHEN row_number() OVER w = 1 THEN 'represented' ELSE 'alias_of' END AS disposition
 FROM (SELECT DISTINCT entity_class, source_native_id, locale, candidate_key FROM candidates) WINDOW w AS (PARTITION BY entity_class, source_native_id, locale ORDER BY candidate_key)""")
def alias_resolution(spark, folder):
    return census.aliases(table(spark, folder, "candidates"), ["entity_class", "source_native_id", "locale"], "candidate_key")


@query("""WITH h AS (SELECT role, count(*) AS n_rows, count(DISTINCT record_sha256) AS n_keys FROM inputs GROUP BY role), e AS (SELECT * FROM (VALUES ('t0_enumeration', 100), ('t2_enumeration', 5)) v(role, n_expected))
 SELECT coalesce(h.role, e.role) AS role, coalesce(n_rows, 0) AS n_rows, coalesce(n_keys, 0) AS n_keys, CAST(coalesce(n_expected, 0) AS BIGINT) AS n_expected, coalesce(n_keys, 0) = coalesce(n_expected, 0) AND coalesce(n_rows, 0) = coalesce(n_keys, 0) AS closed FROM h FULL JOIN e ON h.role = e.role""")
def partition_closure(spark, folder):
    expected = spark.createDataFrame([("t0_enumeration", 100), ("t2_enumeration", 5)], "role string, n_expected long")
    return census.partition_closure(table(spark, folder, "inputs"), "role", "record_sha256", expected)


@query("SELECT url, count(DISTINCT role) AS n_partitions FROM inputs GROUP BY url HAVING count(DISTINCT role) > 1")
def shared_keys(spark, folder):
    return census.shared_keys(table(spark, folder, "inputs"), "role", "url")


@query("SELECT base_path, coalesce(list_sort(list(DISTINCT o) FILTER (o IS NOT NULL)), []) AS organisations FROM (SELECT DISTINCT base_path, unnest(CASE WHEN len(coalesce(organisations, [])) = 0 THEN [NULL] ELSE organisations END) AS o FROM acquisition) GROUP BY base_path")
def ledger_sets(spark, folder):
    return census.ledger_merge(table(spark, folder, "acquisition"), "base_path", ["organisations"])


@query("SELECT publisher, (dense_rank() OVER (ORDER BY publisher) - 1) % 5 = 0 AS held_out FROM (SELECT DISTINCT publisher FROM records WHERE publisher IS NOT NULL)")
def held_out_groups(spark, folder):
    return census.held_out(table(spark, folder, "records").where("publisher IS NOT NULL"), "publisher")


@query(f"WITH {_RECORDS} SELECT rid, open, row_number() OVER (ORDER BY open, url, rid) - 1 AS ordinal FROM records_once")
def dense_ordinals(spark, folder):
    return windows.dense_ordinal(catalogue(spark, folder).select("open", "url", "rid"), ["open", "url", "rid"]).select("rid", "open", "ordinal")


@query("SELECT role, url, locale, fingerprint, input_id FROM (SELECT *, row_number() OVER (PARTITION BY role, url, locale ORDER BY delivered_at DESC, input_id DESC) AS rn FROM inputs) WHERE rn = 1")
def latest_delivery(spark, folder):
    rows = table(spark, folder, "inputs").select("role", "url", "locale", "delivered_at", "input_id", "fingerprint")
    return windows.latest(rows, ["role", "url", "locale"], ["delivered_at", "input_id"]).select("role", "url", "locale", "fingerprint", "input_id")


@query("SELECT base_path, title, acquisition_id FROM (SELECT *, row_number() OVER (PARTITION BY base_path ORDER BY retrieved_at, acquisition_id) AS rn FROM acquisition) WHERE rn = 1")
def first_delivery(spark, folder):
    rows = table(spark, folder, "acquisition").select("base_path", "retrieved_at", "acquisition_id", "title")
    return windows.earliest(rows, ["base_path"], ["retrieved_at", "acquisition_id"]).select("base_path", "title", "acquisition_id")


@query("SELECT l_suppkey, min(k) AS first, max(k) AS last, count(*) AS n FROM (SELECT l_suppkey, k, k - row_number() OVER (PARTITION BY l_suppkey ORDER BY k) AS run FROM (SELECT DISTINCT l_suppkey, l_partkey AS k FROM lineitem)) GROUP BY l_suppkey, run")
def gap_islands(spark, folder):
    return windows.islands(table(spark, folder, "lineitem"), ["l_suppkey"], "l_partkey").withColumnRenamed("l_partkey", "k")


@query("SELECT user_id, event_type AS state, event_id AS sequence FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_state(spark, folder):
    rows = table(spark, folder, "events").select("user_id", F.col("event_id").alias("sequence"), F.col("event_type").alias("state"))
    return windows.latest(rows, ["user_id"], ["sequence"])


@query("""SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN 'broken_link' ELSE 'gap' END AS fault FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) WHERE n > 1 AND event_type = 'error'""")
def hash_chain(spark, folder):
    """Each user's events as a hash chain in which error events were tampered with: the check names them."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("user_id").orderBy("event_id")
    rows = table(spark, folder, "events").withColumn("own", F.sha2(F.col("event_id").cast("string"), 256)).withColumn("n", F.row_number().over(w))
    rows = rows.withColumn("previous", F.when(F.col("event_type") == "error", "tampered").otherwise(F.lag("own").over(w)))
    ids = rows.select("user_id", "n", "event_id")
    return windows.chain_faults(rows, "user_id", "n", "previous", "own").join(ids, ["user_id", "n"]).select("user_id", "event_id", "fault")


@query("SELECT o_custkey, o_orderkey, round(running, 2) AS running FROM (SELECT o_custkey, o_orderkey, sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS running FROM orders) WHERE running <= 400000")
def relationship_budget(spark, folder):
    kept = windows.within_budget(table(spark, folder, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], "o_totalprice", 400_000)
    return kept.select("o_custkey", "o_orderkey", F.round("running", 2).alias("running"))


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def result_page(spark, folder):
    """The third page of fifty."""
    return windows.page(table(spark, folder, "orders"), [F.desc("o_totalprice"), F.col("o_orderkey")], 3, 50).select("o_orderkey", "o_custkey")


@query("SELECT o_custkey, o_orderkey FROM orders WHERE (o_custkey, o_orderkey) > (77, 1000) ORDER BY o_custkey, o_orderkey LIMIT 40")
def keyset_page(spark, folder):
    return windows.after_key(table(spark, folder, "orders").select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"], (77, 1000), 40)


@query("""SELECT o_orderkey AS key, o_orderpriority AS title, event, strftime(d, '%Y-%m-%d') AS event_date FROM (SELECT o.o_orderkey, o_orderpriority, 'ordered' AS event, o_orderdate AS d FROM orders o
 UNION ALL SELECT o.o_orderkey, o_orderpriority, 'first_shipped', s FROM orders o JOIN (SELECT l_orderkey, min(l_shipdate) AS s FROM lineitem GROUP BY 1) l ON l_orderkey = o.o_orderkey) WHERE d IS NOT NULL""")
def timeline(spark, folder):
    shipped = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("first_shipped"))
    rows = table(spark, folder, "orders").join(shipped, "o_orderkey", "left").select(F.col("o_orderkey").alias("key"), F.col("o_orderpriority").alias("title"), F.col("o_orderdate").alias("ordered"), "first_shipped")
    return windows.timeline(rows, "key", "title", ["ordered", "first_shipped"]).withColumn("event_date", F.date_format("event_date", "yyyy-MM-dd"))


@query("SELECT a.n_regionkey, a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name < b.n_name")
def pair_overlay(spark, folder):
    return assign.combinations(table(spark, folder, "nation"), "n_regionkey", "n_name")


@query("SELECT o_orderkey, bool_and(l_returnflag <> 'R') AS ready FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def readiness(spark, folder):
    """Whether all that an order depends on is done: a universal test over its dependencies."""
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.bool_and(F.col("l_returnflag") != "R").alias("ready"))
    return table(spark, folder, "orders").select("o_orderkey").join(lines, "o_orderkey")


@query("SELECT q.pos, q.name, coalesce(n_nationkey, -1) AS n_nationkey FROM (VALUES (0, 'NATION_7'), (1, 'none'), (2, 'NATION_3'), (3, 'NATION_7')) q(pos, name) LEFT JOIN (SELECT 'NATION_' || n_nationkey AS name, n_nationkey FROM nation) USING (name)")
def ordered_lookup(spark, folder):
    asked = spark.createDataFrame([(0, "NATION_7"), (1, "none"), (2, "NATION_3"), (3, "NATION_7")], "pos int, name string")
    nations = table(spark, folder, "nation").select(F.concat(F.lit("NATION_"), "n_nationkey").alias("name"), "n_nationkey")
    return asked.join(F.broadcast(asked.select("name").distinct()).join(nations, "name"), "name", "left").select("pos", "name", F.coalesce("n_nationkey", F.lit(-1)).alias("n_nationkey"))


@query("SELECT i.input_id, w.work_id FROM inputs i JOIN (SELECT DISTINCT work_id, url, locale FROM work_items) w ON i.url = w.url AND i.locale = w.locale WHERE i.role = 't1_enumeration'")
def keyed_join(spark, folder):
    work = table(spark, folder, "work_items").select("work_id", "url", "locale").distinct()
    return table(spark, folder, "inputs").where("role = 't1_enumeration'").join(work, ["url", "locale"]).select("input_id", "work_id")


@query("SELECT DISTINCT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def without_orders(spark, folder):
    """Customers without a large order."""
    return table(spark, folder, "customer").join(table(spark, folder, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("SELECT DISTINCT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority LIKE '1%')")
def with_urgent_orders(spark, folder):
    urgent = table(spark, folder, "orders").where("o_orderpriority LIKE '1%'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, folder, "customer").join(urgent, "c_custkey", "left_semi").select("c_custkey")


@query("""WITH l AS (SELECT DISTINCT unnest(second_level_browse_pages) AS ref FROM acquisition), p AS (SELECT DISTINCT content_id, base_path FROM acquisition WHERE content_id IS NOT NULL)
 SELECT ref, min(content_id) AS content_id FROM (SELECT ref, content_id FROM l JOIN p ON content_id = ref UNION SELECT ref, content_id FROM l JOIN p ON base_path = ref) GROUP BY ref""")
def either_key_join(spark, folder):
    """A join on one key or another, as two joins and a union."""
    refs = table(spark, folder, "acquisition").select(F.explode("second_level_browse_pages").alias("ref")).distinct()
    pages = table(spark, folder, "acquisition").where("content_id IS NOT NULL").select("content_id", "base_path").distinct()
    both = refs.join(pages.select(F.col("content_id").alias("ref"), "content_id"), "ref").unionByName(refs.join(pages.select(F.col("base_path").alias("ref"), "content_id"), "ref"))
    return both.groupBy("ref").agg(F.min("content_id").alias("content_id"))


def _tree(spark, folder):
    return durable(hierarchy.resolve(hierarchy.page_links(table(spark, folder, "acquisition"))[1]), "tree")


@query(_TREE + "SELECT root AS root_id, count(*) AS n_pages, max(coalesce(depth, -1)) AS max_depth FROM nodes LEFT JOIN tree USING (id) GROUP BY root")
def tree_sizes(spark, folder):
    """Pages of each tree, and those caught in cycles."""
    return _tree(spark, folder).groupBy("root_id").agg(F.count(F.lit(1)).alias("n_pages"), F.max("depth").alias("max_depth"))
