"""Property graph: typed edges with evidence, target resolution with stubs, adjacency, identifiers, traversal, closure, integrity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.functions.identity import adjacency_bucket, assertion_id, first_nonempty
from ledgerloom.operators.balance import lookup
from ledgerloom.session import durable

#: Names of link kinds; any other kind's name is its field name with spaces.
LINK_KINDS = {
    "organisations": "associated with organisation", "primary_publishing_organisation": "published by",
    "original_primary_publishing_organisation": "originally published by", "owning_organisation": "owned by",
    "lead_organisations": "led by", "parent": "part of", "parents": "part of", "parent_taxons": "child of", "child_taxons": "parent of",
    "taxons": "classified under", "mainstream_browse_pages": "classified under", "top_level_browse_pages": "parent of",
    "second_level_browse_pages": "parent of", "document_collections": "part of collection", "related": "related to",
    "ordered_related_items": "related to", "related_to_step_navs": "part of step by step", "part_of_step_navs": "part of step by step",
    "available_translations": "available in language", "world_locations": "applies to world location", "topical_events": "part of topical event",
}

LINKS = "map<string,array<struct<content_id:string,base_path:string,web_url:string,title:string,locale:string,document_type:string>>>"


def link_kind(name: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in LINK_KINDS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, name), F.replace(name, F.lit("_"), F.lit(" ")))


def json_links(records: DataFrame, key: str, text: str) -> DataFrame:
    """(key, predicate, position, content_id, url, title): the `links` map of JSON records, one row per link, predicates in order. Links with neither
    id nor address are skipped; a record whose links are no map of lists has none here (nested.flatten reads those)."""
    links = F.from_json(F.get_json_object(F.col(text), "$.links"), LINKS)
    each = records.select(key, F.explode(F.map_entries(links)).alias("e")).select(key, F.col("e.key").alias("predicate"), F.posexplode("e.value").alias("position", "link"))
    rows = each.select(key, "predicate", "position", F.col("link.content_id").alias("content_id"), first_nonempty(F.col("link.web_url"), F.col("link.base_path")).alias("url"), F.col("link.title").alias("title"))
    return rows.where(F.col("content_id").isNotNull() | F.col("url").isNotNull())


def list_edges(rows: DataFrame, source: str, lists: Sequence[str]) -> DataFrame:
    """(source, predicate, kind, position, target) of array columns, one edge per item; null and empty items are skipped."""

    def item(name: str):
        return lambda x, i: F.struct(F.lit(name).alias("predicate"), i.cast("int").alias("position"), x.alias("target"))

    items = F.concat(*[F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), item(c)) for c in lists])
    each = rows.select(F.col(source).alias("source"), F.explode(items).alias("e")).where(F.col("e.target") != "")
    return each.select("source", "e.predicate", link_kind(F.col("e.predicate")).alias("kind"), "e.position", F.trim("e.target").alias("target"))


def asserted(edges: DataFrame, evidence: Column) -> DataFrame:
    """Edges with their reproducible id; of repeated assertions the last by position is kept."""
    own = assertion_id(F.col("source"), F.col("kind"), F.col("target"), evidence, F.col("predicate"), F.lit("/"))
    named = edges.withColumn("assertion_id", own)
    return named.groupBy("assertion_id", "source", "kind", "target", "predicate").agg(F.max("position").alias("position"), F.count(F.lit(1)).alias("observations"))


def resolve_targets(edges: DataFrame, by_id: DataFrame, by_url: DataFrame) -> DataFrame:
    """Each edge with the node its target names: by id first, by address (with or without a trailing slash) second. by_id and by_url: (name, node), each
    name once. An edge neither names keeps a null node."""
    first = lookup(edges, by_id.select(F.col("name").alias("target"), F.col("node").alias("n1")), ["target"], "left")
    bare = first.withColumn("_bare", F.regexp_replace(F.lower("target"), "/+$", ""))
    second = lookup(bare, by_url.select(F.col("name").alias("_bare"), F.col("node").alias("n2")), ["_bare"], "left")
    return second.withColumn("node", F.coalesce("n1", "n2")).drop("n1", "n2", "_bare")


def stubs(resolved: DataFrame) -> DataFrame:
    """(node, n_links): a stub node for each target that names none, made once however many edges point there."""
    return resolved.where(F.col("node").isNull()).groupBy(F.concat(F.lit("stub/"), F.left(F.sha2("target", 256), F.lit(24))).alias("node")).agg(F.count(F.lit(1)).alias("n_links"))


def retained(rows: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per entity: its first row by `order`, its empty fields filled by the first later row that has one; conflict says that some field
    has two different non-empty values. Combined before the shuffle; no list of the entity's rows is made."""
    rank = F.struct(*order)
    filled = [F.min(F.when(F.col(c) != "", F.struct(*order, F.col(c).alias("_v")))).getField("_v").alias(c) for c in columns]
    clash = F.lit(False)
    for c in columns:
        clash = clash | F.coalesce(F.min(F.when(F.col(c) != "", F.col(c))) != F.max(F.when(F.col(c) != "", F.col(c))), F.lit(False))
    return rows.where(F.col(key) != "").groupBy(key).agg(F.min(rank).alias("_first"), *filled, clash.alias("conflict"), F.count(F.lit(1)).alias("n_rows")).drop("_first")


def adjacency(edges: DataFrame) -> DataFrame:
    """(bucket, route, source, kind, target): each edge under both its ends, once for a self loop."""
    both = edges.select("source", "kind", "target", F.explode(F.array_distinct(F.array("source", "target"))).alias("route"))
    return both.select(adjacency_bucket(F.col("route")).alias("bucket"), "route", "source", "kind", "target")


def adjacency_routes(edges: DataFrame) -> DataFrame:
    """(bucket, route, n_entries): the buckets' contents, the hash being worked out once for each route."""
    ends = edges.select(F.explode(F.array_distinct(F.array("source", "target"))).alias("route")).groupBy("route").agg(F.count(F.lit(1)).alias("n_entries"))
    return ends.select(adjacency_bucket(F.col("route")).alias("bucket"), "route", "n_entries")


def identifiers(rows: DataFrame, key: str, names: Mapping[str, Column]) -> DataFrame:
    """(identifier, kind, key) of all names of all rows, empty ones left out, each once. An identifier may name several rows: that is data."""
    each = F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("identifier")) for k, c in names.items()])
    return rows.select(key, F.explode(each).alias("i")).where(F.col("i.identifier") != "").select("i.identifier", "i.kind", key).distinct()


def one_match(asked: DataFrame, index: DataFrame, key: str, kinds: Mapping[str, str]) -> DataFrame:
    """(identifier, kind, key, fault) of asked identifiers (identifier, and a kind or null). A null kind follows from the identifier's prefix (kinds: prefix -> kind), else any will do. fault is
    `unknown` where no row answers and `ambiguous` where several do; key is null then."""
    inferred = F.coalesce("kind", *[F.when(F.startswith("identifier", F.lit(p)), F.lit(k)) for p, k in kinds.items()])
    wanted = asked.distinct().select("identifier", inferred.alias("kind"))
    known = index.select("identifier", F.col("kind").alias("_kind"), F.col(key).alias("_key")).distinct()
    found = wanted.join(known, "identifier", "left").where(F.col("_kind").isNull() | F.col("kind").isNull() | (F.col("kind") == F.col("_kind")))
    counts = found.groupBy("identifier", "kind").agg(F.countDistinct("_key").alias("n"), F.min("_key").alias(key))
    # What only rows of other kinds answer is unknown too.
    whole = wanted.select("identifier", F.col("kind").alias("_k")).join(counts.withColumnRenamed("kind", "_c").withColumnRenamed("identifier", "_i"), (F.col("identifier") == F.col("_i")) & F.col("_k").eqNullSafe(F.col("_c")), "left")
    fault = F.when(F.coalesce("n", F.lit(0)) == 0, "unknown").when(F.col("n") > 1, "ambiguous")
    return whole.select("identifier", F.col("_k").alias("kind"), F.when(F.col("n") == 1, F.col(key)).alias(key), fault.alias("fault"))


def resolve(asked: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """(identifier, n_matches, key) for each asked identifier: the key only where exactly one row answers."""
    found = asked.distinct().join(index.select("identifier", key).distinct(), "identifier", "left").groupBy("identifier").agg(F.count(key).alias("n_matches"), F.min(key).alias(key))
    return found.select("identifier", "n_matches", F.when(F.col("n_matches") == 1, F.col(key)).alias(key))


def dangling(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(side, source, kind, target) of edges with an end that is no node (nodes: node)."""
    src = edges.join(nodes.select(F.col("node").alias("source")), "source", "left_anti").select(F.lit("source").alias("side"), "source", "kind", "target")
    dst = edges.join(nodes.select(F.col("node").alias("target")), "target", "left_anti").select(F.lit("target").alias("side"), "source", "kind", "target")
    return src.unionByName(dst)


def cover_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one relation that the other lacks, with the side that has them; empty if and only if both are equal as sets."""
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.subtract(a).withColumn("side", F.lit("right")))


def one_hop(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Edges that touch a seed (seeds: node) at either end, each once. Two semi joins and a union: a join on `or` would be a nested loop."""
    wanted = seeds.select("node").distinct()
    out = edges.join(wanted.withColumnRenamed("node", "source"), "source", "left_semi").select(edges.columns)
    into = edges.join(wanted.withColumnRenamed("node", "target"), "target", "left_semi").select(edges.columns)
    return out.union(into).distinct()


def bounded_bfs(edges: DataFrame, seeds: DataFrame, hops: int = 2, max_nodes: int | None = None) -> DataFrame:
    """(seed, node, hop): nodes within `hops` steps of each seed in either direction, at their least distance, for many seeds at once. With max_nodes, of
    each seed the nearest ones by (hop, node), and truncated says that there were more."""
    both = edges.select(F.col("source").alias("a"), F.col("target").alias("b")).union(edges.select("target", "source"))  # repeats go with the steps
    reached = seeds.select(F.col("node").alias("seed"), "node", F.lit(0).alias("hop")).distinct()
    front = reached
    for hop in range(1, hops + 1):
        step = front.select("seed", F.col("node").alias("a")).join(both, "a").select("seed", F.col("b").alias("node")).distinct()
        fresh = step.join(reached.select("seed", "node"), ["seed", "node"], "left_anti")
        if max_nodes is not None:
            # A hop's nodes beyond max_nodes can't be shown, and what they lead to comes after all of this hop: no hub is carried on further than that.
            fresh = fresh.withColumn("_place", F.row_number().over(Window.partitionBy("seed").orderBy("node"))).where(F.col("_place") <= max_nodes + 1).drop("_place")
        front = durable(fresh.withColumn("hop", F.lit(hop)), "bfs-front")
        reached = reached.unionByName(front)
    if max_nodes is None:
        return reached
    per_seed = Window.partitionBy("seed")
    ranked = reached.withColumn("rank", F.row_number().over(per_seed.orderBy("hop", "node"))).withColumn("truncated", F.count(F.lit(1)).over(per_seed) > max_nodes)
    return ranked.where(F.col("rank") <= max_nodes).select("seed", "node", "hop", "truncated")


def closure(seeds: DataFrame, edges: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """(node, round): everything reachable from the seeds along edges, with the round that found it. Each round joins only the last round's finds and
    leaves out what is known; state is a written table, so a lost executor costs one round at most."""
    known = durable(seeds.select("node").distinct().withColumn("round", F.lit(0)), "closure")
    front, links = known, edges.select(F.col("source").alias("node"), F.col("target").alias("next")).distinct()
    for number in range(1, max_rounds + 1):
        found = front.select("node").join(links, "node").select(F.col("next").alias("node")).distinct().join(known.select("node"), "node", "left_anti")
        front = durable(found.withColumn("round", F.lit(number)), "closure-front")
        if front.isEmpty():
            return known
        known = known.unionByName(front)
    raise ValueError("closure did not end within max_rounds")


def kind_counts(edges: DataFrame) -> DataFrame:
    return edges.groupBy("kind").agg(F.count(F.lit(1)).alias("n_edges"), F.countDistinct("source").alias("n_sources"), F.countDistinct("target").alias("n_targets"))


def adjacency_faults(edges: DataFrame, entries: DataFrame) -> DataFrame:
    """Edges whose number of adjacency entries isn't 2 (1 for a self loop): (source, kind, target, n, wanted)."""
    wanted = edges.groupBy("source", "kind", "target").agg((F.count(F.lit(1)) * F.when(F.first("source") == F.first("target"), 1).otherwise(2)).alias("wanted"))
    have = entries.groupBy("source", "kind", "target").agg(F.count(F.lit(1)).alias("n"))
    both = wanted.join(have, ["source", "kind", "target"], "full_outer")
    return both.select("source", "kind", "target", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("wanted", F.lit(0)).alias("wanted")).where("n <> wanted")
