"""Projections of source records to catalogue rows, nested objects to edges, rows to linked-data nodes and to readable exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerloom.functions.identity import dataset_route, first_nonempty, title_from_path
from ledgerloom.functions.urls import host_kind, host_of
from ledgerloom.session import durable_counted


def lifecycle(redirects: Column, withdrawn: Column) -> Column:
    """redirect before withdrawn before published."""
    return F.when(redirects, "redirect").when(withdrawn, "withdrawn").otherwise("published")


def routing_kind(redirects: Column, external: Column, gone: Column) -> Column:
    return F.when(redirects, "redirect").when(external, "external_boundary").when(gone, "tombstone").otherwise("canonical")


def normalised(records: DataFrame, key: str, text: str, site: str = "https://www.gov.example") -> DataFrame:
    """Catalogue rows of JSON records: one row per record that is a JSON object, empty fields falling through to the next source. Damaged and other texts give none."""
    host = site.split("://", 1)[1]
    valid = records.where(F.try_parse_json(F.col(text)).isNotNull() & F.col(text).rlike(r"^\s*\{"))
    at = lambda p: F.get_json_object(F.col(text), "$." + p)
    path = first_nonempty(at("base_path"), F.lit("/"))
    url = first_nonempty(at("canonical_url"), F.concat(F.lit(site), path))
    redirected = F.coalesce(at("redirects"), F.lit("[]")) != "[]"
    kind = first_nonempty(at("document_type"), F.lit("unknown"))
    row = valid.select(
        key, dataset_route(at("content_id"), url, first_nonempty(at("locale"), F.lit("en"))).alias("open"), url.alias("url"), path.alias("base_path"), at("content_id").alias("content_id"),
        first_nonempty(at("title"), title_from_path(path), F.lit("Untitled")).alias("title"), F.coalesce(at("description"), F.lit("")).alias("description"), kind.alias("document_type"),
        first_nonempty(at("schema_name"), kind).alias("schema_name"), first_nonempty(at("locale"), F.lit("en")).alias("language"), lifecycle(redirected, at("withdrawn_notice").isNotNull()).alias("lifecycle"),
        routing_kind(redirected, kind.isin("external_content", "external_boundary"), kind == "gone").alias("routing_kind"),
        first_nonempty(at("public_updated_at"), at("updated_at"), at("lastmod"), at("first_published_at")).alias("timestamp"),
    )
    return row.withColumn("host_kind", host_kind(host_of(F.col("url")), host, host.split(".", 1)[-1]))


def json_array(text: Column, path: str, schema: str) -> Column:
    """The array of objects at a path; null where there is none (a lone object isn't a list)."""
    value = F.get_json_object(text, path)
    return F.when(F.startswith(value, F.lit("[")), F.from_json(value, f"array<struct<{schema}>>"))


def attachment_rows(records: DataFrame, key: str, text: str) -> DataFrame:
    """(key, position, id, title, content_type, file_size, url) of details.attachments with a web address."""
    items = json_array(F.col(text), "$.details.attachments", "id:string,title:string,content_type:string,file_size:bigint,url:string")
    each = records.select(key, F.posexplode(items).alias("position", "a")).select(key, "position", "a.*")
    return each.where(F.col("url").rlike("^https?://"))


def redirect_rows(records: DataFrame, key: str, text: str, site: str = "https://www.gov.example") -> DataFrame:
    """(key, ordinal, path, destination, destination_url, edge_target). A destination that is neither a path nor an address has no destination_url, yet its edge
    points to the site's address followed by it: the projection is strict, the edge keeps what was asserted."""
    items = json_array(F.col(text), "$.redirects", "path:string,destination:string,type:string,segments_mode:string")
    each = records.select(key, F.posexplode(items).alias("ordinal", "r"))
    to = F.col("r.destination")
    web = F.when(to.rlike("^https?://"), to).when(to.startswith("/"), F.concat(F.lit(site), to))
    target = first_nonempty(to, F.col("r.path"))
    edge = F.when(target.rlike("^https?://"), target).otherwise(F.concat(F.lit(site), target))
    return each.select(key, "ordinal", F.col("r.path").alias("path"), to.alias("destination"), F.coalesce(web, F.lit("")).alias("destination_url"), edge.alias("edge_target"))


def boundary_references(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """Links (predicate, content_id, url, title) to what is no seed by id nor by address, each once by all four."""
    by_id = links.join(seeds.where("content_id IS NOT NULL").select("content_id").distinct(), "content_id", "left_anti").select(*[c for c in links.columns])
    return by_id.join(seeds.where("url IS NOT NULL").select("url").distinct(), "url", "left_anti").select("predicate", "content_id", "url", "title").distinct()


def iri(prefix: str, *parts: Column) -> Column:
    """An address of percent-encoded parts; a space is %20."""
    enc = [F.replace(F.url_encode(F.coalesce(p.cast("string"), F.lit(""))), F.lit("+"), F.lit("%20")) for p in parts]
    return F.concat(F.lit(prefix), F.concat_ws("/", *enc))


def linked_nodes(rows: DataFrame, classes: Mapping[str, tuple[Column, Mapping[str, Column]]]) -> DataFrame:
    """(id, type, node): one linked-data object per row and class. classes: type -> (id, properties); a class whose id is null gives none. Null properties are
    left out of the object."""
    made = []
    for kind, (own, properties) in classes.items():
        body = F.to_json(F.struct(own.alias("@id"), F.lit(kind).alias("@type"), *[c.alias(n) for n, c in properties.items()]))
        made.append(F.when(own.isNotNull(), F.struct(own.alias("id"), F.lit(kind).alias("type"), body.alias("node"))))
    return rows.select(F.explode(F.array_compact(F.array(*made))).alias("n")).select("n.id", "n.type", "n.node")


def node_references(nodes: DataFrame) -> DataFrame:
    """(id, reference): every @id within a node but its own."""
    found = nodes.select("id", F.explode(F.regexp_extract_all("node", F.lit(r'"@id":"([^"]*)"'), 1)).alias("reference"))
    return found.where(F.col("reference") != F.col("id")).distinct()


def summary_json(*columns: str) -> Column:
    """The columns as one JSON object without nulls."""
    return F.to_json(F.struct(*columns))


def evidence_packs(results: DataFrame, relations: DataFrame, budget: int) -> DataFrame:
    """(query_id, ordinal, rank, n_relations, taken): relations (ordinal, n_relations) of ranked results under one budget per query, spent in rank order."""
    joined = results.join(relations, "ordinal", "left").withColumn("n_relations", F.coalesce("n_relations", F.lit(0)))
    before = F.coalesce(F.sum("n_relations").over(Window.partitionBy("query_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = F.least(F.col("n_relations"), F.greatest(F.lit(0), F.lit(budget) - before))
    return joined.withColumn("taken", taken).select("query_id", "ordinal", "rank", "n_relations", "taken")


def markdown_export(rows: DataFrame, group: str, order: str, title: Column, url: Column, text: Column) -> DataFrame:
    """(group, document): a result list as one Markdown text in order. A group is one answer, of bounded size."""
    entry = F.concat(F.lit("## "), title, F.lit("\n\n"), text, F.lit("\n\nSource: <"), url, F.lit(">\n"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), entry.alias("e"))))
    return rows.groupBy(group).agg(F.array_join(F.transform(ordered, lambda x: x["e"]), "\n").alias("document"))


def citation(title: Column, publisher: Column, url: Column, at: Column) -> Column:
    """Title, publisher, address and date in one line; what is empty is left out."""
    return F.concat_ws(". ", first_nonempty(title), first_nonempty(publisher), first_nonempty(url), F.when(at != "", F.concat(F.lit("Seen "), F.left(at, F.lit(10)))))


def json_pointer(pointer: str) -> str:
    """The JSON path of a JSON pointer, for get_json_object and variant_get."""
    parts = [p.replace("~1", "/").replace("~0", "~") for p in pointer.split("/")[1:]]
    return "$" + "".join(f"[{p}]" if p.isdigit() else "['" + p.replace("'", "\\'") + "']" for p in parts)


@F.pandas_udf(T.StringType())
def flattened_text(texts: pd.Series) -> pd.Series:
    """All strings and numbers of a JSON record in order, joined by spaces. Null for what is no JSON object."""
    from ledgerloom.functions.json_tools import record_of

    def one(text: str | None) -> str | None:
        record = record_of(text)
        if record is None:
            return None
        out, todo = [], [record]
        while todo:
            v = todo.pop()
            if isinstance(v, dict):
                todo.extend(reversed(v.values()))
            elif isinstance(v, list):
                todo.extend(reversed(v))
            elif v not in (None, "") and not isinstance(v, bool):
                out.append(str(v))
        return " ".join(out)

    return texts.map(one)


@F.pandas_udf(T.StringType())
def noisy_title(titles: pd.Series) -> pd.Series:
    """The title with two letters of its longest word swapped (the first of equally long ones; its second and third letter)."""

    def one(title: str | None) -> str | None:
        if not title:
            return title
        words = title.split(" ")
        at = max(range(len(words)), key=lambda i: len(words[i]))
        w = words[at]
        words[at] = w if len(w) < 4 else w[0] + w[2] + w[1] + w[3:]
        return " ".join(words)

    return titles.map(one)


def worded(rows: DataFrame, templates: Mapping[str, str], title: Column) -> DataFrame:
    """One row per row and template: (columns, operation, wording), `{}` standing for the title."""
    each = F.array(*[F.struct(F.lit(k).alias("operation"), F.replace(F.lit(t), F.lit("{}"), title).alias("wording")) for k, t in templates.items()])
    return rows.withColumn("_w", F.explode(each)).select(*rows.columns, "_w.operation", "_w.wording")


def pool_or_all(rows: DataFrame, group: Sequence[str], wanted: Column) -> DataFrame:
    """The wanted rows of each group, or all of a group that has none."""
    flags = rows.groupBy(*group).agg(F.max(F.coalesce(wanted, F.lit(False)).cast("int")).alias("_some"))
    return rows.join(flags, list(group)).where((F.col("_some") == 0) | wanted).drop("_some")


def upsert(existing: DataFrame, updates: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The table after updates: of each key the row of the greatest `order`, an update before an equal existing row."""
    from ledgerloom.operators.windows import latest

    both = existing.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)))
    return latest(both, keys, [order, "_new"]).select(*existing.columns)


def topological_levels(edges: DataFrame, max_rounds: int = 10_000) -> DataFrame:
    """(node, level): the longest way to each node of an acyclic graph; nodes on or behind a cycle have null. Each round takes off the nodes that nothing left points to; state is written tables."""
    from ledgerloom.session import discard, durable

    links = durable(edges.select(F.col("source").alias("a"), F.col("target").alias("b")).distinct(), "levels-links")
    left = durable(links.select(F.col("a").alias("node")).union(links.select("b")).distinct(), "levels-left")
    done = None
    for level in range(max_rounds):
        ready = durable(left.join(links.select(F.col("b").alias("node")).distinct(), "node", "left_anti").withColumn("level", F.lit(level)), "levels-ready")
        if ready.isEmpty():
            rest = left.withColumn("level", F.lit(None).cast("int"))
            return rest if done is None else done.unionByName(rest)
        done = ready if done is None else done.unionByName(ready)
        before = left, links
        left = durable(left.join(ready.select("node"), "node", "left_anti"), "levels-left")
        links = durable(links.join(ready.select(F.col("node").alias("a")), "a", "left_anti"), "levels-links")
        discard(*before)
    raise ValueError("more levels than max_rounds")


def centre_views(edges: DataFrame, max_nodes: int, max_edges: int) -> DataFrame:
    """(centre, source, kind, target, place): of each centre's edges (centre, source, kind, target) those that a view of so many nodes and edges shows: edges at the centre first, then by name,
    an edge being skipped if it would bring in a node too many. Sequential within a centre, whose edges are a neighbourhood."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        centre = pdf["centre"].iloc[0]
        away = ((pdf["source"] != centre) & (pdf["target"] != centre)).astype(int)
        nodes, rows = {centre}, []
        for s, k, t in pdf.assign(away=away).sort_values(["away", "source", "kind", "target"])[["source", "kind", "target"]].itertuples(index=False):
            if len(rows) >= max_edges:
                break
            if len(nodes | {s, t}) <= max_nodes:
                nodes |= {s, t}
                rows.append((centre, s, k, t, len(rows)))
        return pd.DataFrame(rows, columns=["centre", "source", "kind", "target", "place"])

    return edges.groupBy("centre").applyInPandas(run, "centre string, source string, kind string, target string, place int")


def staged_search(ranked: DataFrame, edges: DataFrame, seeds: int = 5, top: int = 10, bonus: DataFrame | None = None, by: Sequence[str] = ("query_id",)) -> DataFrame:
    """(by, ordinal, score, rank): results (by, ordinal, rank; maybe bonus; maybe linked, whether links count) score 10000 - 100 rank, plus a bonus (query_id, ordinal, bonus); records that the first `seeds` link to or are
    linked from (edges: source, target ordinals) come in 500 below the least result unless they are results; then the best `top`, ties by ordinal. Linked records are behind all results, so only lists of fewer than
    `top` results look for them."""
    by, extra = list(by), [c for c in ("linked",) if c in ranked.columns]
    score = 10_000 - 100 * F.col("rank") + (F.coalesce("bonus", F.lit(0)) if "bonus" in ranked.columns else F.lit(0))
    scored = ranked.select(*by, "ordinal", score.alias("score"), *extra)
    if bonus is not None:
        scored = scored.join(bonus, ["query_id", "ordinal"], "left").select(*by, "ordinal", (F.col("score") + F.coalesce("bonus", F.lit(0))).alias("score"), *extra)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "ordinal"))
    placed = scored.withColumn("rank", place).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*by))).where(F.col("rank") <= top)
    short = (F.col("_n") < top) & (F.coalesce("linked", F.lit(False)) if extra else F.lit(True))
    placed, n_short = durable_counted(placed, "staged", short)
    if not n_short:
        return placed.select(*by, "ordinal", "score", "rank")
    whole, short = placed.where(~short).select(*by, "ordinal", "score", "rank"), placed.where(short)
    first = short.where(F.col("rank") <= seeds).select(*by, "ordinal")
    out = first.join(edges.select(F.col("source").alias("ordinal"), F.col("target").alias("near")), "ordinal")
    into = first.join(edges.select(F.col("target").alias("ordinal"), F.col("source").alias("near")), "ordinal")
    near = out.unionByName(into).select(*by, F.col("near").alias("ordinal")).distinct().join(short.select(*by, "ordinal"), [*by, "ordinal"], "left_anti")
    floor = short.groupBy(*by).agg((F.min("score") - 500).alias("score"))
    more = short.select(*by, "ordinal", "score").unionByName(near.join(floor, by).select(*by, "ordinal", "score"))
    return whole.unionByName(more.withColumn("rank", place).where(F.col("rank") <= top).select(*by, "ordinal", "score", "rank"))


def pack_offsets(packed: DataFrame, shard: Sequence[str], order: Sequence[str], size: str) -> DataFrame:
    """Add `offset`: where each row begins in its shard, so that a reader can fetch its byte range alone."""
    w = Window.partitionBy(*shard).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return packed.withColumn("offset", F.coalesce(F.sum(size).over(w), F.lit(0)))


def install(spark, made: str, place: str) -> None:
    """Put a finished folder in place of another: the old one steps aside until the new one stands, and comes back if that fails."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    new, old, aside = Path(made), Path(place), Path(place + ".previous")
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(old)
    if had and not fs.rename(old, aside):
        raise OSError(f"can't move {place}")
    if not fs.rename(new, old):
        if had:
            fs.rename(aside, old)
        raise OSError(f"can't install {place}")
    if had:
        fs.delete(aside, True)

