"""Queries of the general data-processing operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import balance, hierarchy, instants, nested, snapshots
from ledgerloom.session import durable, table

KEY_FIELDS = ["publisher", "document_type", "schema_name"]


def p1_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Per-key results of the three key fields over distinct records."""
    return balance.balanced_key_profile(table(spark, folder, "records"), "rid", KEY_FIELDS, ["title", "description"])


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    profile = balance.balanced_key_profile(table(spark, folder, "records"), "rid", KEY_FIELDS)
    return profile.where(F.col("is_major") & F.col("key_value").isNotNull() & (F.col("key_value") != "")).select("field_name", "key_value")


def p2_instants(spark: SparkSession, folder: str) -> DataFrame:
    """Every text of the three sources with its instant, null where it denotes none. Each source is a batch of one dictionary."""
    dictionary, whole = instants.InstantDictionary(spark), None
    for rows in instants.time_rows(spark, folder):
        part = instants.normalise(rows, dictionary)
        whole = part if whole is None else whole.unionByName(part)
    return whole


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return p2_instants(spark, folder).where(F.col("utc_micros").isNotNull()).select("source_table", "row_key", "field_name", "utc_micros").distinct()


def p4_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """All objects of all records, with intervals and parent links."""
    return nested.flatten(nested.nested_sources(spark, folder))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    nodes = nested.flatten(nested.nested_sources(spark, folder), payload=False, once=False)
    return nodes.where(F.col("parent_pre").isNotNull()).select("source_table", "row_id", "node_path", "parent_path").distinct()


def _typed(kind: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        nodes = nested.flatten(nested.nested_sources(spark, folder))
        return nodes.where(F.col("node_type") == kind).select("source_table", "row_id", "pre", "post", "node_path", "parent_pre", "parent_path", "scalars_json")

    query.__name__ = f"p4_{kind}s"
    query.__doc__ = f"The flat table of all {kind} nodes; an item is a scalar in a list, its scalars_json the JSON of it." if kind == "item" else f"The flat table of all {kind} nodes."
    return query


def p4_link_attachments(spark: SparkSession, folder: str) -> DataFrame:
    """Every node with its nearest enclosing link, found by joining the two node tables on interval containment."""
    nodes = nested.node_tables(nested.nested_sources(spark, folder))
    linked = nested.contained(nodes["object"].select("source_table", "row_id", "pre", "post", "node_path"), nodes["link"])
    return linked.where(F.col("outer_pre").isNotNull()).select("source_table", "row_id", "node_path", F.col("outer_path").alias("link_path"))


def p6_delta(spark: SparkSession, folder: str) -> DataFrame:
    """Differing records with the full values of both sides."""
    rows = snapshots.snapshot_rows(spark, folder)
    delta = durable(snapshots.snapshot_delta(rows), "delta")
    return snapshots.differing_values(rows, delta)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.snapshot_delta(snapshots.snapshot_rows(spark, folder)).select("source_table", "row_id", "delta_class").distinct()


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    tree = hierarchy.resolve(hierarchy.page_links(table(spark, folder, "acquisition"))[1])
    cycle = F.col("on_cycle")
    return tree.select(
        "node_id", F.when(cycle, "cycle").otherwise(F.col("root_id")).alias("root_id"), "depth", F.when(cycle, "cycle").otherwise(F.array_join("node_path", ">")).alias("node_path")
    ).distinct()


def p7_descendants(spark: SparkSession, folder: str) -> DataFrame:
    """Each pair of a page and a page below it, off cycles, with their distance."""
    return hierarchy.descendants(hierarchy.resolve(hierarchy.page_links(table(spark, folder, "acquisition"))[1]))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_profile, p2_found, p2_instants, p4_found, p4_nodes, _typed("link"), _typed("attachment"), _typed("object"), _typed("item"), p4_link_attachments, p6_found, p6_delta, p7_found, p7_descendants)
}

_KEYS = """
WITH once AS (SELECT rid, min(publisher) AS publisher, min(document_type) AS document_type, min(schema_name) AS schema_name,
                     max(coalesce(length(title), 0) + coalesce(length(description), 0)) AS chars FROM records WHERE rid IS NOT NULL GROUP BY rid),
 k AS (SELECT 'publisher' AS field_name, publisher AS key_value, chars FROM once UNION ALL SELECT 'document_type', document_type, chars FROM once
       UNION ALL SELECT 'schema_name', schema_name, chars FROM once),
 d AS (SELECT 'publisher' AS field_name, publisher AS key_value FROM records UNION ALL SELECT 'document_type', document_type FROM records
       UNION ALL SELECT 'schema_name', schema_name FROM records),
 g AS (SELECT field_name, key_value, count(*) AS n_records, CAST(sum(chars) AS BIGINT) AS total_chars, CAST(max(chars) AS BIGINT) AS max_chars FROM k GROUP BY ALL),
 n AS (SELECT count(*) AS n_total FROM once), r AS (SELECT field_name, key_value, count(*) AS rows_delivered FROM d GROUP BY ALL)
"""
_FP = "regexp_replace(regexp_replace(lower(coalesce({}, '')), '[\\s\\x{{00A0}}]+', '', 'g'), '^[a-z][a-z0-9_\\-]*:', '')"
_DELTA = f"""
WITH i AS (SELECT role, regexp_replace(lower(url), '[^\\p{{L}}\\p{{N}}]+', '', 'g') AS u, locale, input_id, {_FP.format("fingerprint")} AS fp,
                  row_number() OVER (PARTITION BY role, regexp_replace(lower(url), '[^\\p{{L}}\\p{{N}}]+', '', 'g'), locale ORDER BY delivered_at DESC NULLS LAST, input_id DESC) AS rn,
                  min(input_id) OVER (PARTITION BY role, regexp_replace(lower(url), '[^\\p{{L}}\\p{{N}}]+', '', 'g'), locale) AS first_id FROM inputs),
 o AS (SELECT * FROM i WHERE role = 't0_enumeration' AND rn = 1), n AS (SELECT * FROM i WHERE role = 't1_enumeration' AND rn = 1),
 w AS (SELECT DISTINCT work_id, {_FP.format("t0_fingerprint")} AS f0, {_FP.format("t1_fingerprint")} AS f1 FROM work_items)
SELECT 'inputs' AS source_table, coalesce(n.first_id, o.first_id) AS row_id,
       CASE WHEN o.first_id IS NULL THEN 'added' WHEN n.first_id IS NULL THEN 'removed' ELSE 'changed' END AS delta_class{{}}
FROM o FULL JOIN n ON o.u IS NOT DISTINCT FROM n.u AND o.locale IS NOT DISTINCT FROM n.locale
WHERE o.first_id IS NULL OR n.first_id IS NULL OR o.fp <> n.fp
UNION ALL SELECT 'work_items', work_id, CASE WHEN f0 = '' THEN 'added' WHEN f1 = '' THEN 'removed' ELSE 'changed' END{{}} FROM w WHERE f0 <> f1
"""
_TREE = """
WITH RECURSIVE own AS (SELECT * FROM acquisition WHERE trim(content_id) <> ''),
 names AS (SELECT ref, arg_min(id, (rank, id)) AS target FROM (SELECT lower(trim(content_id)) AS ref, content_id AS id, 0 AS rank FROM own
           UNION ALL SELECT lower(trim(base_path)), content_id, 1 FROM own) WHERE ref <> '' GROUP BY ref),
 refs AS (SELECT content_id AS id, true AS up, unnest(parent_taxons) AS ref FROM own UNION ALL SELECT content_id, false, unnest(child_taxons) FROM own
          UNION ALL SELECT content_id, false, unnest(second_level_browse_pages) FROM own),
 links AS (SELECT DISTINCT CASE WHEN up THEN target ELSE id END AS parent, CASE WHEN up THEN id ELSE target END AS child
           FROM refs JOIN names ON names.ref = lower(regexp_replace(refs.ref, '^\\s+|\\s+$', '', 'g'))),
 up AS (SELECT child, min(parent) AS parent FROM links GROUP BY child),
 nodes AS (SELECT parent AS id FROM links UNION SELECT child FROM links),
 tree AS (SELECT id, id AS root, 0 AS depth, id AS path FROM nodes WHERE id NOT IN (SELECT child FROM up)
          UNION ALL SELECT up.child, tree.root, tree.depth + 1, tree.path || '>' || up.child FROM tree JOIN up ON up.parent = tree.id)
"""
SQL = {
    "p1_profile": _KEYS + "SELECT g.field_name, g.key_value, n_records, rows_delivered, total_chars, max_chars, n_total, n_records * 25 >= n_total AS is_major FROM g JOIN r ON g.field_name = r.field_name AND g.key_value IS NOT DISTINCT FROM r.key_value, n",
    "p1_found": _KEYS + "SELECT field_name, key_value FROM g, n WHERE n_records * 25 >= n_total AND key_value <> ''",
    "p6_found": _DELTA.replace("{}", ""),
    "p6_delta": _DELTA.replace("{}", ", o.fp AS old_content, n.fp AS new_content", 1).replace("{}", ", nullif(f0, ''), nullif(f1, '')"),
    "p7_found": _TREE + "SELECT nodes.id AS node_id, coalesce(root, 'cycle') AS root_id, coalesce(depth, -1) AS depth, coalesce(path, 'cycle') AS node_path FROM nodes LEFT JOIN tree USING (id)",
    "p7_descendants": _TREE.replace("tree.path || '>' || up.child", "tree.path || '>' || up.child") + "SELECT a.id AS node_id, d.id AS descendant_id, d.depth - a.depth AS distance FROM tree a JOIN tree d ON starts_with(d.path, a.path || '>')",
}
