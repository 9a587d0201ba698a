"""Parent-child links to full hierarchies: path, depth, root and descendants of every node, cycles named.

Roots and a hash-chosen part of the nodes are splitters. Every node walks up to its next splitter; only the pointers among
splitters are then solved to the roots; paths are put together from the two. The choice of splitters depends on the ids
alone, so a run that is repeated gives the same tables. A cycle without a splitter shows as a set of walks that never ends.

A parent that a third of all nodes have makes a join key hot. All joins here have the walks on their left side and one row a key on their right, the form whose
skewed partitions adaptive execution splits by their measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import durable, durable_counted, parts

#: One node in so many is a splitter, on the average.
STRIDE = 8


def page_links(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id) and links (parent, child) of a page table with content_id, base_path, parent_taxons, child_taxons and
    second_level_browse_pages. References are content ids or base paths without letter case and outer white space; null ones and
    those no page has are ignored, as are pages without a content id. Should pages share a base path, the smallest id has it."""
    own = pages.where(F.col("content_id").isNotNull() & (F.trim("content_id") != ""))
    clean = lambda c: F.lower(F.regexp_replace(c, r"^\s+|\s+$", ""))
    names = own.select("content_id", F.explode(F.array(F.struct(F.lit(0).alias("rank"), clean(F.col("content_id")).alias("ref")), F.struct(F.lit(1).alias("rank"), clean(F.col("base_path")).alias("ref")))).alias("n"))
    names = names.where(F.col("n.ref").isNotNull() & (F.col("n.ref") != "")).groupBy(F.col("n.ref").alias("ref")).agg(F.min(F.struct("n.rank", "content_id")).alias("best"))
    names = names.select("ref", F.col("best.content_id").alias("target"))
    up = own.select("content_id", F.lit(True).alias("up"), F.explode("parent_taxons").alias("ref"))
    down = own.select("content_id", F.lit(False).alias("up"), F.explode(F.concat(F.coalesce("child_taxons", F.array().cast("array<string>")), F.coalesce("second_level_browse_pages", F.array().cast("array<string>")))).alias("ref"))
    refs = up.unionByName(down).select("content_id", "up", clean(F.col("ref")).alias("ref")).where(F.col("ref").isNotNull() & (F.col("ref") != "")).distinct()
    found = refs.join(names, "ref")
    links = found.select(F.when(F.col("up"), F.col("target")).otherwise(F.col("content_id")).alias("parent"), F.when(F.col("up"), F.col("content_id")).otherwise(F.col("target")).alias("child")).distinct()
    return own.select(F.col("content_id").alias("id")).distinct(), links


def resolve(links: DataFrame, stride: int = STRIDE) -> DataFrame:
    """links: parent, child. Result: node_id, root_id, depth, node_path (array from root to node), on_cycle (on a cycle or below one;
    then root and path are null and depth is -1). One row for each node that has a link.

    A node stated with several parents keeps the smallest; null ends and repeated links are ignored; a link of a node to itself is a
    cycle. No links give an empty result.
    """

    def chosen(node: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(11), node), F.lit(stride)) == 0

    known = links.where(F.col("parent").isNotNull() & F.col("child").isNotNull())
    ends = known.select(F.explode(F.array(F.struct(F.col("child").alias("node"), F.col("parent").alias("up")), F.struct(F.col("parent").alias("node"), F.lit(None).cast("string").alias("up")))).alias("e"))
    # One row per node, roots with a null parent.
    nodes = durable(ends.groupBy(F.col("e.node").alias("node")).agg(F.min("e.up").alias("up")), "tree-nodes")
    root = F.col("up").isNull()
    # Of each walk: the node it began at, where it stands, whether that is its end, and the nodes passed, from below `at` down to the node. A first step costs no join. Roots have walks too, of no step.
    first = nodes.select("node", F.coalesce("up", "node").alias("at"), (root | chosen(F.col("up"))).alias("done"), F.when(root, F.array().cast("array<string>")).otherwise(F.array("node")).alias("steps"))
    ended, endless = _walk(first)
    solved = _solve(nodes.where(root).select("node"), ended.where(chosen(F.col("node")) & (F.size("steps") > 0)))
    whole = ended.join(solved.select(F.col("node").alias("at"), "root", "path"), "at", "left").select("node", "root", F.concat("path", "steps").alias("path"))
    if endless is not None:
        whole = whole.unionByName(endless.select("node", F.lit(None).cast("string").alias("root"), F.lit(None).cast("array<string>").alias("path")))
    on_cycle = F.col("root").isNull()
    return whole.select(
        F.col("node").alias("node_id"), F.col("root").alias("root_id"), F.when(on_cycle, -1).otherwise(F.size("path") - 1).alias("depth"), F.when(~on_cycle, F.col("path")).alias("node_path"), on_cycle.alias("on_cycle")
    )


def _walk(walks: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Walk all to their next splitter, doubling the steps each round. Returns the walks that ended, and those that never will (None if there are none).

    After r rounds an unfinished walk has passed 2^r nodes without a splitter. If a round ends no walk, none ever will: on the
    way of a walk that is still to end there is always a node whose own walk ends in this very round. Few unfinished walks are broadcast to the
    ways on (an inner join, so adaptive execution may send either side); only while they are many does a round move both.
    """
    done, unfinished, left, tables = walks.where("done"), walks.where("NOT done"), None, []
    while True:
        ahead = walks.select(F.col("node").alias("at"), F.col("at").alias("at2"), F.col("done").alias("done2"), F.col("steps").alias("steps2"))
        moved = unfinished.select("node", "at", "steps").join(ahead, "at").select("node", F.col("at2").alias("at"), F.col("done2").alias("done"), F.concat("steps2", "steps").alias("steps"))
        table, now = durable_counted(moved, "tree-walks", ~F.col("done"))
        tables.append(table)
        written, unfinished = parts(walks.sparkSession, tables).where("done"), table.where("NOT done")
        if now in (0, left):
            return done.unionByName(written), unfinished.select("node") if now else None
        walks, left = done.unionByName(written).unionByName(unfinished), now


def _solve(roots: DataFrame, pointers: DataFrame) -> DataFrame:
    """Roots (node) and pointers from splitters (node) to their next splitter or root (at) with the nodes below it down to the splitter (steps), solved by pointer jumping. Result: node, root,
    path, of roots and of splitters that reach one; those that reach none (on cycles through splitters, or below an endless walk) are left out."""
    spark, left, tables = roots.sparkSession, None, []
    none, nowhere = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    first = roots.select("node", F.col("node").alias("root"), F.array("node").alias("path"))
    settled, pending = first, pointers.select("node", "at", "steps")
    while True:
        # Standing at a settled splitter ends a pointer; otherwise it jumps over the pointer it stands on. A pointer that stands on
        # nothing (its target's walk never ended) is dropped, being below a cycle.
        ends = settled.select(F.col("node").alias("at"), "root", "path", none.alias("at2"), nowhere.alias("steps2"))
        jumps = pending.select(F.col("node").alias("at"), none.alias("root"), nowhere.alias("path"), F.col("at").alias("at2"), F.col("steps").alias("steps2"))
        moved = pending.select("node", "at", "steps").join(ends.unionByName(jumps), "at").select(
            "node", "at2", "root", F.when(F.col("root").isNotNull(), F.concat("path", "steps")).alias("path"), F.when(F.col("root").isNull(), F.concat("steps2", "steps")).alias("steps")
        )
        table, now = durable_counted(moved, "tree-pointers", F.col("root").isNull())
        tables.append(table)
        settled = first.unionByName(parts(spark, tables).where(F.col("root").isNotNull()).select("node", "root", "path"))
        if now in (0, left):
            return settled  # all settled, or nothing settled and nothing dropped: what is left goes round in circles
        pending, left = table.where(F.col("root").isNull()).select("node", F.col("at2").alias("at"), "steps"), now


def descendants(resolved: DataFrame) -> DataFrame:
    """node_id, descendant_id, distance: one row for each pair of a node and a node below it, off cycles. As many rows as the sum of depths."""
    tree = resolved.where(~F.col("on_cycle")).select(F.col("node_id").alias("descendant_id"), "depth", F.posexplode("node_path").alias("level", "node_id"))
    return tree.where(F.col("level") < F.col("depth")).select("node_id", "descendant_id", (F.col("depth") - F.col("level")).alias("distance"))
