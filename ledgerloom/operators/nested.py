"""Nested records to flat node tables with parent links, by interval labels.

A depth-first traversal numbers every node of a record on entry (pre) and on exit (post). Node a lies above node b exactly if
a.pre < b.pre and a.post > b.post, so tables of any node types can be linked afterwards without walking the records again.
Scalars in lists are nodes of the type item; those in objects stand in their object's row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.json_tools import opened, record_of
from ledgerloom.session import durable, scratch, spread

NODES = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("row_id", T.LongType()),
        T.StructField("pre", T.IntegerType()),
        T.StructField("post", T.IntegerType()),
        T.StructField("node_type", T.StringType()),
        T.StructField("field_name", T.StringType()),
        T.StructField("list_position", T.IntegerType()),
        T.StructField("node_path", T.StringType()),
        T.StructField("parent_pre", T.IntegerType()),
        T.StructField("parent_path", T.StringType()),
        T.StructField("scalars_json", T.StringType()),
    ]
)
#: Objects under these names have a type of their own, as have those in a map named links; every other one is an object.
TYPED = {"attachments": "attachment"}


def label(record: dict, items: bool = True) -> list[list]:
    """Every object of a record, and with items every scalar of its lists, in order of pre: [pre, post, node_type, field_name, list_position, node_path, value]. Lists
    and other scalars are nodes too and take numbers, but aren't emitted."""
    found: list[list] = []
    pre = post = 0
    todo: list[tuple] = [(record, "$", None, None, "record")]
    while todo:
        value, path, name, position, kind = todo.pop()
        if kind is None:  # the node whose entry this closes
            if value is not None:
                value[1] = post
            post += 1
            continue
        row = None
        here = pre
        pre += 1
        if isinstance(value, dict):
            row = [here, 0, kind, name, position, path, value]
            found.append(row)
            stem = "" if here == 0 else path + "."
            below = [(opened(v), stem + k, k, None, "link" if name == "links" else TYPED.get(k, "object")) for k, v in value.items()]
        elif isinstance(value, list):
            below = [(opened(v), f"{path}[{i}]", name, i, kind) for i, v in enumerate(value)]
        else:
            if items and position is not None:
                found.append([here, post, "item", name, position, path, value])
            post += 1
            continue
        todo.append((row, None, None, None, None))
        todo.extend(reversed(below))
    return found


def contain(nodes: list[list]) -> list[int]:
    """For nodes in order of pre, the index of the nearest node whose interval holds each one's, -1 for none."""
    open_: list[int] = []
    parents = []
    for i, node in enumerate(nodes):
        while open_ and nodes[open_[-1]][1] < node[1]:
            open_.pop()
        parents.append(open_[-1] if open_ else -1)
        open_.append(i)
    return parents


def _payload(value) -> str:
    return json.dumps({k: v for k, v in value.items() if not isinstance(v, dict | list)} if isinstance(value, dict) else value, ensure_ascii=False)


def _flatten(payload: bool):
    schema = pa.schema(
        [
            ("source_table", pa.string()), ("row_id", pa.int64()), ("pre", pa.int32()), ("post", pa.int32()), ("node_type", pa.string()), ("field_name", pa.string()),
            ("list_position", pa.int32()), ("node_path", pa.string()), ("parent_pre", pa.int32()), ("parent_path", pa.string()), ("scalars_json", pa.string()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for source, row_id, text in zip(*(batch.column(c).to_pylist() for c in ("source_table", "row_id", "text")), strict=True):
                record = record_of(text)
                if record is None:
                    continue
                nodes = label(record, payload)
                for node, up in zip(nodes, contain(nodes), strict=True):
                    above = nodes[up] if up >= 0 else None
                    scalars = _payload(node[6]) if payload else None
                    rows.append((source, row_id, *node[:6], above and above[0], above and above[5], scalars))
                if len(rows) >= 20_000:
                    yield _batch(rows, schema)
                    rows = []
            if rows:
                yield _batch(rows, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def flatten(records: DataFrame, payload: bool = True, once: bool = True) -> DataFrame:
    """Node table of records (source_table string, row_id long, text string): one row per object, the top-level one too, with
    its interval, type, path, and the parent by interval containment. payload adds the object's scalar fields as JSON, and a row for each scalar in a list (type item).

    A string holding the JSON text of an object or a list counts as what it holds. Null, empty, damaged and non-object texts
    give no rows; absent, null and empty containers give none below them. Of two fields of one name the last holds. Any depth is accepted. Redelivered rows are read once; with once=False
    each gives its rows again, for callers that drop repeats of their own result.
    """
    rows = records.select("source_table", F.col("row_id").cast("long").alias("row_id"), "text").where(F.col("text").isNotNull())
    return spread(first_deliveries(rows) if once else rows).mapInArrow(_flatten(payload), NODES)


def first_deliveries(rows: DataFrame) -> DataFrame:
    """Distinct rows of (source_table, row_id, text). Hashes of 128 bits find the rows that came several times; only these rows' texts are moved, all others stay where they are (or, should
    the rows that came several times be too many to broadcast, are joined by their keys)."""
    keyed = rows.select("*", F.xxhash64("text").alias("_h1"), F.xxhash64(F.lit(1), "text").alias("_h2"))
    keys = ["source_table", "row_id", "_h1", "_h2"]
    several = durable(keyed.groupBy(*[F.coalesce(F.col(k), F.lit(-1)).alias(k) if k == "row_id" else k for k in keys]).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "redelivered")
    known = keyed.withColumn("_id", F.col("row_id")).withColumn("row_id", F.coalesce("row_id", F.lit(-1)))
    alone = known.join(several, keys, "left_anti").select("source_table", F.col("_id").alias("row_id"), "text")
    return alone.unionByName(known.join(several, keys, "left_semi").select("source_table", F.col("_id").alias("row_id"), "text").distinct())


def node_tables(records: DataFrame) -> dict[str, DataFrame]:
    """One table for each type (record, link, attachment, object, item) from one pass over the records, written by type."""
    path = scratch(records.sparkSession, "node-tables")
    flatten(records).write.partitionBy("node_type").parquet(path)
    whole = records.sparkSession.read.schema(NODES).parquet(path)
    return {kind: whole.where(F.col("node_type") == kind) for kind in ("record", "link", "attachment", "object", "item")}


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (record, pre, post, path, outer, ...) in order of record and pre: each inner row with the nearest outer one whose interval holds it. What is held is the stack of open outer nodes, no deeper than the record."""
    now, open_ = None, []
    for batch in batches:
        at = {c: batch.column(c).to_pylist() for c in ("_record", "pre", "post", "_path", "_outer")}
        pres, paths = [], []
        for record, pre, post, path, outer in zip(*at.values(), strict=True):
            if record != now:
                now, open_ = record, []
            while open_ and open_[-1][1] < post:
                open_.pop()
            pres.append(open_[-1][0] if open_ and not outer else None)
            paths.append(open_[-1][2] if open_ and not outer else None)
            if outer:
                open_.append((pre, post, path))
        kept = pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in batch.schema.names if c not in ("_record", "_path")), pa.array(pres, pa.int32()), pa.array(paths, pa.string())],
            names=[*(c for c in batch.schema.names if c not in ("_record", "_path")), "outer_pre", "outer_path"],
        )
        yield kept


def contained(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """Link two node tables by interval containment: each row of inner with its nearest enclosing row of outer, if any. Adds outer_pre and outer_path; null where none encloses. A sweep over the
    nodes of each record in order of pre, so no pairs are made; a record of any size is streamed. A node that stands in both tables is enclosed by the others only."""
    where = ["source_table", "row_id"]
    record = F.concat_ws("\0", F.coalesce("source_table", F.lit("")), F.coalesce(F.col("row_id").cast("string"), F.lit("")))
    left = inner.withColumn("_path", F.lit(None).cast("string")).withColumn("_outer", F.lit(False))
    right = outer.select(*where, "pre", "post", F.col("node_path").alias("_path"), F.lit(True).alias("_outer"))
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_record", record)
    # An inner row comes before the outer row of the same node, so that it isn't its own.
    swept = both.repartition("_record").sortWithinPartitions("_record", "pre", "_outer")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in both.schema if f.name not in ("_record", "_path"))
    return swept.mapInArrow(_sweep, kinds + ", outer_pre int, outer_path string").where("NOT _outer").select(*inner.columns, "outer_pre", "outer_path")


def nested_sources(spark, folder: str) -> DataFrame:
    from ledgerloom.session import table

    def one(name, key, text):
        return table(spark, folder, name).select(F.lit(name).alias("source_table"), F.col(key).cast("long").alias("row_id"), F.col(text).alias("text"))

    return one("source_records", "seq", "raw_json").unionByName(one("queue", "queue_id", "record_json")).unionByName(one("candidates", "candidate_id", "candidate_json"))
