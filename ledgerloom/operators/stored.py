"""A search index that is written once and read pruned: postings, lexicon, completions, term counts, documents, routes, adjacency.

Tables that are looked up by token or prefix have a shard (its first two letters or digits), those looked up by an identifier one of the 256 buckets of its hash. Each is range-partitioned and
sorted by these and written to a folder for each first letter of them; documents are sorted by ordinal, in chunks of 1,000. A reader names the few shards, buckets or ordinals it needs as literals, so that
only their folders, files and row groups are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.identity import adjacency_bucket, search_shard
from ledgerloom.operators import graph, index, packing
from ledgerloom.session import durable, read_text, write_text

#: Documents of a chunk, and bytes of a postings partition.
CHUNK = 1000
PARTITION_BYTES = 5 * 1024 * 1024
#: Bytes around the entries of a partition, of which the first has a separator one byte shorter.
_FRAME = len('{\n  "tokens": {') + len("\n  }\n}\n") - 1


def entry_bytes(lists: DataFrame) -> DataFrame:
    """(shard, token, bytes): the exact UTF-8 size of each token's entry in an indented JSON object of postings [ordinal, score, mask], with its separator. Tokens are ASCII."""
    digits = F.length(F.col("ordinal").cast("string")) + F.length(F.col("score").cast("string")) + F.length(F.col("mask").cast("string"))
    return lists.groupBy("shard", "token").agg((F.sum(digits + 46) + F.length("token") + 16).alias("bytes"))


def posting_partitions(lists: DataFrame, limit: int = PARTITION_BYTES) -> DataFrame:
    """(shard, token, part): tokens of each shard in order, greedily in partitions of at most `limit` bytes; a token is never cut, and one that exceeds the limit by itself fails the job."""
    sized = entry_bytes(lists)
    room = limit - _FRAME
    checked = sized.withColumn("bytes", F.when(F.col("bytes") > room, F.raise_error(F.concat(F.lit("postings too large: "), F.col("token"))).cast("long")).otherwise(F.col("bytes")))
    return packing.greedy_shards(checked, "shard", ["token"], "bytes", room, 2**31 - 1, "part").select("shard", "token", "part")


def write_index(rows: DataFrame, ordinal: str, fields: Mapping[str, Column], text: Column, names: Mapping[str, Column], path: str, cap: int = index.POSTING_CAP, limit: int = PARTITION_BYTES) -> None:
    """Write all tables of an index over rows with a unique ordinal. fields are indexed with their weights, text is what BM25 ranks, names are the identifiers a row is found by."""
    rows = durable(rows, "indexed-rows")
    found = durable(index.postings(rows, ordinal, fields), "postings")
    terms = durable(found.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "lexicon")
    lists = durable(index.capped(found, cap).select("token", "ordinal", "score", "mask", "rank", "shard"), "lists")
    parts = durable(posting_partitions(lists, limit), "posting-parts")

    def write(df: DataFrame, name: str, by: str, order: Sequence[str]) -> None:
        _write_sorted(df, f"{path}/{name}", by, order)

    write(lists.join(parts, ["shard", "token"]), "postings", "shard", ["part", "token", "rank"])
    write(terms.withColumn("shard", search_shard(F.col("token"))).join(parts, ["shard", "token"]), "lexicon", "shard", ["token"])
    write(index.prefixes(terms).withColumn("shard", search_shard(F.col("prefix"))), "prefixes", "shard", ["prefix", "rank"])
    counts = durable(index.term_counts(rows, ordinal, text), "term-counts")
    write(counts.withColumn("shard", search_shard(F.col("token"))), "terms", "shard", ["token", "ordinal"])
    write(counts.groupBy("token").agg(F.count(F.lit(1)).alias("df")).withColumn("shard", search_shard(F.col("token"))), "frequencies", "shard", ["token"])
    counts.select("ordinal", "len").distinct().agg(F.count(F.lit(1)).alias("n"), F.avg("len").alias("average")).write.parquet(f"{path}/statistics")
    kept = rows.withColumn("chunk", F.floor(F.col(ordinal) / CHUNK).cast("long"))
    kept.repartitionByRange(ordinal).sortWithinPartitions(ordinal).write.parquet(f"{path}/documents")
    routes = graph.identifiers(rows.withColumn("_o", F.col(ordinal)), "_o", names).withColumnRenamed("_o", "ordinal").withColumn("bucket", adjacency_bucket(F.col("identifier")))
    write(routes, "routes", "bucket", ["identifier"])


def _write_sorted(df: DataFrame, path: str, by: str, order: Sequence[str]) -> None:
    """Written by folders of the first letter, with the schema beside them: a table without rows has no file that could tell it."""
    led = df.withColumn("lead", F.left(by, F.lit(1)))
    led.repartitionByRange(by, *order).sortWithinPartitions("lead", by, *order).write.partitionBy("lead").parquet(path)
    write_text(df.sparkSession, f"{path}/_schema.json", led.schema.json())


_schemas: dict[str, T.StructType] = {}


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A table as it was written. Its folders are letters and digits, read as text."""
    if path not in _schemas:
        _schemas[path] = T.StructType.fromJson(json.loads(read_text(spark, f"{path}/_schema.json")))
    return spark.read.schema(_schemas[path]).parquet(path)


def _led(table: DataFrame, by: str, values: Sequence[str]) -> DataFrame:
    """The rows of a written table with one of these shards or buckets, from their folders alone."""
    return table.where(F.col("lead").isin(sorted({v[:1] for v in values})) & F.col(by).isin(sorted(values))).drop("lead")


def write_adjacency(edges: DataFrame, path: str) -> None:
    """Each edge under both its ends, by bucket, sorted by route."""
    _write_sorted(graph.adjacency(edges), path, "bucket", ["route"])


class SearchIndex:
    """Reader of an index. Queries are tables (query_id, text); what a query table needs of the index is named by its shards, of which there are at most some 1,300 whatever the number of queries."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        return self.spark.read.parquet(path) if name in ("documents", "statistics") else _read(self.spark, path)

    def _parts(self, keys: DataFrame, key: str, *names: str) -> list[DataFrame]:
        """The parts of sharded tables that the keys (of a column) fall into."""
        shards = [r["s"] for r in keys.select(search_shard(F.col(key)).alias("s")).distinct().collect()]
        return [_led(self.table(name), "shard", shards) for name in names]

    def search(self, queries: DataFrame, limit: int = 20, cap: int = index.POSTING_CAP) -> DataFrame:
        lists, terms = self._parts(index.query_tokens(queries), "token", "postings", "lexicon")
        return index.search(queries, lists, terms.select("token", "df"), limit, cap)

    def bm25(self, queries: DataFrame, limit: int = 10) -> DataFrame:
        whole = self.table("statistics").first()
        counts, df = self._parts(index.query_tokens(queries), "token", "terms", "frequencies")
        return index.bm25(queries, counts.drop("shard"), df.drop("shard"), whole["n"], whole["average"] or 1.0, limit)

    def suggest(self, words: DataFrame) -> DataFrame:
        return index.suggest(words, *self._parts(words, "word", "prefixes"))

    def groups(self, query: DataFrame) -> DataFrame:
        """(query_id, token, member) of (query_id, token), see index.expand_missing."""
        terms, completions = self._parts(query, "token", "lexicon", "prefixes")
        return index.expand_missing(query, terms.select("token"), completions)

    def grouped_search(self, groups: DataFrame, limit: int = 20) -> DataFrame:
        return index.grouped_search(groups, *self._parts(groups, "member", "postings"), limit)

    def resolve(self, identifier: str, kind: str | None = None) -> dict:
        """The route entry (identifier, kind, ordinal) of one identifier, of the kind if that is stated. An error if none answers, or several rows."""
        bucket = self.spark.range(1).select(adjacency_bucket(F.lit(identifier))).first()[0]
        found = _led(self.table("routes"), "bucket", [bucket]).where(F.col("identifier") == identifier)
        rows = (found.where(F.col("kind") == kind) if kind else found).limit(100).collect()
        if len({r["ordinal"] for r in rows}) != 1:
            raise LookupError(f"{identifier!r} names {'no row' if not rows else 'several rows'}")
        return rows[0].asDict()

    def fetch(self, identifier: str, kind: str | None = None, ordinal: str = "rid") -> dict:
        """The whole row that an identifier names. An error if it isn't in its chunk, or doesn't hold the identifier it was found by."""
        entry = self.resolve(identifier, kind)
        rows = self.table("documents").where((F.col(ordinal) == entry["ordinal"]) & (F.col("chunk") == entry["ordinal"] // CHUNK)).limit(2).collect()
        if len(rows) != 1:
            raise LookupError(f"{identifier!r} points to ordinal {entry['ordinal']}, which is there {len(rows)} times")
        row = rows[0].asDict(recursive=True)
        if identifier not in row.values():
            raise LookupError(f"row {entry['ordinal']} doesn't hold {identifier!r}")
        return row

    def exact(self, values: Iterable[str], kinds: Sequence[str]) -> DataFrame:
        """(identifier, kind, ordinal) of rows whose identifiers of the kinds equal one of a few values."""
        asked = sorted(set(values))
        buckets = [r["b"] for r in self.spark.createDataFrame([(v,) for v in asked], "v string").select(adjacency_bucket(F.col("v")).alias("b")).distinct().collect()]
        return _led(self.table("routes"), "bucket", buckets).where(F.col("identifier").isin(asked) & F.col("kind").isin(list(kinds))).select("identifier", "kind", "ordinal")


def traverse(spark: SparkSession, path: str, route: str, kinds: Sequence[str] | None = None) -> DataFrame:
    """The edges at one node (source, kind, target), of some kinds, read from the one bucket that holds it."""
    bucket = spark.range(1).select(adjacency_bucket(F.lit(route))).first()[0]
    found = _led(_read(spark, path), "bucket", [bucket]).where(F.col("route") == route)
    return (found.where(F.col("kind").isin(list(kinds))) if kinds else found).select("source", "kind", "target")
