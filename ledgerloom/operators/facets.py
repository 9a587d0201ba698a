"""Facets, filters and host topology."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.urls import host_kind, host_of


def facet_counts(rows: DataFrame, facets: Mapping[str, Column]) -> DataFrame:
    """(facet, value, n) of all facets in one pass; array columns count each of their distinct values, null and empty ones none."""
    def named(name: str):
        return lambda v: F.struct(F.lit(name).alias("facet"), v.cast("string").alias("value"))

    parts = []
    for name, column in facets.items():
        many = rows.select(column.alias("c")).schema["c"].dataType.typeName() == "array"
        values = F.array_distinct(column) if many else F.array(column)
        parts.append(F.transform(F.coalesce(values, F.array().cast("array<string>")), named(name)))
    each = rows.select(F.explode(F.concat(*parts)).alias("f")).select("f.facet", "f.value")
    return each.where(F.col("value") != "").groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def facet_filter(rows: DataFrame, chosen: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows with one of the chosen values of each facet: `or` within a facet, `and` across; an array column matches by any member."""
    for column, values in chosen.items():
        if rows.schema[column].dataType.typeName() == "array":
            rows = rows.where(F.arrays_overlap(F.col(column), F.array(*[F.lit(v) for v in values])))
        else:
            rows = rows.where(F.col(column).isin(list(values)))
    return rows


def prefix_match(query_tokens: Column, row_tokens: Column) -> Column:
    """Every query token equals or begins some token of the row."""
    return F.forall(query_tokens, lambda q: F.exists(row_tokens, lambda t: F.startswith(t, q)))


def host_topology(rows: DataFrame, url: str, route: str, kind: str, main: str, domain: str, examples: int = 3) -> DataFrame:
    """Per host: its kind, number of rows, schemes, number of rows of each routing kind as sorted `kind=n` texts, and the first example routes. The examples are
    an aggregate of bounded size per task: ranks come from a partial top-k of distinct routes."""
    seen = rows.select(host_of(F.col(url)).alias("host"), F.lower(F.regexp_extract(F.col(url), r"^\s*([A-Za-z]+)://", 1)).alias("scheme"), F.col(route).alias("route"), F.col(kind).alias("kind")).where(F.col("host") != "")
    counts = seen.groupBy("host", "kind").agg(F.count(F.lit(1)).alias("n"), F.collect_set("scheme").alias("schemes"))
    counts = counts.groupBy("host").agg(
        F.sum("n").alias("n_rows"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("schemes")))).alias("schemes"),
        F.array_sort(F.collect_list(F.concat_ws("=", F.coalesce("kind", F.lit("")), "n"))).alias("kinds"),
    )
    first = top_per_key(seen.select("host", "route").distinct(), ["host"], [F.col("route")], examples)
    first = first.groupBy("host").agg(F.array_sort(F.collect_list("route")).alias("examples"))
    return counts.join(first, "host", "left").select("host", host_kind(F.col("host"), main, domain).alias("host_kind"), "n_rows", "schemes", "kinds", "examples")


def top_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The k first rows of each key; each task passes on only its own k first (WindowGroupLimit)."""
    from pyspark.sql.window import Window

    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rank") <= k).drop("_rank")
