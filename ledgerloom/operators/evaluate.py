"""Evaluation of retrieval systems: ranking metrics, percentiles, slices, failures, paired comparison with confidence intervals."""

from __future__ import annotations

import functools
import math
from collections.abc import Mapping, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.session import durable


def ranking_metrics(results: DataFrame, gold: DataFrame, k: int = 10) -> DataFrame:
    """Per query of gold: recall, reciprocal rank and nDCG at k (gain 2^grade - 1), rounded to 9 places. results: (query_id, item, rank); gold: (query_id, item, grade), grade 0
    being irrelevant. A query without results scores 0; one without relevant items is left out."""
    wanted = gold.where("grade > 0")
    gain = lambda g: F.pow(F.lit(2.0), g) - 1
    # The ideal order needs only the number of items of each grade: of equal grades any order is as good. Counts are combined before the shuffle, so a query of a third of all rows is a few of them.
    grades = wanted.groupBy("query_id", "grade").agg(F.count(F.lit(1)).alias("n"))
    after = F.sum("n").over(Window.partitionBy("query_id").orderBy(F.desc("grade")))
    discounts = F.array(*[F.lit(sum(1 / math.log2(p + 1) for p in range(1, j + 1))) for j in range(k + 1)])
    upto = lambda n: F.element_at(discounts, (F.least(F.lit(k), n) + 1).cast("int"))
    share = gain(F.col("grade")) * (upto(F.col("after")) - upto(F.col("after") - F.col("n")))
    ideal = grades.withColumn("after", after).groupBy("query_id").agg(F.sum("n").alias("n_relevant"), F.sum(share).alias("ideal"))
    hits = results.where(F.col("rank") <= k).join(wanted, ["query_id", "item"]).groupBy("query_id")
    hits = hits.agg(F.count(F.lit(1)).alias("hits"), F.min("rank").alias("first"), F.sum(gain(F.col("grade")) / F.log2(F.col("rank") + 1.0)).alias("dcg"))
    both = ideal.join(hits, "query_id", "left")
    return both.select(
        "query_id", F.round(F.coalesce(F.col("hits") / F.col("n_relevant"), F.lit(0.0)), 9).alias("recall"), F.round(F.coalesce(1.0 / F.col("first"), F.lit(0.0)), 9).alias("mrr"),
        F.round(F.coalesce(F.col("dcg") / F.col("ideal"), F.lit(0.0)), 9).alias("ndcg"),
    )


def set_scores(rows: DataFrame, found: str, wanted: str) -> list[Column]:
    """Precision, recall and F1 of two array columns as sets; an empty set on both sides is a perfect match."""
    f, w = F.array_distinct(found), F.array_distinct(wanted)
    both = F.size(F.array_intersect(f, w))
    p = F.when(F.size(f) == 0, F.when(F.size(w) == 0, 1.0).otherwise(0.0)).otherwise(both / F.size(f))
    r = F.when(F.size(w) == 0, F.when(F.size(f) == 0, 1.0).otherwise(0.0)).otherwise(both / F.size(w))
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return [F.round(p, 9).alias("precision"), F.round(r, 9).alias("recall"), F.round(f1, 9).alias("f1")]


def confusion(rows: DataFrame, by: Sequence[str], expected: Column, observed: Column) -> DataFrame:
    count = lambda test: F.sum(F.when(test, 1).otherwise(0)).alias
    return rows.groupBy(*by).agg(count(expected & observed)("tp"), count(~expected & observed)("fp"), count(expected & ~observed)("fn"), count(~expected & ~observed)("tn"))


def percentiles(rows: DataFrame, by: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """Nearest-rank percentiles (the smallest value with at least that share of the rows up to it); nulls don't count, and a group of nulls has nulls. Exact, for groups of any size: distinct values with
    their counts are range-partitioned in order, and a value's running count is that within its partition plus the counts of the partitions before. No group meets in one task."""
    keys = [f"_k{i}" for i in range(len(by))]
    named = rows.select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.col(value).alias("_v"))
    counts = named.groupBy(*keys, "_v").agg(F.count("_v").alias("_n"))
    placed = durable(counts.repartitionByRange(*[F.col(k) for k in keys], "_v").withColumn("_p", F.spark_partition_id()), "percentiles")
    sums = placed.groupBy(*keys, "_p").agg(F.sum("_n").alias("_s"))  # a row for each group and partition that holds some of it
    whole = Window.partitionBy(*keys)
    sums = sums.withColumn("_before", F.sum("_s").over(whole.orderBy("_p")) - F.col("_s")).withColumn("_total", F.sum("_s").over(whole)).drop("_s")
    on = functools.reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (*keys, "_p")])
    joined = placed.alias("r").join(sums.alias("s"), on).select("r.*", "s._before", "s._total")
    running = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys, "_p").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0))
    found = joined.withColumn("_r", running)
    picks = [F.min(F.when((F.col("_r") >= F.ceil(F.col("_total") * s - 1e-9)) & F.col("_v").isNotNull() & (F.col("_n") > 0), F.col("_v"))).alias(f"p{round(s * 100)}") for s in shares]
    return found.groupBy(*keys).agg(*picks, F.max("_total").alias("n")).select(*[F.col(k).alias(b) for b, k in zip(by, keys, strict=True)], *[f"p{round(s * 100)}" for s in shares], "n")


def slices(rows: DataFrame, system: str, dimensions: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """(dimension, value, system, n, averages) of all dimensions in one pass: rows are spread over their dimensions and combined before the shuffle."""
    each = rows.select(system, *measures, F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions])).alias("s"))
    return each.groupBy(F.col("s.dimension").alias("dimension"), F.col("s.value").alias("value"), system).agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(m), 6).alias(f"avg_{m}") for m in measures])


def failures(rows: DataFrame, key: str, by: Sequence[str], codes: str, samples: int = 20) -> DataFrame:
    """(by, code, n, samples): counts of each failure code of an array column, with the first keys as samples."""
    from ledgerloom.operators.facets import top_per_key

    each = rows.select(key, *by, F.explode(F.array_distinct(codes)).alias("code"))
    counts = each.groupBy(*by, "code").agg(F.count(F.lit(1)).alias("n"))
    first = top_per_key(each, [*by, "code"], [F.col(key)], samples).groupBy(*by, "code").agg(F.array_sort(F.collect_list(key)).alias("samples"))
    return counts.join(first, [*by, "code"])


def paired_comparison(outcomes: DataFrame, query: str, system: str, cluster: str, metric: str, base: str, others: int, level: float = 0.95) -> DataFrame:
    """Each system against the base one on the queries both have: mean of the cluster means of the differences, its standard deviation and error, a normal interval and one
    corrected for `others` comparisons, and wins, ties and losses by query. Values are rounded to 6 places; with one cluster the spread is null."""
    p = outcomes.where(F.col(system) == base).select(F.col(query).alias("_q"), F.col(metric).alias("_base"))
    c = outcomes.where(F.col(system) != base)
    pairs = c.join(p, c[query] == p["_q"]).select(system, cluster, (F.col(metric) - F.col("_base")).alias("d"))
    counts = {"wins": F.col("d") > 0, "ties": F.col("d") == 0, "losses": F.col("d") < 0}
    clusters = pairs.groupBy(system, cluster).agg(F.avg("d").alias("m"), F.count(F.lit(1)).alias("n"), *[F.sum(t.cast("int")).alias(k) for k, t in counts.items()])
    whole = clusters.groupBy(system).agg(F.sum("n").alias("n_pairs"), F.count(F.lit(1)).alias("n_clusters"), F.avg("m").alias("mean"), F.stddev_samp("m").alias("sd"), *[F.sum(k).alias(k) for k in counts])
    error = F.col("sd") / F.sqrt("n_clusters")
    z, zb = (NormalDist().inv_cdf(1 - (1 - level) / 2 / n) for n in (1, others))
    ends = {"low": F.col("mean") - z * error, "high": F.col("mean") + z * error, "low_corrected": F.col("mean") - zb * error, "high_corrected": F.col("mean") + zb * error}
    return whole.select(system, "n_pairs", "n_clusters", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"), *[F.round(v, 6).alias(k) for k, v in ends.items()], *counts)


def systems_matrix(questions: DataFrame, systems: Mapping[str, Mapping[str, bool]]) -> DataFrame:
    """(question columns, system, flags): each question once per system, the systems being a literal list (no join is needed)."""
    flags = sorted({f for s in systems.values() for f in s})
    listed = F.array(*[F.struct(F.lit(n).alias("system"), *[F.lit(bool(s.get(f))).alias(f) for f in flags]) for n, s in systems.items()])
    return questions.withColumn("_s", F.explode(listed)).select(*questions.columns, "_s.*")


def best_overlap(wanted: Column, found: Column) -> Column:
    """Share of the wanted terms that were found; 0 if none is wanted."""
    return F.size(F.array_intersect(wanted, found)) / F.greatest(F.lit(1), F.size(wanted))
