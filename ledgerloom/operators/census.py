"""Census of many enumerators: union by priority, candidate ledger, aliases, partition closure, reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.identity import candidate_key


def union_by_priority(sources: Mapping[str, tuple[int, DataFrame]], key: str, columns: Sequence[str]) -> DataFrame:
    """One record per key of several enumerators: each column from the enumerator of the highest priority that has a non-empty value (ties by the
    smallest value), the sorted names of all enumerators that have the key, and the number of rows. `unknown` counts as empty. Aggregates are combined before the shuffle.

    sources: name -> (priority, rows with key and columns, strings). Rows without a key are left out.
    """
    whole = reduce(DataFrame.unionByName, [df.select(key, *columns).withColumn("_from", F.lit(name)).withColumn("_p", F.lit(-priority)) for name, (priority, df) in sources.items()])
    known = lambda c: F.when((F.col(c) != "") & (F.col(c) != "unknown"), F.struct("_p", F.col(c).alias("_v")))
    best = [F.min(known(c)).getField("_v").alias(c) for c in columns]
    return whole.where(F.col(key) != "").groupBy(key).agg(*best, F.array_sort(F.collect_set("_from")).alias("source_memberships"), F.count(F.lit(1)).alias("n_rows"))


def candidates(records: DataFrame, url: Column, content_id: Column, locale: Column, dated: Column, attachments: Column) -> DataFrame:
    """(candidate_key, entity_class, native_id, url, locale): what each record makes countable: its route, its identity and document if it has an id, its edition if
    it is dated too, and each attachment (an array of strings)."""
    some = content_id.isNotNull() & (content_id != "")
    entry = lambda name, native: F.struct(F.lit(name).alias("entity_class"), native.alias("native_id"))
    none = F.lit(None).cast("string")
    fixed = F.array(entry("route", none), F.when(some, entry("identity", content_id)), F.when(some, entry("document", content_id)), F.when(some & dated, entry("edition", content_id)))
    extra = F.transform(F.coalesce(attachments, F.array().cast("array<string>")), lambda a: entry("attachment", a))
    rows = records.select(url.alias("url"), locale.alias("locale"), F.explode(F.array_compact(F.concat(fixed, extra))).alias("c"))
    return rows.select(candidate_key(F.col("c.entity_class"), F.col("c.native_id"), F.col("url"), F.col("locale")).alias("candidate_key"), "c.entity_class", "c.native_id", "url", "locale").distinct()


def aliases(rows: DataFrame, group: Sequence[str], key: str) -> DataFrame:
    """Each distinct key of a group with the group's first key: represented for that key itself, alias_of it for all others. The first key comes by an
    aggregate and a join, so a group of any size is never sorted in one task."""
    once = rows.select(*group, key).distinct()
    first = once.groupBy(*group).agg(F.min(key).alias("represented_by")).select(*[F.col(g).alias(f"_{g}") for g in group], "represented_by")
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group])
    both = once.join(first, on).select(*group, key, "represented_by")
    return both.withColumn("disposition", F.when(F.col(key) == F.col("represented_by"), "represented").otherwise("alias_of"))


def partition_closure(rows: DataFrame, partition: str, key: str, expected: DataFrame) -> DataFrame:
    """Whether each partition of a scan is closed: (partition, n_rows, n_keys, n_expected, closed). expected: (partition, n_expected). Partitions on either side appear."""
    have = rows.groupBy(partition).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(key).alias("n_keys"))
    both = have.join(expected, partition, "full_outer").na.fill(0, ["n_rows", "n_keys", "n_expected"])
    return both.withColumn("closed", (F.col("n_keys") == F.col("n_expected")) & (F.col("n_rows") == F.col("n_keys")))


def shared_keys(rows: DataFrame, partition: str, key: str) -> DataFrame:
    """Keys that stand in several partitions, which a closed scan has none of: (key, n_partitions)."""
    return rows.groupBy(key).agg(F.countDistinct(partition).alias("n_partitions")).where("n_partitions > 1")


def membership_flags(sources: Mapping[str, DataFrame], key: str) -> DataFrame:
    """(key, in_<name>...): one pass that gives all unions, intersections and differences of key sets."""
    whole = reduce(DataFrame.unionByName, [df.select(key, *[F.lit(n == name).alias(f"in_{n}") for n in sources]) for name, df in sources.items()])
    return whole.groupBy(key).agg(*[F.max(f"in_{n}").alias(f"in_{n}") for n in sources])


def reconciliation(flags: DataFrame, names: Sequence[str]) -> DataFrame:
    """Number of keys of each combination of sources: (in_<name>..., n_keys)."""
    return flags.groupBy(*[f"in_{n}" for n in names]).agg(F.count(F.lit(1)).alias("n_keys"))


def ledger_merge(rows: DataFrame, key: str, sets: Sequence[str]) -> DataFrame:
    """One row per key with the sorted union of each array column. Items are deduplicated before the shuffle and after it; none is capped."""
    whole = rows.select(key).distinct()
    for c in sets:
        items = rows.select(key, F.explode(c).alias(c)).distinct().groupBy(key).agg(F.array_sort(F.collect_set(c)).alias(c))
        whole = whole.join(items, key, "left").withColumn(c, F.coalesce(c, F.array().cast("array<string>")))
    return whole


def linked_only(memberships: Column, allowed: Sequence[str]) -> Column:
    """Whether a record is known by links alone: it has memberships, and none beyond those allowed."""
    return (F.size(memberships) > 0) & (F.size(F.array_except(memberships, F.array(*[F.lit(a) for a in allowed]))) == 0)


def held_out(rows: DataFrame, group: str, every: int = 5) -> DataFrame:
    """Every fifth group by its order, by number of distinct groups before it: (group, held_out). Groups are numbered without being brought together."""
    from ledgerloom.operators.windows import dense_ordinal

    return dense_ordinal(rows.select(group).distinct(), [group], "_place").select(group, (F.col("_place") % every == 0).alias("held_out"))
