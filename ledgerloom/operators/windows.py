"""Order-dependent operators: dense ordinals, latest rows, islands, hash chains, heading paths, budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerloom.session import durable


def dense_ordinal(rows: DataFrame, order: Sequence[str], name: str = "ordinal") -> DataFrame:
    """Number rows 0, 1, 2, ... by a total order, without bringing them to one task: range partition, number within, add the sizes of the partitions before.
    Only one count per partition goes to the driver. Equal rows get their numbers in any order."""
    sorted_ = durable(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()), "ordinals")
    sizes = {r["_p"]: r["n"] for r in sorted_.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for p in sorted(sizes):
        before.append((p, total))
        total += sizes[p]
    offsets = F.broadcast(rows.sparkSession.createDataFrame(before, "_p int, _before long"))  # one row per partition
    within = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return sorted_.withColumn("_n", within).join(offsets, "_p").withColumn(name, F.col("_before") + F.col("_n") - 1).drop("_p", "_n", "_before")


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by `order` (a total one), combined before the shuffle; no key's rows meet in one task."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max(F.struct(*order, *[F.col(c) for c in rest if c not in order])).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def earliest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min(F.struct(*order, *[F.col(c) for c in rest if c not in order])).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def islands(rows: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """Runs of consecutive numbers of each key: (keys, first, last, n). Repeated numbers count once."""
    once = rows.select(*keys, number).where(F.col(number).isNotNull()).distinct()
    run = F.col(number) - F.row_number().over(Window.partitionBy(*keys).orderBy(number))
    return once.withColumn("_run", run).groupBy(*keys, "_run").agg(F.min(number).alias("first"), F.max(number).alias("last"), F.count(F.lit(1)).alias("n")).drop("_run")


def chain_faults(rows: DataFrame, chain: str, sequence: str, previous: str, own: str) -> DataFrame:
    """Rows of hash-chained ledgers that don't bind the row before them, or whose number doesn't follow on. One chain is ordered by nature; many are checked at once."""
    w = Window.partitionBy(chain).orderBy(sequence)
    seen = rows.withColumn("_own", F.lag(own).over(w)).withColumn("_seq", F.lag(sequence).over(w))
    fault = F.when(F.col("_seq").isNotNull() & ~F.col(previous).eqNullSafe(F.col("_own")), "broken_link").when(F.col("_seq") + 1 != F.col(sequence), "gap")
    return seen.withColumn("fault", fault).where(F.col("fault").isNotNull()).select(chain, sequence, "fault")


def heading_paths(lines: DataFrame, document: str, position: str, level: str, title: str, levels: int = 6) -> DataFrame:
    """The headings above each line, from the highest: (document, position, path). A heading ends those of its own level and below."""
    w = Window.partitionBy(document).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    last = [F.last(F.when(F.col(level) == n, F.struct(F.col(position).alias("p"), F.col(title).alias("t"))), ignorenulls=True).over(w).alias(f"_h{n}") for n in range(1, levels + 1)]
    seen = lines.select(document, position, *last)
    parts = []
    for n in range(1, levels + 1):
        above = [F.coalesce(F.col(f"_h{m}.p"), F.lit(-1)) for m in range(1, n)]
        current = F.col(f"_h{n}").isNotNull()
        for a in above:
            current = current & (F.col(f"_h{n}.p") > a)
        parts.append(F.when(current, F.col(f"_h{n}.t")))
    return seen.select(document, position, F.array_join(F.array_compact(F.array(*parts)), " > ").alias("path"))


def within_budget(rows: DataFrame, group: Sequence[str], order: Sequence[Column], size: str, budget: int) -> DataFrame:
    """The first rows of each group whose running size stays within a budget."""
    total = F.sum(size).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("running", total).where(F.col("running") <= budget)


def page(rows: DataFrame, order: Sequence[Column], number: int, size: int) -> DataFrame:
    """One page of a result, from 1; a number beyond the last gives the last page."""
    pages = max(1, -(-rows.count() // size))
    return rows.orderBy(*order).offset((min(max(1, number), pages) - 1) * size).limit(size)


def after_key(rows: DataFrame, order: Sequence[str], last: Sequence, size: int) -> DataFrame:
    """Keyset pagination: the `size` rows that follow the key `last` by `order`."""
    cursor = F.struct(*[F.lit(v).cast(rows.schema[c].dataType).alias(c) for c, v in zip(order, last, strict=True)])
    return rows.where(F.struct(*order) > cursor).orderBy(*order).limit(size)


def timeline(rows: DataFrame, key: str, title: str, dates: Sequence[str]) -> DataFrame:
    """(key, title, event, event_date): one row for each date a record has."""
    events = F.array(*[F.struct(F.lit(d).alias("event"), F.col(d).alias("event_date")) for d in dates])
    return rows.select(key, title, F.explode(events).alias("e")).select(key, title, "e.event", "e.event_date").where(F.col("event_date").isNotNull())
