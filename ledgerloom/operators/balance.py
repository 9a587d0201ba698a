"""Fragment-replicate by estimated load: per-key work without a few tasks doing most of it.

A handful of keys hold most rows. Hashing by key then sends each of them to one task. Here the load of every key is
measured by a partial aggregate, keys are packed onto tasks by their load, keys too large for a task are split into shards
in proportion to their load, and a matching side (if any) is replicated to just those shards.

Every key of more than `slack` of a task's fair share is split, so there are at most tasks / slack of them, whatever the data hold. Where its shards and the
hashed rest go is a written table of at most (1 / slack + slots_per_task) rows a task, made within one task; the driver sees one total.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import durable, parallelism

TASK = "_ll_task"
SHARD = "_ll_shard"
SALT = "_ll_salt"
HASH = "_ll_hash"
#: Part of a task's fair share above which a key is split.
SLACK = 0.25
SLOTS_PER_TASK = 16
#: Placements of at most so many rows (16 bytes and a few task numbers each) are broadcast; larger ones, of more than 100,000 tasks, are joined by shuffle.
BROADCAST_ROWS = 2_000_000


@dataclass(frozen=True)
class Packing:
    """Where rows go. places: (heavy boolean, at long, _ll_tasks array<int>): of a heavy key, by its hash, the tasks of its shards in order; of a slot of light keys its one task."""

    tasks: int
    slots: int
    places: DataFrame
    small: bool


def pack(heavy: Mapping[int, float], slots: Mapping[int, float], tasks: int, slack: float = SLACK) -> tuple[dict[int, list[int]], dict[int, int], list[float]]:
    """Longest-processing-time bin packing of hashed keys and slots, each with its load: tasks of the shards of each key, task of each slot, load of each task. A key whose load exceeds `slack` of a task's
    fair share is cut into equal shards of at most that much (at most one a task), each packed on its own, so no task gets more than its share plus the largest piece."""
    fair = max(1.0, (sum(heavy.values()) + sum(slots.values())) / tasks)
    pieces: list[tuple[float, int, int, int]] = []
    for key, load in heavy.items():
        shards = shards_of(load, fair, tasks, slack)
        pieces += [(-load / shards, 0, key, shard) for shard in range(shards)]
    pieces += [(-float(load), 1, slot, 0) for slot, load in slots.items()]
    pieces.sort()
    queue = [(0.0, task) for task in range(tasks)]
    placed: dict[int, list[int]] = {key: [] for key in heavy}
    light: dict[int, int] = {}
    loads = [0.0] * tasks
    for size, kind, at, _ in pieces:
        now, task = heapq.heappop(queue)
        loads[task] = now - size
        heapq.heappush(queue, (loads[task], task))
        if kind:
            light[at] = task
        else:
            placed[at].append(task)
    return placed, light, loads


def shards_of(load: float, fair: float, tasks: int, slack: float) -> int:
    return int(max(1, min(tasks, -(-load // (fair * slack)))))


def estimate(rows: DataFrame, keys: Sequence[str], tasks: int, slack: float = SLACK, slots_per_task: int = SLOTS_PER_TASK, loads: DataFrame | None = None) -> Packing:
    """Measure the load of every key (map-side combined counts over all rows) and pack. `loads` (the keys and a column
    `load`) spares the count where it is known already. Keys of one 64-bit hash share their shards, which changes no result."""
    if loads is None:
        loads = durable(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("load")), "loads")
    counts = loads.groupBy(F.xxhash64(*keys).alias("at")).agg(F.sum("load").alias("load"))
    fair = max(1.0, (loads.agg(F.sum("load")).first()[0] or 0) / tasks)
    slots = tasks * slots_per_task
    large = F.col("load") > fair * slack
    light = counts.where(~large).groupBy(F.pmod("at", F.lit(slots)).alias("at")).agg(F.sum("load").alias("load"))
    pieces = counts.where(large).select(F.lit(True).alias("heavy"), "at", "load").unionByName(light.select(F.lit(False).alias("heavy"), "at", "load"))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heavy: dict[int, int] = {}
        rest: dict[int, int] = {}
        for pdf in batches:
            for large, at, load in zip(pdf["heavy"].tolist(), pdf["at"].tolist(), pdf["load"].tolist(), strict=True):
                (heavy if large else rest)[at] = load
        placed, slot, _ = pack(heavy, rest, tasks, slack)
        if placed or slot:
            yield pd.DataFrame({"heavy": [True] * len(placed) + [False] * len(slot), "at": [*placed, *slot], "_ll_tasks": [*placed.values(), *([t] for t in slot.values())]})

    places = durable(pieces.repartition(1).mapInPandas(place, "heavy boolean, at long, _ll_tasks array<int>"), "places")
    return Packing(tasks, slots, places, tasks * (1 / slack + slots_per_task) <= BROADCAST_ROWS)


def _placed(rows: DataFrame, keys: Sequence[str], packing: Packing) -> DataFrame:
    """Add `_ll_tasks`, the tasks of the shards of the row's key: one for a light key."""
    sized = F.broadcast if packing.small else lambda t: t
    heavy = sized(packing.places.where("heavy").select(F.col("at").alias(HASH), F.col("_ll_tasks").alias("_ll_heavy")))
    light = sized(packing.places.where("NOT heavy").select(F.col("at").alias("_ll_slot"), F.element_at("_ll_tasks", F.lit(1)).alias("_ll_light")))
    found = rows.withColumn(HASH, F.xxhash64(*keys)).withColumn("_ll_slot", F.pmod(HASH, F.lit(packing.slots)).cast("long"))
    found = found.join(heavy, HASH, "left").join(light, "_ll_slot", "left")
    own = F.coalesce("_ll_heavy", F.array(F.coalesce("_ll_light", F.pmod(HASH, F.lit(packing.tasks)).cast("int"))))  # the last for keys that only the matching side has
    return found.select(*rows.columns, own.alias("_ll_tasks"))


def fragment(rows: DataFrame, keys: Sequence[str], packing: Packing, spread: Sequence[str]) -> DataFrame:
    """Add the shard and the task of each row and move it there, in one shuffle. `spread` are the columns by whose hash a heavy
    key's rows are spread over its shards; rows equal in them stay together, so that distinct counts over them add up."""
    shard = F.pmod(F.xxhash64(F.lit(7), *spread), F.size("_ll_tasks")).cast("int")
    placed = _placed(rows, keys, packing).withColumn(SHARD, shard).withColumn(TASK, F.element_at("_ll_tasks", F.col(SHARD) + 1)).drop("_ll_tasks")
    return placed.repartitionById(packing.tasks, F.col(TASK))


def replicate(side: DataFrame, keys: Sequence[str], packing: Packing) -> DataFrame:
    """Copy each row of the matching side to the shards of its key: once for a light key, to all its shards for a heavy one."""
    spread = _placed(side, keys, packing).select(*side.columns, F.posexplode("_ll_tasks").alias(SHARD, TASK))
    return spread.repartitionById(packing.tasks, F.col(TASK))


def fragment_replicate_join(rows: DataFrame, side: DataFrame, keys: Sequence[str], spread: Sequence[str], tasks: int | None = None, how: str = "inner") -> DataFrame:
    """Equi-join without skew. Null keys match null keys of the side. `how` is inner or left. Columns of the side other than
    the keys that clash with those of rows get the ending `_side`; the result has the columns of rows, those of the side, and the task and shard."""
    packing = estimate(rows, keys, tasks or parallelism(rows.sparkSession))
    return join_packed(rows, side, keys, spread, packing, how)


def join_packed(rows: DataFrame, side: DataFrame, keys: Sequence[str], spread: Sequence[str], packing: Packing, how: str = "inner") -> DataFrame:
    clash = (set(rows.columns) & set(side.columns)) - set(keys)
    side = side.select(*[F.col(c).alias(f"{c}_side") if c in clash else F.col(c) for c in side.columns])
    left = fragment(rows, keys, packing, spread)
    right = replicate(side, keys, packing)
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in (*keys, TASK, SHARD) else F.col(c) for c in right.columns])
    on = (F.col(TASK) == F.col(f"_r_{TASK}")) & (F.col(SHARD) == F.col(f"_r_{SHARD}"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    joined = left.join(right.hint("merge"), on, how)  # a sort can spill, a hash table can't
    return joined.drop(*[f"_r_{c}" for c in (*keys, TASK, SHARD)])


def hot_keys(counts: DataFrame, keys: Sequence[str], tasks: int, slack: float = SLACK) -> DataFrame:
    """(_ll_hash, _ll_shards) of the keys of counts (keys, n) that have more than `slack` of a task's fair share of all rows: at most tasks / slack rows. Each gets as many shards as keep a shard within that."""
    counts = counts.where(_all_set(keys))
    fair = max(1.0, (counts.agg(F.sum("n")).first()[0] or 0) / tasks)
    shards = F.least(F.lit(tasks), F.ceil(F.col("n") / F.lit(fair * slack))).cast("int")
    hot = counts.where(F.col("n") > fair * slack).groupBy(F.xxhash64(*keys).alias(HASH)).agg(F.max(shards).alias("_ll_shards"))
    return F.broadcast(hot) if tasks / slack <= BROADCAST_ROWS else hot


def salted(rows: DataFrame, keys: Sequence[str], hot: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add `_ll_salt`, the shard of the row within its key, by the hash of the columns `by`: 0 for all rows of keys that aren't hot."""
    own = F.coalesce(F.pmod(F.xxhash64(F.lit(7), *by), F.col("_ll_shards")).cast("int"), F.lit(0))
    return rows.withColumn(HASH, F.xxhash64(*keys)).join(hot, HASH, "left").select(*rows.columns, own.alias(SALT))


def replicated(side: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Copy each row of a matching side to all shards of its key (`_ll_salt`): once unless the key is hot."""
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_ll_shards", F.lit(1)) - 1))
    return side.withColumn(HASH, F.xxhash64(*keys)).join(hot, HASH, "left").select(*side.columns, each.alias(SALT))


def lookup(rows: DataFrame, unique: DataFrame, keys: Sequence[str], how: str = "inner", counts: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Join rows to a side that has each key once, where a few keys may hold most rows: rows of hot keys are spread over shards by all their other columns, the one row of the side is copied to these. No row of
    the side is broadcast, however wide. `counts` (keys, n) spares the count. Null keys match none. Rows equal in all columns stay together, so let callers drop or count repeats first."""
    if counts is None:
        counts = rows.where(_all_set(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(counts, keys, tasks or parallelism(rows.sparkSession))
    by = [c for c in rows.columns if c not in keys] or list(keys)
    return salted(rows, keys, hot, by).join(replicated(unique, keys, hot), [*keys, SALT], how).drop(SALT)


def _all_set(keys: Sequence[str]) -> Column:
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).isNotNull()
    return test


def balanced_key_profile(records: DataFrame, identity: str, fields: Sequence[str], measures: Sequence[str] = (), tasks: int | None = None, share: int = 25) -> DataFrame:
    """Per-key results over distinct records for several key fields at once.

    Result: field_name, key_value, n_records (distinct identities), total_chars and max_chars of the text measures, n_total
    (distinct identities of the whole table) and is_major (at least 1/share of it). One row per field and value; a null key is
    a group of its own, and so is an empty one. An empty table gives no row, rows without identity are left out. A redelivered record
    counts once; should its copies differ in a field, it counts once under each of its values. Extra columns are ignored.
    """
    spark = records.sparkSession
    tasks = tasks or parallelism(spark)
    text = F.lit(0).cast("long")
    for m in measures:
        text = text + F.coalesce(F.length(F.col(m)), F.lit(0))
    once = records.where(F.col(identity).isNotNull()).select(F.col(identity).alias("_id"), *[F.col(f).cast("string").alias(f) for f in fields], text.alias("_chars")).distinct()
    long = once.select("_id", "_chars", F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("key_value")) for f in fields])).alias("k"))
    long = long.select("_id", "_chars", "k.field_name", "k.key_value")
    keys = ["field_name", "key_value"]
    # The load of the keys over the rows as they come; the matching side: one row per key with the size of its field.
    sizes = (
        records.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("key_value")) for f in fields])).alias("k"))
        .select("k.field_name", "k.key_value")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("load"))
    )
    sizes = durable(sizes, "key-loads")  # one row per key; read three times below
    packing = estimate(long, keys, tasks, loads=sizes)
    joined = join_packed(long, sizes.withColumnRenamed("load", "rows_delivered"), keys, ["_id"], packing)
    # A record's copies, should they differ elsewhere, stand in one shard of each of its keys: they become one row there, unmoved.
    own = joined.groupBy(TASK, SHARD, *keys, "rows_delivered", "_id").agg(F.max("_chars").alias("_chars"))
    partial = own.groupBy(TASK, SHARD, *keys, "rows_delivered").agg(F.count(F.lit(1)).alias("n"), F.sum("_chars").alias("chars"), F.max("_chars").alias("longest"))
    merged = partial.groupBy(*keys, "rows_delivered").agg(F.sum("n").alias("n_records"), F.sum("chars").alias("total_chars"), F.max("longest").alias("max_chars"))
    whole = records.select(F.countDistinct(identity).alias("n")).first()["n"]
    return merged.select(*keys, "n_records", "rows_delivered", "total_chars", "max_chars", F.lit(whole).cast("long").alias("n_total"), (F.col("n_records") * share >= F.lit(whole)).alias("is_major"))
