"""Assignment and sampling: least-cost assignment, greedy choice without reuse, stratified and min-hash samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.facets import top_per_key
from ledgerloom.session import durable


def least_cost(cost: np.ndarray) -> np.ndarray:
    """Column of each row in an assignment of least total cost (rows <= columns), by shortest augmenting paths with potentials."""
    n, m = cost.shape
    row_of = np.full(m, -1)
    u, v = np.zeros(n), np.zeros(m)
    for start in range(n):
        far, back, done = np.full(m, np.inf), np.full(m, -1), np.zeros(m, bool)
        row, col = start, -1
        while True:
            slack = cost[row] - u[row] - v + (0 if col < 0 else far[col])
            closer = ~done & (slack < far)
            far[closer], back[closer] = slack[closer], col
            col = int(np.argmin(np.where(done, np.inf, far)))
            done[col] = True
            if row_of[col] < 0:
                break
            row = row_of[col]
        least = far[col]
        seen = done & (far <= least)
        rows = row_of[seen]
        inside = rows >= 0
        u[rows[inside]] += least - far[seen][inside]
        u[start] += least
        v[seen] -= least - far[seen]
        while True:
            before = back[col]
            row_of[col] = start if before < 0 else row_of[before]
            if before < 0:
                break
            col = before
    out = np.empty(n, int)
    out[row_of[row_of >= 0]] = np.flatnonzero(row_of >= 0)
    return out


def assign(pairs: DataFrame, group: str, row: str, column: str, cost: str) -> DataFrame:
    """(group, row, column, cost): within each group, rows matched to columns at least total cost. pairs lists each row and column of a group once; a group is one
    matrix and fits a task."""
    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        grid = pdf.pivot_table(index=row, columns=column, values=cost, aggfunc="min", sort=True)
        matrix = grid.fillna(1e12).to_numpy()
        turned = matrix.shape[0] > matrix.shape[1]
        found = least_cost(matrix.T if turned else matrix)
        r, c = (found, np.arange(len(found))) if turned else (np.arange(len(found)), found)
        return pd.DataFrame({group: pdf[group].iloc[0], row: grid.index[r], column: grid.columns[c], cost: matrix[r, c]})

    return pairs.groupBy(group).applyInPandas(run, f"`{group}` {kinds[group]}, `{row}` {kinds[row]}, `{column}` {kinds[column]}, `{cost}` double")


def greedy_anchors(choices: DataFrame, group: str, taker: str, anchor: str, rank: str) -> DataFrame:
    """(group, taker, anchor): takers of each group in order choose their best-ranked anchor that no earlier one took. Sequential within a group; groups are independent."""
    kinds = {f.name: f.dataType.simpleString() for f in choices.schema}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        taken, out = set(), []
        for t, options in pdf.sort_values([taker, rank, anchor]).groupby(taker, sort=True):
            pick = next((a for a in options[anchor] if a not in taken), None)
            if pick is not None:
                taken.add(pick)
                out.append((pdf[group].iloc[0], t, pick))
        return pd.DataFrame(out, columns=[group, taker, anchor])

    return choices.groupBy(group).applyInPandas(run, f"`{group}` {kinds[group]}, `{taker}` {kinds[taker]}, `{anchor}` {kinds[anchor]}")


def stratum_representatives(rows: DataFrame, strata: Sequence[str], identity: Column, keep: Sequence[str]) -> DataFrame:
    """Of each stratum the row whose identity has the smallest hash: the same at any partitioning, combined before the shuffle."""
    return rows.groupBy(*strata).agg(F.min(F.struct(F.sha2(identity, 256).alias("h"), *keep)).alias("r")).select(*strata, *[F.col(f"r.{k}").alias(k) for k in keep])


def min_hash_sample(rows: DataFrame, identity: Column, k: int) -> DataFrame:
    """The k rows of the smallest identity hashes."""
    return rows.withColumn("_h", F.sha2(identity, 256)).orderBy("_h").limit(k).drop("_h")


def min_hash_pool(rows: DataFrame, identity: Column, classes: Mapping[str, Column], k: int = 4096, scarce: int | None = None) -> DataFrame:
    """(identity, classes): the k identities of the smallest hashes, and of each class the `scarce` ones (an eighth of k, 64 at least), so that rare classes are kept; each identity once, with the
    names of its classes. An identity is of a class if any of its rows is; null identities are left out."""
    scarce = max(64, k // 8) if scarce is None else scarce
    marked = rows.select(identity.alias("identity"), *[F.coalesce(c, F.lit(False)).alias(f"_{n}") for n, c in classes.items()]).where("identity IS NOT NULL")
    held = durable(marked.groupBy("identity").agg(*[F.max(f"_{n}").alias(f"_{n}") for n in classes]), "pool")
    pool = min_hash_sample(held, F.col("identity"), k)
    for n in classes:
        pool = pool.unionByName(min_hash_sample(held.where(F.col(f"_{n}")), F.col("identity"), scarce))
    names = F.array_compact(F.array(*[F.when(F.col(f"_{n}"), F.lit(n)) for n in classes]))
    return pool.distinct().select("identity", names.alias("classes"))


def stratified_sample(rows: DataFrame, key: str, strata: Sequence[str], size: int) -> DataFrame:
    """(key, how): a representative of each stratum, then the smallest hashes of the rest up to `size` rows. With more strata than `size`, all representatives."""
    first = stratum_representatives(rows, strata, F.col(key), [key]).select(key).distinct().withColumn("how", F.lit("stratum"))
    room = max(0, size - first.count())
    rest = min_hash_sample(rows.select(key).distinct().join(first.select(key), key, "left_anti"), F.col(key), room).withColumn("how", F.lit("fill"))
    return first.unionByName(rest)


def near_misses(rows: DataFrame, key: str, kind: str, candidates: int = 2) -> DataFrame:
    """For each row another one of its kind, that of the smallest hash (the second smallest for the first itself), else the first of any kind. Two rows of each kind are
    enough, so no pairs are made."""
    h = F.sha2(F.col(key).cast("string"), 256)
    two = top_per_key(rows.withColumn("_h", h), [kind], [F.col("_h")], candidates)
    best = two.groupBy(kind).agg(F.array_sort(F.collect_list(F.struct("_h", key))).alias("_c"))
    whole = [r[key] for r in rows.withColumn("_h", h).orderBy("_h").limit(2).collect()]  # two rows
    any_other = F.lit(None)
    for other in reversed(whole):
        any_other = F.when(F.col(key) != F.lit(other), F.lit(other)).otherwise(any_other)
    own = F.filter("_c", lambda c: c[key] != F.col(key))
    return rows.join(best, kind).select(key, kind, F.coalesce(F.try_element_at(own, F.lit(1))[key], any_other).alias("near_miss"))


def quota_suite(rows: DataFrame, groups: Sequence[str], order: Sequence[Column], quota: int) -> DataFrame:
    """The first `quota` rows of each group by `order`."""
    return top_per_key(rows, groups, order, quota)


def best_for_pair(pairs: DataFrame, scores: DataFrame, member: str, score: str) -> DataFrame:
    """The best member of each pair (a, b): scores (side, member, score) of members on either side; the one of the greatest sum over both sides, ties by member. Members that one side lacks are no candidates."""
    left = pairs.join(scores.select(F.col("side").alias("a"), F.col(member), F.col(score).alias("_l")), "a")
    both = left.join(scores.select(F.col("side").alias("b"), F.col(member), F.col(score).alias("_r")), ["b", member])
    best = both.groupBy("a", "b").agg(F.min(F.struct((-(F.col("_l") + F.col("_r"))).alias("m"), F.col(member))).alias("w"))
    return best.select("a", "b", F.col(f"w.{member}").alias(member), (-F.col("w.m")).alias(score))


def combinations(rows: DataFrame, group: str, key: str) -> DataFrame:
    """(group, a, b) with a < b: pairs of a group's distinct keys. Meant for small groups (members of an overlay), where the pairs are the result."""
    once = rows.select(group, key).distinct()
    return once.select(group, F.col(key).alias("a")).join(once.select(group, F.col(key).alias("b")), group).where(F.col("a") < F.col("b"))
