"""What changed between two full snapshots, by compact hash arrays.

Each record becomes a key hash and a row hash (128 bits each) and the smallest row id; rows are combined before they are
shuffled, so a record delivered a million times costs one row. The compact arrays go to hash buckets of bounded size, where
numpy sorts them and searchsorted gives the set differences. Full values are fetched for differing keys only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import durable, parallelism

DELTA = "source_table string, k1 long, k2 long, row_id long, delta_class string"
#: Rows of a bucket: some 100 MB of arrays in numpy.
BUCKET_ROWS = 1_000_000


def folded_url(column: str) -> Column:
    """Letters and digits without letter case."""
    return F.regexp_replace(F.lower(F.col(column)), r"[^\p{L}\p{N}]+", "")


def folded_fingerprint(column: str) -> Column:
    """Without letter case, white space and a leading `name:`; null counts as empty."""
    bare = F.regexp_replace(F.lower(F.coalesce(F.col(column), F.lit(""))), r"[\s ]+", "")
    return F.regexp_replace(bare, r"^[a-z][a-z0-9_\-]*:", "")


def compact(rows: DataFrame) -> DataFrame:
    """rows: source_table, side (0 old, 1 new), key (array of strings, nulls allowed), content string, version (timestamp or null), row_id.
    One row per side and record: its hashes, the content of the latest version (of equal ones the largest row_id's), the smallest row_id."""
    parts = F.to_json(F.struct("source_table", "key"))  # tells null from empty, and one split of the parts from another
    hashed = rows.select(
        "source_table", "side", F.xxhash64(parts).alias("k1"), F.xxhash64(F.lit(1), parts).alias("k2"),
        F.struct(F.coalesce(F.unix_micros(F.col("version").cast("timestamp")), F.lit(-(2**62))).alias("v"), F.col("row_id").alias("id"), F.xxhash64("content").alias("r1"), F.xxhash64(F.lit(1), "content").alias("r2")).alias("last"),
        "row_id",
    )
    grouped = hashed.groupBy("source_table", "side", "k1", "k2").agg(F.max("last").alias("last"), F.min("row_id").alias("row_id"))
    return grouped.select("source_table", "side", "k1", "k2", F.col("last.r1").alias("r1"), F.col("last.r2").alias("r2"), "row_id")


def _match(a1: np.ndarray, a2: np.ndarray, b1: np.ndarray, b2: np.ndarray) -> np.ndarray:
    """For each key of b its index in a (sorted by a1), or -1."""
    low = np.searchsorted(a1, b1, "left")
    high = np.searchsorted(a1, b1, "right")
    at = np.where(high > low, low, -1)
    sure = np.flatnonzero(at >= 0)
    wrong = sure[a2[at[sure]] != b2[sure]]
    at[wrong] = -1
    for i in wrong:  # two keys with one first hash: rare
        for j in range(low[i], high[i]):
            if a2[j] == b2[i]:
                at[i] = j
    return at


def differences(side: np.ndarray, k1: np.ndarray, k2: np.ndarray, r1: np.ndarray, r2: np.ndarray, row_id: np.ndarray):
    """Indices of the differing rows and their classes; for added and changed the new side's row, for removed the old one's."""
    old, new = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    old = old[np.argsort(k1[old], kind="stable")]
    to_old = _match(k1[old], k2[old], k1[new], k2[new])
    both = to_old >= 0
    pairs = old[to_old[both]]
    changed = new[both][(r1[new[both]] != r1[pairs]) | (r2[new[both]] != r2[pairs])]
    gone = np.ones(len(old), bool)
    gone[to_old[both]] = False
    return {"added": new[~both], "changed": changed, "removed": old[gone]}


def _diff(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    whole = pa.Table.from_batches(held) if held else None
    if whole is None or not whole.num_rows:
        return
    arrays = {c: whole.column(c).to_numpy() for c in ("side", "k1", "k2", "r1", "r2", "row_id")}
    source = whole.column("source_table").combine_chunks()
    for name, rows in differences(**arrays).items():
        if len(rows):
            yield pa.RecordBatch.from_arrays(
                [source.take(pa.array(rows)), pa.array(arrays["k1"][rows]), pa.array(arrays["k2"][rows]), pa.array(arrays["row_id"][rows]), pa.array([name] * len(rows))],
                names=["source_table", "k1", "k2", "row_id", "delta_class"],
            )


def snapshot_delta(rows: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Added, removed and changed records: source_table, k1, k2, row_id, delta_class. See compact() for the rows. Unchanged records
    give no row. An empty side makes all of the other added or removed; two empty ones give nothing. Null key parts are values."""
    arrays = durable(compact(rows), "snapshot-arrays")
    buckets = max(parallelism(rows.sparkSession), -(-arrays.count() // bucket_rows))
    return arrays.repartition(buckets, "k1").mapInArrow(_diff, DELTA)


def differing_values(rows: DataFrame, delta: DataFrame) -> DataFrame:
    """The full values of differing records, both sides: delta's columns with old_content and new_content."""
    parts = F.to_json(F.struct("source_table", "key"))
    keyed = rows.withColumn("k1", F.xxhash64(parts)).withColumn("k2", F.xxhash64(F.lit(1), parts))
    kept = keyed.join(delta.select("k1", "k2"), ["k1", "k2"], "left_semi")
    last = F.struct(F.coalesce(F.unix_micros(F.col("version").cast("timestamp")), F.lit(-(2**62))).alias("v"), F.col("row_id").alias("id"), F.col("content").alias("content"))
    values = kept.groupBy("k1", "k2").agg(F.max(F.when(F.col("side") == 0, last)).alias("o"), F.max(F.when(F.col("side") == 1, last)).alias("n"))
    return delta.join(values, ["k1", "k2"]).select("source_table", "row_id", "delta_class", F.col("o.content").alias("old_content"), F.col("n.content").alias("new_content"))


def snapshot_rows(spark, folder: str) -> DataFrame:
    """Both sides of `inputs` (t0_enumeration, t1_enumeration) and of `work_items` (its two fingerprints) in one shape."""
    from ledgerloom.session import table

    inputs = table(spark, folder, "inputs").where(F.col("role").isin("t0_enumeration", "t1_enumeration"))
    inputs = inputs.select(
        F.lit("inputs").alias("source_table"), (F.col("role") == "t1_enumeration").cast("int").alias("side"), F.array(folded_url("url"), F.col("locale")).alias("key"),
        folded_fingerprint("fingerprint").alias("content"), F.col("delivered_at").alias("version"), F.col("input_id").cast("long").alias("row_id"),
    )
    work = table(spark, folder, "work_items").select("work_id", F.explode(F.array(*[F.struct(F.lit(i).alias("side"), folded_fingerprint(f"t{i}_fingerprint").alias("content")) for i in (0, 1)])).alias("f"))
    work = work.where(F.col("f.content") != "").select(
        F.lit("work_items").alias("source_table"), "f.side", F.array(F.col("work_id").cast("string"), F.lit(None).cast("string")).alias("key"),
        "f.content", F.lit(None).cast("timestamp").alias("version"), F.col("work_id").cast("long").alias("row_id"),
    )
    return inputs.unionByName(work)
