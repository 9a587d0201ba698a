"""Records that differ in formatting alone: an incremental ledger of canonical keys.

The ledger keeps, in hash buckets, each canonical key with its number of copies and its earliest representative. A batch is aggregated
by key first (combined before the shuffle, so that a record delivered a million times is one row), then full-outer-joined with the
buckets it touches; counts are added and the smaller id stays. Buckets it doesn't touch are neither read nor written.

The number of buckets follows the ledger: it doubles when buckets hold more than BUCKET_ROWS keys on the average, so a small batch touches a small part of a large ledger. Each batch has a name, and a name
counts once: a batch that is given again, say by a job that is run again after a failure behind Spark's commit, changes nothing.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.json_tools import canonical, fold
from ledgerloom.operators.balance import lookup
from ledgerloom.session import discard, durable_counted, scratch, spread

ROWS = "source_table string, k1 long, k2 long, keep_id long, copies long"


def _digest(parts: list[str | None]) -> bytes:
    return hashlib.blake2b(json.dumps(parts, ensure_ascii=False).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def canonical_keys(rows: DataFrame) -> DataFrame:
    """rows: source_table, id, fields (array of strings), json (array of strings). Result: source_table, id, k1, k2: 128 bits of the canonical spelling
    of all fields. Fields are compared by letters and digits without letter case; JSON so within its strings, whatever the order of fields in its
    objects. Null is a value of its own, unequal to empty. Text that is no JSON is compared as a string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain, nested = batch.column("fields").to_pylist(), batch.column("json").to_pylist()
            digests = [_digest([None if x is None else fold(x) for x in f or []] + [canonical(x) for x in j or []]) for f, j in zip(plain, nested, strict=True)]
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("source_table"), batch.column("id"), pa.array(halves[:, 0]), pa.array(halves[:, 1])], names=["source_table", "id", "k1", "k2"])

    return spread(rows.select("source_table", F.col("id").cast("long").alias("id"), "fields", "json")).mapInArrow(run, "source_table string, id long, k1 long, k2 long")


#: Keys of a bucket, some 15 MB: what one task joins and writes.
BUCKET_ROWS = 500_000


class DuplicateLedger:
    """A folder of versions `v-<number>-<buckets>-<batch>`, each holding the buckets that its batch touched; of a bucket the latest version counts. A version counts once
    Spark has committed it (_SUCCESS), so an update that fails half way leaves the ledger as it was, and may be run again. Versions that no bucket needs any more are emptied; their names stay, so that
    their batches are known. When the number of buckets grows, all of them are written anew, which doubling makes rare."""

    def __init__(self, spark: SparkSession, path: str | None = None, bucket_rows: int = BUCKET_ROWS):
        self.spark, self.path, self.bucket_rows = spark, path or scratch(spark, "ledger"), bucket_rows

    def _hadoop(self):
        Path = self.spark._jvm.org.apache.hadoop.fs.Path
        return Path, Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _versions(self) -> list[tuple[int, int, str, str]]:
        """(number, buckets, batch, folder) of the committed versions in order."""
        Path, fs = self._hadoop()
        if not fs.exists(Path(self.path)):
            return []
        names = [p.getPath().getName() for p in fs.listStatus(Path(self.path))]
        found = [(*n.split("-", 3)[1:], n) for n in names if n.startswith("v-") and fs.exists(Path(f"{self.path}/{n}/_SUCCESS"))]
        return sorted((int(number), int(buckets), batch, f"{self.path}/{n}") for number, buckets, batch, n in found)

    def _latest(self) -> dict[int, str]:
        """Folder of the latest version of each bucket. At most as many entries as buckets."""
        Path, fs = self._hadoop()
        versions = self._versions()
        found: dict[int, str] = {}
        for _, buckets, _, folder in versions:
            if buckets == versions[-1][1]:  # a growth writes all buckets, so earlier versions are done with
                for p in fs.listStatus(Path(folder)):
                    name = p.getPath().getName()
                    if name.startswith("bucket="):
                        found[int(name[7:])] = f"{folder}/{name}"
        return found

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(*folders)

    def table(self) -> DataFrame:
        return self._read(list(self._latest().values()))

    def update(self, keys: DataFrame, batch: str) -> bool:
        """Add a batch of keys (source_table, id, k1, k2) under its name, of letters, digits, `_` and `.`. False, and nothing done, if the ledger has it already."""
        if not re.fullmatch(r"[\w.]+", batch):
            raise ValueError(f"no batch name: {batch!r}")
        versions = self._versions()
        if any(v[2] == batch for v in versions):
            return False
        buckets = versions[-1][1] if versions else 1
        latest = self._latest()
        new, added = durable_counted(keys.groupBy("source_table", "k1", "k2").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("copies")), "ledger-batch", F.lit(True))
        total, known = added + (self.table().count() if latest else 0), buckets
        while total > buckets * self.bucket_rows:
            buckets *= 2
        bucket = lambda n: F.pmod("k1", F.lit(n)).cast("int")
        # Bucket by bucket: both sides go to the task of their bucket, which joins and writes it.
        side = lambda df: df.withColumn("bucket", bucket(buckets)).repartitionById(buckets, F.col("bucket"))
        whole = side(new)
        if latest:
            touched = set(latest) if buckets != known else {r["b"] for r in new.select(bucket(known).alias("b")).distinct().collect()}  # at most as many rows as buckets
            old = side(self._read([f for b, f in latest.items() if b in touched])).select("bucket", "source_table", "k1", "k2", F.col("keep_id").alias("old_id"), F.col("copies").alias("old_copies"))
            joined = whole.join(old.hint("merge"), ["bucket", "source_table", "k1", "k2"], "full_outer")
            whole = joined.select("source_table", "k1", "k2", F.least("keep_id", "old_id").alias("keep_id"), (F.coalesce("copies", F.lit(0)) + F.coalesce("old_copies", F.lit(0))).alias("copies"), "bucket")
        number = 1 + (versions[-1][0] if versions else -1)
        whole.write.partitionBy("bucket").mode("overwrite").parquet(f"{self.path}/v-{number:06d}-{buckets}-{batch}")
        discard(new)
        self._tidy()
        return True

    def _tidy(self) -> None:
        """Remove the bucket folders that a later version has replaced. The last replaced version of each is gone too, so read the ledger's table between updates, not across them."""
        Path, fs = self._hadoop()
        kept = set(self._latest().values())
        for _, _, _, folder in self._versions():
            for p in fs.listStatus(Path(folder)):
                if p.getPath().getName().startswith("bucket=") and f"{folder}/{p.getPath().getName()}" not in kept:
                    fs.delete(p.getPath(), True)


def copies(keys: DataFrame, ledger: DuplicateLedger) -> DataFrame:
    """source_table, keep_id, copy_id of all keys but the earliest of each record. Of a record that holds a third of all rows, only the one
    ledger row is broadcast; its copies stay where they are."""
    many = ledger.table().where(F.col("copies") > 1).select("source_table", "k1", "k2", "keep_id", "copies")
    counts = many.select("source_table", "k1", "k2", F.col("copies").alias("n"))
    found = lookup(keys, many.drop("copies"), ["source_table", "k1", "k2"], counts=counts)
    return found.where(F.col("id") != F.col("keep_id")).select("source_table", "keep_id", F.col("id").alias("copy_id"))


def duplicate_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    from ledgerloom.session import table

    def one(name, key, fields, nested):
        return table(spark, folder, name).select(F.lit(name).alias("source_table"), F.col(key).cast("long").alias("id"), F.array(*fields).alias("fields"), F.array(nested).alias("json"))

    return {
        "inputs": one("inputs", "input_id", ["role", "url", "locale"], "record_json"),
        "candidates": one("candidates", "candidate_id", ["candidate_key"], "candidate_json"),
        "datasets": one("datasets", "seq", ["url"], "row_json"),
    }
