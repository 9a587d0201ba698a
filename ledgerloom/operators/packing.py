"""Greedy packing of rows into bounded shards, content-addressed shard writers and their manifests."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import durable, scratch


#: Rows that a task packs together: bounds its memory, whatever the size of a group.
CHUNK_ROWS = 500_000


def successors(sizes: np.ndarray, limit: int, max_rows: int) -> np.ndarray:
    """For each row the first row of the next shard, if a shard begins at it."""
    ends = np.concatenate(([0], np.cumsum(sizes)))
    n = len(sizes)
    fit = np.searchsorted(ends, ends[:-1] + limit, "right") - 1
    return np.minimum(n, np.maximum(np.arange(n) + 1, np.minimum(fit, np.arange(n) + max_rows)))


def exits(sizes: np.ndarray, limit: int, max_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row, if a shard begins at it: bytes and rows of the last shard at the end, and how many shards begin after it. The successor table is squared until it stands still."""
    n = len(sizes)
    ahead = successors(sizes, limit, max_rows)
    last = np.where(ahead == n, np.arange(n), ahead)
    cuts = (ahead < n).astype(np.int64)
    while (last[last] != last).any():
        cuts, last = cuts + cuts[last], last[last]
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return ends[n] - ends[last], n - last, cuts


def _packed(group: str, size: str, limit: int, max_rows: int):
    """Rows in order, chunk by chunk, with what the greedy packing needs of each chunk: see greedy_shards."""

    def chunk(pdf: pd.DataFrame, number: int) -> pd.DataFrame:
        out = {c: np.zeros(len(pdf), np.int64) for c in ("_i", "_before", "_used", "_count", "_cuts")}
        first = np.zeros(len(pdf), bool)
        names, sizes = pdf[group].to_numpy(object), pdf[size].to_numpy(np.int64)
        codes = pd.factorize(names, use_na_sentinel=False)[0]
        edges = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1], [True])))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = sizes[a:b]
            out["_i"][a:b], out["_before"][a:b] = np.arange(b - a), np.cumsum(own) - own
            out["_used"][a:b], out["_count"][a:b], out["_cuts"][a:b] = exits(own, limit, max_rows)
            # No shard that began before this chunk ends later in it than one that begins at its first row. The last row tells the chunk's size.
            first[a : a + int(successors(own[: max_rows + 1], limit, max_rows)[0]) + 1] = True
            first[b - 1] = True
        return pdf.assign(_c=number, _first=first, **out)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base, seq, held = TaskContext.get().partitionId() << 32, 0, []
        for pdf in batches:
            held.append(pdf)
            if sum(map(len, held)) >= CHUNK_ROWS:
                yield chunk(pd.concat(held, ignore_index=True), base + seq)
                seq, held = seq + 1, []
        if sum(map(len, held)):
            yield chunk(pd.concat(held, ignore_index=True), base + seq)

    return run


def _entries(group: str, size: str, limit: int, max_rows: int):
    """Of candidate rows in order of group, chunk and place: the state (bytes, rows, shard) that each chunk of a group begins with."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: object = object()
        at = -1
        used = count = shard = total = rows = 0
        cut: tuple[int, int, int] | None = None
        for pdf in batches:
            out = []
            for g, c, i, before, s, u, k, n in zip(*(pdf[x].tolist() for x in (group, "_c", "_i", "_before", size, "_used", "_count", "_cuts")), strict=True):
                if g != now or c != at:
                    if g != now:
                        used = count = shard = 0
                    elif cut:
                        used, count, shard = cut[0], cut[1], shard + 1 + cut[2]
                    else:
                        used, count = used + total, count + rows
                    now, at, cut = g, c, None
                    out.append((g, c, used, count, shard))
                if cut is None and count + i and (used + before + s > limit or count + i >= max_rows):
                    cut = (u, k, n)
                total, rows = before + s, i + 1
            yield pd.DataFrame(out, columns=[group, "_c", "_eu", "_ek", "_es"])

    return run


def greedy_shards(rows: DataFrame, group: str, order: Sequence[str], size: str, limit: int, max_rows: int = 10_000, name: str = "shard") -> DataFrame:
    """Add `name`, from 0: rows of each group in order go to the current shard until the next would exceed `limit` bytes or max_rows. A row larger than the limit has a shard of
    its own. Only keys and sizes are moved to Python. Null and empty groups are groups; sizes aren't negative, null ones count 0.

    The packing resets at each cut, so it is no window frame, and a group may hold any part of all rows, so it isn't left to one task: rows are range-partitioned in order and packed in chunks. The state at a
    chunk's end depends on where its first cut falls, which is among the rows of one shard; these candidates alone go through one pass in order that finds the state each chunk begins with, and then
    all chunks are packed from their states in parallel."""
    keys = [group, *[o for o in order if o != group], size]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    sized = rows.select(*[k for k in keys if k != size], F.coalesce(F.col(size).cast("long"), F.lit(0)).alias(size))
    shown = ", ".join(f"`{k}` {kinds[k] if k != size else 'long'}" for k in keys)
    sorted_ = sized.select(keys).repartitionByRange(group, *[F.col(o) for o in order]).sortWithinPartitions(group, *order)
    packed = durable(sorted_.mapInPandas(_packed(group, size, limit, max_rows), shown + ", _c long, _first boolean, _i long, _before long, _used long, _count long, _cuts long"), "packed")
    # The pass in order: one task for each group, over a few candidates of each chunk.
    candidates = packed.where("_first").select(group, "_c", "_i", "_before", size, "_used", "_count", "_cuts").repartition(group).sortWithinPartitions(group, "_c", "_i")
    entries = candidates.mapInPandas(_entries(group, size, limit, max_rows), f"`{group}` {kinds[group]}, _c long, _eu long, _ek long, _es long")
    entries = durable(entries.withColumnRenamed(group, "_g").withColumnRenamed("_c", "_d"), "packing-entries")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: tuple = ()
        shard = used = count = 0
        for pdf in batches:
            out = np.empty(len(pdf), np.int32)
            for i, (g, c, s, eu, ek, es) in enumerate(zip(*(pdf[x].tolist() for x in (group, "_c", size, "_eu", "_ek", "_es")), strict=True)):
                if (g, c) != now:
                    now, used, count, shard = (g, c), eu, ek, es
                if count and (used + s > limit or count >= max_rows):
                    shard, used, count = shard + 1, 0, 0
                used, count, out[i] = used + s, count + 1, shard
            yield pdf[keys].assign(**{name: out})

    joined = packed.select(*keys, "_c", "_i").join(entries, (F.col("_c") == F.col("_d")) & F.col(group).eqNullSafe(F.col("_g")))
    chunks = joined.select(*keys, "_c", "_i", "_eu", "_ek", "_es").repartition("_c").sortWithinPartitions("_c", group, "_i")
    return chunks.mapInPandas(run, shown + f", `{name}` int")


def greedy_shards_wide(rows: DataFrame, order: Sequence[str], size: str, limit: int) -> DataFrame:
    """Shards of one total order over a large table, by running size without reset: shard = running size / limit. It needs no single task (see windows.dense_ordinal for the
    offsets); a shard is at most limit plus one row."""
    from pyspark.sql.window import Window

    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id())
    parts = durable(parts, "packing")
    sizes = sorted((r["_p"], r["s"]) for r in parts.groupBy("_p").agg(F.sum(size).alias("s")).collect())  # one row per partition
    before, total = [], 0
    for p, s in sizes:
        before.append((p, total))
        total += int(s or 0)
    running = F.sum(size).over(Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) + F.col("_before")
    joined = parts.join(F.broadcast(rows.sparkSession.createDataFrame(before, "_p int, _before long")), "_p")
    return joined.withColumn("shard", F.floor((running - F.col(size)) / limit).cast("long")).drop("_p", "_before")


def write_sharded(rows: DataFrame, path: str, shard: Sequence[str], order: Sequence[str], kind: str = "json") -> None:
    """One folder per shard with its rows in order. Spark's committer makes the write whole or absent."""
    writer = rows.repartition(*shard).sortWithinPartitions(*shard, *order).write.partitionBy(*shard).mode("overwrite")
    (writer.option("compression", "gzip") if kind == "json" else writer).format(kind).save(path)


def write_content_addressed(rows: DataFrame, folder: str, order: Sequence[str], limit: int = 32 * 1024 * 1024, max_rows: int = 10_000) -> str:
    """JSON lines in a total order (fields in order of their names, nulls kept), greedily in shards of at most `limit` bytes and max_rows lines, gzip, in a folder named by the SHA-256 of what it holds: that of each shard's
    lines, in order. Returns the folder. Rows that are there already, written by whatever run and partitioning, give the same folder, which is left as it is."""
    spark, path = rows.sparkSession, scratch(rows.sparkSession, "content-addressed")
    lines = rows.select(*order, F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("_line")).withColumn("_all", F.lit("")).withColumn("_bytes", F.octet_length("_line").cast("long") + 1)
    keys = [f"_o{i}" for i in range(len(order))]
    named = durable(lines.select("_all", *[F.col(o).alias(k) for o, k in zip(order, keys, strict=True)], "_bytes", "_line"), "lines")
    packed = named.join(greedy_shards(named, "_all", keys, "_bytes", limit, max_rows).drop("_all", "_bytes").distinct(), keys)
    packed.select("shard", *keys, F.col("_line").alias("value")).repartition("shard").sortWithinPartitions("shard", *keys).select("shard", "value").write.partitionBy("shard").option("compression", "gzip").text(path)
    # A shard is bounded, so its lines meet in one task; the shards' digests are one row each, and go up by a tree.
    shards = spark.read.text(path).groupBy("shard").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("value")), "\n"), 256).alias("own"))
    from ledgerloom.operators.quality import ordered_digest

    whole = ordered_digest(shards, [], F.concat_ws(":", F.lpad(F.col("shard").cast("string"), 10, "0"), "own")).first()
    target = f"{folder}/{whole['digest'] if whole and whole['digest'] else 'empty'}"
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fs = Path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(Path(target)):
        fs.mkdirs(Path(folder))
        if not fs.rename(Path(path), Path(target)):
            raise OSError(f"can't install {target}")
    return target


def write_canonical(rows: DataFrame, path: str, order: Sequence[str], max_records: int = 10_000) -> None:
    """JSON lines in a total order, fields in order of their names, nulls kept, gzip, at most max_records to a file."""
    ordered = rows.select(sorted(rows.columns)).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", "false").option("maxRecordsPerFile", max_records).json(path)


def manifest(spark, path: str) -> DataFrame:
    """(file, bytes, sha256) of what a folder holds. Files are read one by one, each within a task."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def shard_ranges(rows: DataFrame, shard: Sequence[str], key: str) -> DataFrame:
    """(shard, n, first_key, last_key): what a reader needs to prune shards."""
    return rows.groupBy(*shard).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
