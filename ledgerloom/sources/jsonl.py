"""JSON line sources: plain, bounded, sharded with a verified manifest, arrays. Schemas are always given, nothing is inferred."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """JSON lines, gzip or not. Strict fails on a damaged line; otherwise damaged lines have nulls."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)


def read_raw_jsonl(spark: SparkSession, path: str, max_bytes: int | None = None) -> DataFrame:
    """(file, line): lines as they are, empty ones left out. A line of more than max_bytes fails the job, naming its file."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line")).where(F.trim("line") != "")
    if max_bytes is None:
        return lines
    too_long = F.raise_error(F.concat(F.lit("line too long in "), F.col("file"))).cast("string")
    return lines.withColumn("line", F.when(F.octet_length("line") > max_bytes, too_long).otherwise(F.col("line")))


def line_faults(spark: SparkSession, path: str, max_bytes: int | None = None, canonical: bool = True) -> DataFrame:
    """(file, fault, n) of JSON lines: not_an_object, too_long (over max_bytes), and not_canonical where canonical spelling is asked for (sorted fields, no white space, UTF-8 unescaped). Empty lines have no fault."""
    from ledgerloom.operators.quality import canonical_json

    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("line")).where(F.trim("line") != "")
    tests = {"not_an_object": F.try_parse_json("line").isNull() | ~F.col("line").rlike(r"^\s*\{")}
    if max_bytes is not None:
        tests["too_long"] = F.octet_length("line") > max_bytes
    if canonical:
        tests["not_canonical"] = ~F.coalesce(canonical_json("line") == F.col("line"), F.lit(False))
    found = lines.select("file", F.explode(F.array_compact(F.array(*[F.when(t, F.lit(n)) for n, t in tests.items()]))).alias("fault"))
    return found.groupBy("file", "fault").agg(F.count(F.lit(1)).alias("n"))


def read_gzip_json(spark: SparkSession, path: str, compressed: int, uncompressed: int) -> DataFrame:
    """(file, text) of gzip files that are read whole, each within bounds: more bytes than either bound, or damage, fails the job. Unpacking stops at the bound."""
    files = spark.read.format("binaryFile").load(path)

    @F.pandas_udf(T.StringType())
    def unpacked(contents: pd.Series) -> pd.Series:
        def one(content: bytes) -> str:
            machine = zlib.decompressobj(31)
            text = machine.decompress(content, uncompressed + 1)
            if len(text) > uncompressed or not machine.eof:
                raise ValueError("more bytes than allowed, or a damaged file")
            return text.decode()

        return contents.map(one)

    checked = F.when(F.col("length") > compressed, F.raise_error(F.concat(F.lit("too large: "), F.col("path"))).cast("binary")).otherwise(F.col("content"))
    return files.select(F.col("path").alias("file"), unpacked(checked).alias("text"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Files that each hold one JSON array of objects; a file is one task."""
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "FAILFAST").json(path)


def verify_shards(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """(file, problem) of shards against a manifest (file, bytes, sha256): missing, unlisted, or other bytes."""
    from ledgerloom.operators.packing import manifest as actual

    have = actual(spark, path).select("file", F.col("bytes").alias("b"), F.col("sha256").alias("s"))
    both = manifest.select("file", "bytes", "sha256").join(have, "file", "full_outer")
    problem = F.when(F.col("s").isNull(), "missing").when(F.col("sha256").isNull(), "unlisted").when((F.col("b") != F.col("bytes")) | (F.col("s") != F.col("sha256")), "changed")
    return both.select("file", problem.alias("problem")).where(F.col("problem").isNotNull())


def read_verified(spark: SparkSession, path: str, manifest: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The records of a sharded source, once all its shards are as the manifest says."""
    bad = verify_shards(spark, path, manifest).limit(5).collect()
    if bad:
        raise ValueError(f"shards differ from the manifest: {[(r['file'], r['problem']) for r in bad]}")
    return read_jsonl(spark, path, schema)


def read_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Records of a file or folder, by its name: .parquet, .json (one array a file), else JSON lines. A folder that mixes them is refused."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [p.getPath().getName() for p in fs.listStatus(jpath)] if fs.getFileStatus(jpath).isDirectory() else [jpath.getName()]
    shown = [n for n in names if not n.startswith(("_", "."))]
    kinds = {"parquet" if n.endswith(".parquet") else "array" if n.endswith((".json", ".json.gz")) and not n.startswith("part-") else "lines" for n in shown}
    if len(kinds) > 1:
        raise ValueError(f"{path} mixes {sorted(kinds)}")
    if kinds == {"parquet"}:
        return spark.read.schema(schema).parquet(path)
    return read_json_array(spark, path, schema) if kinds == {"array"} else read_jsonl(spark, path, schema)
