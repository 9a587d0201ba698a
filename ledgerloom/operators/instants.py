"""Mixed time texts to instants through a persisted dictionary of distinct values.

Raw texts are deduplicated with their source and zone, each distinct one is parsed once, the dictionary grows by what a batch
brings that it lacks, and the instants are joined back to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.instants import utc_micros
from ledgerloom.operators.balance import lookup
from ledgerloom.session import durable, scratch

#: Source, text and zone ('' for none) are the key.
KEY = ["source_table", "text", "zone"]
DICTIONARY = T.StructType([*[T.StructField(k, T.StringType()) for k in KEY], T.StructField("utc_micros", T.LongType())])


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        found = [utc_micros(t, z or None) for t, z in zip(pdf["text"], pdf["zone"], strict=True)]
        yield pd.DataFrame({**{k: pdf[k] for k in KEY}, "utc_micros": pd.array(found, dtype="Int64")})


class InstantDictionary:
    """The dictionary as a folder of parquet batches. A batch is whole or absent (Spark's commit), so a job that is run again
    after a failure parses what is missing and nothing twice."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path, self.batches = spark, path or scratch(spark, "instants"), 0
        names = self._stored()
        self.batches = 1 + max((int(n.split("-")[1]) for n in names), default=-1)

    def _stored(self) -> list[str]:
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = jpath.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(jpath):
            return []
        found = [s.getPath() for s in fs.listStatus(jpath)]
        return sorted(p.getName() for p in found if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def table(self) -> DataFrame | None:
        names = self._stored()
        return self.spark.read.schema(DICTIONARY).parquet(*[f"{self.path}/{n}" for n in names]) if names else None

    def extend(self, counts: DataFrame) -> None:
        """Parse those of the distinct (source, text, zone) that the dictionary lacks and add them."""
        known = self.table()
        new = counts.select(*KEY)
        if known is not None:
            new = new.join(known.select(*KEY), KEY, "left_anti")
        new.mapInPandas(_parse, DICTIONARY).write.mode("overwrite").parquet(f"{self.path}/batch-{self.batches:06d}")
        self.batches += 1


def normalise(rows: DataFrame, dictionary: InstantDictionary) -> DataFrame:
    """rows: source_table, row_key, field_name, text, zone (both nullable). Result: source_table, row_key, field_name, text,
    utc_micros, one row for each distinct row given; utc_micros is null where the text denotes no instant. Null texts are left
    out before anything is moved: they denote none. Redelivered rows appear once; an empty table gives an empty result."""
    rows = rows.where(F.col("text").isNotNull()).select("source_table", "row_key", "field_name", "text", F.coalesce("zone", F.lit("")).alias("zone")).distinct()
    rows = durable(rows, "time-rows")
    counts = durable(rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")), "time-texts")
    dictionary.extend(counts)
    return lookup(rows, dictionary.table(), KEY, counts=counts).select("source_table", "row_key", "field_name", "text", "utc_micros")


def time_rows(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The time texts of the three sources in one shape. In JSON, the record's own time_zone is its zone; damaged JSON gives
    no texts."""
    from ledgerloom.session import table

    def shape(source, key, field, text, zone):
        return [F.lit(source).alias("source_table"), key.cast("string").alias("row_key"), F.lit(field).alias("field_name"), text.alias("text"), zone.alias("zone")]

    parts = table(spark, folder, "search_parts").select(*shape("search_parts", F.col("part_key"), "retrieved_at", F.col("retrieved_at"), F.col("source_zone")))
    pages = table(spark, folder, "acquisition").select(*shape("acquisition", F.col("acquisition_id"), "public_timestamp", F.col("public_timestamp"), F.col("source_zone")))
    work = table(spark, folder, "work_items").select("work_id", F.from_json("input_json", "public_updated_at string, retrieved_at string, time_zone string").alias("j"))
    work = work.select("work_id", "j.time_zone", F.explode(F.create_map(F.lit("public_updated_at"), F.col("j.public_updated_at"), F.lit("retrieved_at"), F.col("j.retrieved_at"))).alias("field_name", "text"))
    work = work.select(F.lit("work_items").alias("source_table"), F.col("work_id").cast("string").alias("row_key"), "field_name", "text", F.col("time_zone").alias("zone"))
    return [parts, pages, work]
