"""Streaming forms of the resumable batch operators. Each takes what is there now, remembers its place and ends; the answer equals the batch one."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import scratch


def stream_of(spark: SparkSession, folder: str, name: str, files_at_a_time: int = 1) -> DataFrame:
    """A table of the folder as a stream of files."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_a_time).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def run_available(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append what is available to the table at path; a later run with the same checkpoint goes on from there. A batch is written whole or not at all."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def first_seen(stream: DataFrame, keys: Sequence[str], time: str | None = None, within: str = "7 days") -> DataFrame:
    """Insert-or-ignore: the first row of each key, over all batches. With a time column a key leaves the state once nothing of `within` it can come any more, so the state is bounded by the keys of that span;
    without one every key is kept for good, which suits a set of keys of known size."""
    if time is None:
        return stream.dropDuplicates(list(keys))
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, within).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, time: str, by: Sequence[str], width: str = "1 hour", late: str | None = "1 day") -> DataFrame:
    """Counts of tumbling windows: in append mode each given once, when the watermark has passed it; in update mode (run_updates) as they grow, so that open ones are given too.
    Without `late` no row is too late, and no window leaves the state."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp"))
    counted = (timed.withWatermark(time, late) if late else timed).groupBy(F.window(time, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), *by, "n")


STATE = T.StructType([T.StructField("state", T.StringType()), T.StructField("sequence", T.LongType()), T.StructField("refused", T.LongType())])
OUTPUT = T.StructType([T.StructField("task", T.StringType()), *STATE.fields])


def task_states(stream: DataFrame, allowed: dict[str, Sequence[str]]) -> DataFrame:
    """State machine of events (task, sequence, to): an event counts if it follows on the task's last one and the move is allowed, else it is refused. Of each task that a batch
    touches, the state after it. allowed: state -> next states; new tasks are in state ''."""

    def advance(key, batches: Iterator[pd.DataFrame], held):
        state, sequence, refused = held.get if held.exists else ("", -1, 0)
        events = pd.concat(list(batches)).sort_values("sequence")
        for number, to in zip(events["sequence"].tolist(), events["to"].tolist(), strict=True):
            if number > sequence and to in allowed.get(state, ()):
                state, sequence = to, number
            else:
                refused += 1
        held.update((state, int(sequence), int(refused)))
        yield pd.DataFrame([(key[0], state, int(sequence), int(refused))], columns=OUTPUT.names)

    return stream.groupBy("task").applyInPandasWithState(advance, OUTPUT, STATE, "update", "NoTimeout")


def run_updates(stream: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Run an update stream to its end and give the last row of each key. Batches go to the shared folder as they come."""
    from ledgerloom.operators.windows import latest

    spark, path = stream.sparkSession, scratch(stream.sparkSession, "updates")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/rows/_batch_{number}".replace("_batch_", "b-"))

    query = stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.option("recursiveFileLookup", "true").schema(T.StructType([*stream.schema.fields, T.StructField("_batch", T.IntegerType())])).parquet(f"{path}/rows")
    return latest(rows, keys, ["_batch", order] if order else ["_batch"]).drop("_batch")
