"""Session settings, table access and the shared folder that intermediate tables go to."""

from __future__ import annotations

import atexit
import hashlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: What a session of our own gets. Everything that depends on the size of the data (partitions, broadcasts, skew) is left to
#: adaptive execution, which measures it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", app: str = "ledgerloom", **settings: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    """Partitions that a shuffle of this session makes."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir where the cluster names it. Only a local session, which is one
    process on one machine, falls back to a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = os.path.join(tempfile.gettempdir(), "ledgerloom-shared")
    os.makedirs(folder, exist_ok=True)
    return f"file://{folder}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/ledgerloom/{spark.sparkContext.applicationId}"


_tidied: set[str] = set()


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder, used by one run of one operator. All paths of an application stand in one folder, which release removes, at
    the latest when the driver ends."""
    folder = _own_folder(spark)
    if folder not in _tidied:
        _tidied.add(folder)
        atexit.register(_release_quietly, spark, folder)
    return f"{folder}/{what}-{uuid.uuid4().hex}"


def durable(df: DataFrame, what: str) -> DataFrame:
    """Write df to the shared folder and read it back. Cuts the lineage in a way that survives lost executors: a later stage
    reads files, never blocks that only one executor held. The table stays until discard or release."""
    path = scratch(df.sparkSession, what)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._ledgerloom_path = path
    return found


def durable_counted(df: DataFrame, what: str, test: Column) -> tuple[DataFrame, int]:
    """The same, with the number of rows that pass a test, counted by the tasks that write: each counts once, however often it is tried."""
    seen = Observation()
    found = durable(df.observe(seen, F.count(F.when(test, 1)).alias("n")), what)
    return found, seen.get.get("n", 0)


def parts(spark: SparkSession, tables: list[DataFrame]) -> DataFrame:
    """Durable tables of one schema as one scan."""
    found = spark.read.schema(tables[0].schema).parquet(*[t._ledgerloom_path for t in tables])
    return found


def stored(what: str, source: DataFrame, build: Callable[[str], None]) -> str:
    """The folder of something made from files and used many times, such as an index: made by build(path) when it is first asked for, found again as long as the application runs and the
    files are the same (by name, size and time)."""
    spark = source.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    seen = hashlib.sha256()
    for name in sorted(source.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        state = path.getFileSystem(conf).getFileStatus(path)
        seen.update(f"{name} {state.getLen()} {state.getModificationTime()}\n".encode())
    folder = f"{os.path.dirname(scratch(spark, what))}/{what}-{seen.hexdigest()[:32]}"
    done = jvm.org.apache.hadoop.fs.Path(f"{folder}/_DONE")
    fs = done.getFileSystem(conf)
    if not fs.exists(done):
        drop_path(spark, folder)
        build(folder)
        fs.create(done).close()
    return folder


def discard(*tables: DataFrame) -> None:
    """Remove durable tables that no plan reads any more."""
    for t in tables:
        drop_path(t.sparkSession, t._ledgerloom_path)


def release(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application. DataFrames that were made from them can't be read afterwards, so call it when results are written."""
    drop_path(spark, _own_folder(spark))


def _release_quietly(spark: SparkSession, folder: str) -> None:
    """At the end of the driver. A session that was stopped can still remove a local folder; any other is left to the next clean-up of the shared folder."""
    try:
        if folder.startswith("file://"):
            shutil.rmtree(folder.removeprefix("file://"), ignore_errors=True)
        else:
            drop_path(spark, folder)
    except Exception:  # noqa: BLE001 - the driver is going down; nothing is lost but the clean-up
        pass


def spread(scan: DataFrame) -> DataFrame:
    """A scan for costly work on each row: one that Spark would cut into fewer partitions than there are cores (a few small files) is dealt out to all of them.
    As many files as cores, or enough bytes, give enough partitions, and such a scan stays as it is, unmoved."""
    spark = scan.sparkSession
    files, cores = scan.inputFiles(), spark.sparkContext.defaultParallelism
    if not files or len(files) >= cores:
        return scan
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in files]
    sizes = [p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths]
    number = lambda key: spark._jsparkSession.sessionState().conf().getConfString(key)
    as_bytes = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    most, least = (as_bytes(number(f"spark.sql.files.{k}")) for k in ("maxPartitionBytes", "openCostInBytes"))
    split = min(most, max(least, sum(n + least for n in sizes) // cores))
    return scan.repartition(cores) if sum(-(-n // split) for n in sizes) < cores else scan


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in the shared folder."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(jpath)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that no later plan reads."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)
