"""Session settings and the shared folder for materialised intermediates."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH_CONF = "spark.tallyspan.scratch"
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_written: list[str] = []


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyspan")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # generated methods that the JVM would not compile are worse than split ones
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def cluster_settings(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings to submit a job with, from the size of its input and the cores of the cluster.

    Shuffle partitions of about 200 MB before adaptive execution merges the small ones, at least
    three per core; skewed joins are split; large streaming state goes to disk.
    """
    partitions = max(3 * cores, math.ceil(input_bytes / (200 * 1024 * 1024)))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200m",
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def use_utc(spark: SparkSession) -> SparkSession:
    """All bucketing is defined on UTC instants, so the session zone has to be UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when the session names none and runs in one process (tests) is a local folder made.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    own = spark.conf.get(_SCRATCH_CONF, None)
    if own:
        return own
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="tallyspan-")
    spark.conf.set(_SCRATCH_CONF, own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one; ``clear_scratch`` removes it."""
    path = f"{scratch_dir(spark)}/tallyspan/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def written() -> set[str]:
    """The folders in the shared one that this process has written and not deleted."""
    return set(_written)


def discard(spark: SparkSession, paths: set[str]) -> None:
    """Delete some of the folders that this process has written, which no result reads any more."""
    files = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark)).getFileSystem(spark._jsc.hadoopConfiguration())
    for path in paths:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)
        _written.remove(path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this process has written to the shared folder; returns the number of folders.

    Operators write tables that their results still read, so this is called once results are read or stored:
    at the end of a job, or between queries.
    """
    files = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark)).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = sum(files.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True) for path in _written)
    _written.clear()
    return gone


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back. Runs the job when called.

    Cuts lineage like a reliable checkpoint, survives lost executors, and the reader still
    prunes columns and row groups. The job's shuffle files are removed when the table is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_SHUFFLE_CLEANUP)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str) -> DataFrame:
    """``materialise`` in buckets of ``key``, one per shuffle partition: a join by ``key`` reads it without shuffling it.

    The session's catalog knows the table only until this returns; the folder is like any other in the shared one.
    """
    spark = df.sparkSession
    path, own = scratch_path(spark, name), f"tallyspan_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, str(buckets))  # else each task sorts its rows by bucket
    try:
        df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(own)
    finally:
        spark.conf.set(writers, before)
    made = spark.table(own)
    spark.sql(f"DROP TABLE {own}")
    return made
