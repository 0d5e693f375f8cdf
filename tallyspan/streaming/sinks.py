"""Stream plumbing shared by the streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyspan.session import scratch_path
from tallyspan.tables import SCHEMAS

BATCH = "_batch"


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int = 1000) -> DataFrame:
    """A table as a file stream: a folder of part files, or one file among those of other tables."""
    reader = spark.readStream.schema(SCHEMAS[name]).option("maxFilesPerTrigger", files_per_batch)
    path = f"{sf_dir}/{name}.parquet"
    if _status(spark, path, "isDirectory"):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _status(spark: SparkSession, path: str, what: str) -> bool:
    """``exists`` or ``isDirectory`` of a path, by Spark's own file systems."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return getattr(place.getFileSystem(spark._jsc.hadoopConfiguration()), what)(place)


def run_available(stream: DataFrame, out: str, mode: str, checkpoint: str | None = None) -> None:
    """Process what is there, then stop. Each micro-batch is one partition of the output.

    A batch that is replayed after a failure overwrites its own partition, so nothing doubles.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{BATCH}={number}")

    q = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint or scratch_path(spark, "stream"))
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    q.awaitTermination()


def read_batches(spark: SparkSession, schema: T.StructType, out: str) -> DataFrame:
    """The output of ``run_available`` with the number of each row's micro-batch; empty if the stream had no input."""
    schema = T.StructType([*schema.fields, T.StructField(BATCH, T.IntegerType())])
    if not _status(spark, out, "exists"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out)


def latest(out: DataFrame, keys: list[str]) -> DataFrame:
    """The last version of every row of an update-mode output."""
    values = [c for c in out.columns if c not in (*keys, BATCH)]
    newest = F.max_by(F.struct(*values), F.col(BATCH)).alias("_v")
    return out.groupBy(*keys).agg(newest).select(*keys, "_v.*")


def set_arrival_times(spark: SparkSession, folder: str) -> None:
    """Date the files of a folder partitioned by one number so that a file stream takes them in its order, a second apart."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in files.listStatus(root):
        name = entry.getPath().getName()
        if "=" in name:
            at = 1_700_000_000_000 + 1000 * int(name.split("=")[1])
            for part in files.listStatus(entry.getPath()):
                files.setTimes(part.getPath(), at, at)
