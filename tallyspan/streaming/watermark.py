"""Rollup of an endless stream by event time: complete buckets are emitted once, late rows go to a table of rejects.

Each micro-batch rolls its own rows up and adds the states to a table by bucket; nothing written before is read or
rewritten. The watermark is the latest time seen less a delay. Once it has passed the end of a bucket, the bucket's
states are combined and appended to the output; once a whole day of them is out, its states are deleted. A row whose bucket the watermark had
passed before its micro-batch began is late. So state is what open buckets need, whatever the stream's length.

Everything a micro-batch writes is in partitions of its own number, and it begins from what its predecessor wrote: a batch
that is replayed after a failure writes the same rows again in the same places. Executors may be lost at any time.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyspan.functions.granularity import Granularity
from tallyspan.operators.aggregate import Aggregator
from tallyspan.operators.rollup import BUCKET, bucketed, finished
from tallyspan.streaming.sinks import BATCH, _status, read_batches

REASON = "reason"
_CELL = "_day"  # states are kept by the day in which their bucket ends
_END = "_end"
_DAY = 86_400_000_000


@dataclass
class AppendedRollup:
    """Where a streaming rollup keeps its parts: ``out``, ``rejects``, ``states`` and ``marks`` under ``path``."""

    path: str
    ts: str
    gran: Granularity
    dims: list[str]
    aggregators: list[Aggregator]
    delay: str
    min_time: str | None = None

    def _states_schema(self, rows: DataFrame) -> T.StructType:
        aggs = [a.partial.alias(a.name) for a in self.aggregators]
        return bucketed(rows.limit(0), self.ts, self.gran, self.min_time).groupBy(BUCKET, *self.dims).agg(*aggs).schema

    def _mark(self, spark: SparkSession, before: int) -> int | None:
        """The watermark (microseconds) after the last batch before the given one."""
        marks = f"{self.path}/marks"
        if not _status(spark, marks, "exists"):
            return None
        rows = spark.read.schema(f"watermark long, {BATCH} int").parquet(marks).where(F.col(BATCH) < before)
        return rows.agg(F.max_by("watermark", BATCH)).first()[0]

    def _drop(self, spark: SparkSession, mark: int | None) -> None:
        """Delete the states of buckets that committed batches have emitted."""
        states = f"{self.path}/states"
        if mark is None or not _status(spark, states, "exists"):
            return
        place = spark._jvm.org.apache.hadoop.fs.Path(states)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        for entry in files.listStatus(place):  # one folder per day
            name = entry.getPath().getName()
            if name.startswith(f"{_CELL}=") and (int(name.split("=")[1]) + 1) * _DAY <= mark:
                files.delete(entry.getPath(), True)

    def write(self, batch: DataFrame, number: int) -> None:
        """One micro-batch; for ``foreachBatch``."""
        spark = batch.sparkSession
        mark = self._mark(spark, number)
        self._drop(spark, mark)
        batch = batch.persist()
        try:
            at = F.col(self.ts)
            end = F.unix_micros(self.gran.end(at))
            reason = F.when(at.isNull(), "no time")
            if self.min_time is not None:
                reason = reason.when(at < F.lit(self.min_time).cast("timestamp"), "before the minimum time")
            if mark is not None:
                reason = reason.when(end <= mark, "late")
            judged = batch.withColumn(REASON, reason)
            judged.where(F.col(REASON).isNotNull()).write.mode("overwrite").parquet(f"{self.path}/rejects/{BATCH}={number}")
            rows = judged.where(F.col(REASON).isNull()).drop(REASON)
            aggs = [a.partial.alias(a.name) for a in self.aggregators]
            states = bucketed(rows, self.ts, self.gran, self.min_time).groupBy(BUCKET, *self.dims).agg(*aggs)
            states = states.withColumn(_END, F.unix_micros(self.gran.end(F.col(BUCKET))))
            # a bucket's last instant is in its day, so a day is over when the watermark is at its end
            states = states.withColumns({_CELL: F.floor((F.col(_END) - 1) / _DAY), BATCH: F.lit(number)})
            writer = states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(_CELL, BATCH)
            writer.parquet(f"{self.path}/states")
            seen = batch.agg(F.unix_micros(F.max(at) - F.expr(f"interval {self.delay}"))).first()[0]
        finally:
            batch.unpersist()
        after = max((m for m in (mark, seen) if m is not None), default=None)
        self._emit(spark, batch, mark, after, number)
        if after is not None:  # written last: it stands for the whole batch
            spark.range(1).select(F.lit(after).alias("watermark")).write.mode("overwrite").parquet(f"{self.path}/marks/{BATCH}={number}")

    def _emit(self, spark: SparkSession, batch: DataFrame, before: int | None, mark: int | None, number: int) -> None:
        """Append the buckets that the watermark has passed in this batch."""
        if mark is None or mark == before or not _status(spark, f"{self.path}/states", "exists"):
            return
        held = self._states(spark, batch).where((F.col(_CELL) <= mark // _DAY) & (F.col(_END) <= mark) & (F.col(BATCH) <= number))
        if before is not None:
            held = held.where((F.col(_CELL) >= before // _DAY) & (F.col(_END) > before))
        done = held.groupBy(BUCKET, *self.dims).agg(*[a.combine(F.col(a.name)).alias(a.name) for a in self.aggregators])
        finished(done, self.aggregators).write.mode("overwrite").parquet(f"{self.path}/out/{BATCH}={number}")

    def _states(self, spark: SparkSession, rows: DataFrame) -> DataFrame:
        schema = T.StructType([*self._states_schema(rows).fields, T.StructField(_END, T.LongType()), T.StructField(_CELL, T.LongType()), T.StructField(BATCH, T.IntegerType())])
        return spark.read.schema(schema).parquet(f"{self.path}/states")

    def run(self, stream: DataFrame, checkpoint: str, available_now: bool = True):
        """Start the stream; with ``available_now`` what is there is read to its end. Returns the streaming query."""
        writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.write)
        if available_now:
            writer = writer.trigger(availableNow=True)
        q = writer.start()
        if available_now:
            q.awaitTermination()
            self._drop(stream.sparkSession, self._mark(stream.sparkSession, 1 << 31))
        return q

    def emitted(self, rows: DataFrame) -> DataFrame:
        """Complete buckets with the number of the batch that emitted each; ``rows`` has the columns of the stream."""
        states = finished(self._states_schema_frame(rows), self.aggregators)
        return read_batches(rows.sparkSession, states.schema, f"{self.path}/out")

    def rejected(self, rows: DataFrame) -> DataFrame:
        """Rows that are in no bucket, with the reason and the number of the batch they came in."""
        return read_batches(rows.sparkSession, T.StructType([*rows.schema.fields, T.StructField(REASON, T.StringType())]), f"{self.path}/rejects")

    def open_buckets(self, rows: DataFrame) -> DataFrame:
        """What is rolled up so far of buckets that are not complete."""
        spark = rows.sparkSession
        if not _status(spark, f"{self.path}/states", "exists"):
            return finished(self._states_schema_frame(rows), self.aggregators)
        mark = self._mark(spark, 1 << 31)
        held = self._states(spark, rows).where(F.col(_END) > mark) if mark is not None else self._states(spark, rows)
        merged = held.groupBy(BUCKET, *self.dims).agg(*[a.combine(F.col(a.name)).alias(a.name) for a in self.aggregators])
        return finished(merged, self.aggregators)

    def _states_schema_frame(self, rows: DataFrame) -> DataFrame:
        return rows.sparkSession.createDataFrame([], self._states_schema(rows))


def rollup_appended(
    path: str, ts: str, gran: Granularity, dims: Iterable[str], aggregators: Iterable[Aggregator], delay: str, min_time: str | None = None
) -> AppendedRollup:
    """A streaming rollup that emits each bucket once, ``delay`` (as in ``2 days``) after its end by event time.

    Rows without a time, before the minimum time, or late go to the rejects with a reason. Aggregators need a combining
    form: those with ``state=True`` where there is a choice. A batch without rows moves nothing.
    """
    return AppendedRollup(path.rstrip("/"), ts, gran, list(dims), list(aggregators), delay, min_time)
