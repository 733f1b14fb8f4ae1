"""Run a streaming query to completion over the data available now.

Results go to files in the shared checkpoint folder (never to driver
memory): append mode writes through the exactly-once file sink; complete
mode writes each result table to a folder of its own from ``foreachBatch``;
a caller's own writer keeps what update mode changes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import FREE_SHUFFLES, ROCKSDB_STATE_STORE, drop_dir, settings, work_dir

#: Files that each micro-batch of a staged replay has at least.
FILES_PER_BATCH = 4
#: A run to the end of its input needs the last state only: older versions go as soon as a later one is safe.
LAST_STATE = {"spark.sql.streaming.minBatchesToRetain": "2", "spark.sql.streaming.stateStore.minDeltasForSnapshot": "3",
              "spark.sql.streaming.stateStore.maintenanceInterval": "10s", "spark.sql.streaming.stateStore.compression.codec": "zstd"}
#: State that is kept for good: on the executors' disks, of their memory a fixed share; one store for both sides of a join.
KEPT_STATE = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_STATE_STORE,
              "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
              "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
              "spark.sql.streaming.join.stateFormatVersion": "3"}


def time_cuts(df: DataFrame, time_col: str, batches: int) -> list:
    """``batches - 1`` times that cut the rows into about equal parts."""
    times = df.select(F.col(time_col).cast("timestamp").cast("double").alias("t"))
    at = times.agg(F.percentile_approx("t", [i / batches for i in range(1, batches)], 1000)).first()[0]
    return sorted(set(at or []))


@dataclass(frozen=True)
class Staged:
    """A folder of record files in order, ``files`` of them a micro-batch."""

    path: str
    files: int


def stage_records(spark: SparkSession, records: DataFrame, purpose: str, cuts: list | None = None,
                  last: DataFrame | None = None) -> Staged:
    """Write Kafka-shaped records as files a file stream can replay.

    The records are worked out once, into a folder for each time slice, with
    Spark's own number of files.  A file stream takes files in the order they
    were written, so the slices are then copied one after another into the
    folder of the stream, the same number of files for each (the mean number
    that Spark wrote for a slice): a stream that reads so many files per trigger gets the slices
    as ordered micro-batches.  A slice is dropped once it is copied.  ``last``: records of one more slice at the end.
    """
    path, sliced = work_dir(spark, purpose), work_dir(spark, f"{purpose}-slices")
    t = F.col("timestamp").cast("double")
    number = F.lit(0)
    for cut in cuts or []:
        number = number + F.coalesce((t >= cut).cast("int"), F.lit(0))
    schema = StructType([*records.schema.fields, StructField("slice", IntegerType())])
    with settings(spark, FREE_SHUFFLES):
        records.withColumn("slice", number).write.partitionBy("slice").parquet(sliced)
        slices = spark.read.schema(schema).parquet(sliced)
        files = max(FILES_PER_BATCH, -(-len(slices.inputFiles()) // (len(cuts or []) + 1)))
        for k in range(len(cuts or []) + 1):
            slices.where(F.col("slice") == k).drop("slice").repartition(files).write.mode("append").parquet(path)
            drop_dir(spark, f"{sliced}/slice={k}")
    drop_dir(spark, sliced)
    if last is not None:
        append_records(last, path)
    return Staged(path, files)


def append_records(records: DataFrame, path: str) -> None:
    """Add files to a staged folder (a later micro-batch picks them up)."""
    records.write.mode("append").parquet(path)


def run_available_now(df: DataFrame, out_path: str, checkpoint: str, mode: str = "append",
                      timeout_s: float | None = None, query_name: str | None = None,
                      finish=None, write: Callable[[DataFrame, int], None] | None = None,
                      partitions: int | None = None, conf: dict[str, str] | None = None) -> str:
    """Run ``df`` with ``trigger(availableNow=True)`` to its end (no time limit unless given).

    ``partitions``: state partitions of a new checkpoint (else ``spark.sql.shuffle.partitions``).
    Each writes its state's files after every batch, however few rows it has.
    ``conf``: more settings for the query.

    Returns the folder of the result.  ``write``: a ``foreachBatch`` function
    that keeps the result itself (see :class:`.results.ResultTable`).  Complete mode writes the result table
    of each micro-batch, after ``finish`` (a batch DataFrame -> DataFrame
    function) if given, to ``out_path/batch_id=N``; the last one is the
    result, and a failure half-way leaves the earlier tables whole.
    """
    done: list[str] = []
    if write is not None:
        writer = df.writeStream.outputMode(mode).foreachBatch(write)
    elif mode == "complete":
        def write_all(batch: DataFrame, batch_id: int) -> None:
            to = f"{out_path}/batch_id={batch_id}"
            (finish(batch) if finish else batch).write.mode("overwrite").parquet(to)
            done.append(to)
        writer = df.writeStream.outputMode("complete").foreachBatch(write_all)
    else:
        writer = df.writeStream.outputMode(mode).format("parquet").option("path", out_path)
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if query_name:
        writer = writer.queryName(query_name)
    own = {"spark.sql.shuffle.partitions": str(partitions)} if partitions else {}
    with settings(df.sparkSession, {**FREE_SHUFFLES, **LAST_STATE, **(conf or {}), **own}):
        q = writer.start()                           # a query keeps the settings it was started with
    try:
        finished = q.awaitTermination(timeout_s) if timeout_s else (q.awaitTermination() or True)
        if not finished:
            raise TimeoutError(f"stream did not finish within {timeout_s}s")
    finally:
        if q.isActive:
            q.stop()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return done[-1] if done else out_path


def max_time(*frames_and_cols: tuple[DataFrame, str]) -> DataFrame:
    """One-row DataFrame ``t`` = latest time over several (frame, column) pairs."""
    out = None
    for df, col in frames_and_cols:
        one = df.agg(F.max(F.col(col).cast("timestamp")).alias("t"))
        out = one if out is None else out.unionByName(one)
    return out.agg(F.max("t").alias("t"))
