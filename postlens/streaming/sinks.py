"""Sinks for batch marts and streaming queries.

Every streaming sink except console/memory requires a checkpoint folder
(on shared storage), so a restarted query resumes where it stopped.
Credentials come from the caller's options, never from literals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import messages as msg

OUTPUT_MODES = ("append", "update", "complete")


# -- batch -----------------------------------------------------------------

def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, extra: dict | None = None) -> dict:
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver:
        opts["driver"] = driver
    opts.update(extra or {})
    return opts


def jdbc_write(df: DataFrame, options: dict, mode: str = "overwrite") -> None:
    """One result table over JDBC (``overwrite`` replaces the table)."""
    df.write.format("jdbc").mode(mode).options(**options).save()


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: tuple[str, ...] = ()) -> None:
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


# -- foreachBatch writers (idempotent per batch id) -------------------------

def batch_table_writer(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each micro-batch into its own
    ``batch_id=N`` partition with dynamic partition overwrite: a replayed
    batch replaces its earlier attempt instead of adding to it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
         .write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").save(path))
    return write


def jdbc_delete(spark, options: dict, batch_id: int) -> None:
    """Deletes the rows of one batch over the JVM's JDBC driver; a missing table is no error.

    Nothing but SQL state 42S02 / 42P01 (and Derby's 42X05) means "no such table"; other errors are raised.
    """
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k in ("user", "password"):
        if options.get(k) is not None:
            props.setProperty(k, options[k])
    if options.get("driver"):
        jvm.java.lang.Class.forName(options["driver"])
    con = jvm.java.sql.DriverManager.getConnection(options["url"], props)
    try:
        statement = con.prepareStatement(f"DELETE FROM {options['dbtable']} WHERE batch_id = ?")
        statement.setLong(1, batch_id)
        statement.executeUpdate()
        if not con.getAutoCommit():
            con.commit()
    except Exception as e:  # noqa: BLE001  (Py4J wraps the SQLException)
        state = getattr(getattr(e, "java_exception", None), "getSQLState", lambda: None)()
        if state not in ("42S02", "42P01", "42X05"):
            raise
    finally:
        con.close()


def jdbc_append(batch: DataFrame, options: dict) -> None:
    jdbc_write(batch, options, "append")


def batch_jdbc_writer(options: dict, delete: Callable = jdbc_delete,
                      append: Callable = jdbc_append) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function storing each micro-batch with its ``batch_id``.

    A JDBC append commits partition by partition, so a failed batch may be
    stored in part.  The writer therefore deletes the batch's rows first and
    then appends all of them: after a retry the batch is whole and single.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        delete(batch.sparkSession, options, batch_id)
        append(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")), options)
    return write


def jdbc_complete_writer(options: dict, write: Callable = jdbc_write) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for complete mode: each result table replaces the one before.

    The table is emptied and filled (``truncate``), keeping its columns and
    rights; a batch that is run again leaves the same rows.
    """
    def replace(batch: DataFrame, batch_id: int) -> None:
        write(batch, options | {"truncate": "true"}, "overwrite")
    return replace


def batch_upsert_writer(path: str, keys: tuple[str, ...]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for update mode: the newest row per key.

    Each trigger adds its changed rows as ``batch_id=N`` only; the current
    table is :func:`read_upserts`, so nothing that was written is rewritten.
    """
    plain = batch_table_writer(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        missing = [k for k in keys if k not in batch.columns]
        if missing:
            raise ValueError(f"no key columns {missing}")
        plain(batch, batch_id)
    return write


def read_upserts(spark, path: str, keys: tuple[str, ...]) -> DataFrame:
    """The newest row per key of a folder written by :func:`batch_upsert_writer`."""
    rows = spark.read.parquet(path)
    others = [c for c in rows.columns if c not in keys and c != "batch_id"]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_row"))
    return newest.select(*keys, *[F.col("_row")[c].alias(c) for c in others])


# -- streaming -----------------------------------------------------------------

def start_stream(df: DataFrame, sink: str = "parquet", *, mode: str = "append", path: str | None = None,
                 checkpoint: str | None = None, trigger_seconds: float | None = None,
                 available_now: bool = False, query_name: str | None = None,
                 foreach_batch: Callable[[DataFrame, int], None] | None = None,
                 options: dict | None = None) -> StreamingQuery:
    """Start a streaming query and return it (call ``awaitTermination`` to block).

    sink: parquet / json / csv / orc (file sinks, append only), kafka,
    console, memory (tests), foreachBatch (pass ``foreach_batch``).
    """
    if mode not in OUTPUT_MODES:
        raise ValueError(f"output mode must be one of {OUTPUT_MODES}")
    needs_checkpoint = sink not in ("console", "memory")
    if needs_checkpoint and not checkpoint:
        raise ValueError("a checkpoint folder is required for this sink")
    w = df.writeStream.outputMode(mode)
    if sink == "foreachBatch":
        if foreach_batch is None:
            raise ValueError("foreachBatch sink needs foreach_batch")
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink)
    if path:
        w = w.option("path", path)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()


def console_sink(df: DataFrame, mode: str = "append", truncate: bool = False, num_rows: int = 20,
                 trigger_seconds: float | None = None) -> StreamingQuery:
    return start_stream(df, "console", mode=mode, trigger_seconds=trigger_seconds,
                        options={"truncate": str(truncate).lower(), "numRows": str(num_rows)})


def json_sink(df: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    return start_stream(df, "json", path=path, checkpoint=checkpoint, **kw)


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, key_col: str | None = None,
               mode: str = "append", **kw) -> StreamingQuery:
    """Rows as ``key`` + JSON ``value`` records (``key_col=None``: value only)."""
    enc = msg.encode(df, key_col)
    return start_stream(enc, "kafka", mode=mode, checkpoint=checkpoint,
                        options={"kafka.bootstrap.servers": servers, "topic": topic}, **kw)


def kafka_counts_sink(counts: DataFrame, servers: str, topic: str, checkpoint: str,
                      key_col: str = "word", value_col: str = "count", mode: str = "complete",
                      **kw) -> StreamingQuery:
    """Word counts as ``CAST(word AS STRING) key, CAST(count AS STRING) value``."""
    enc = msg.encode_counts(counts, key_col, value_col)
    return start_stream(enc, "kafka", mode=mode, checkpoint=checkpoint,
                        options={"kafka.bootstrap.servers": servers, "topic": topic}, **kw)
