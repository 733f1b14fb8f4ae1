"""Stream sources with the Kafka record layout.

``read_stream(kind="kafka")`` subscribes to a topic (needs the
spark-sql-kafka package); ``kind="files"`` reads a folder of files that
carry the same record schema, which is how tests and replays drive the
same jobs without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import KAFKA_RECORD


def read_stream(spark: SparkSession, kind: str = "kafka", *, topic: str | None = None,
                servers: str | None = None, path: str | None = None, fmt: str = "parquet",
                starting_offsets: str = "latest", fail_on_data_loss: bool = True,
                max_files_per_trigger: int | None = None, max_offsets_per_trigger: int | None = None,
                options: dict | None = None) -> DataFrame:
    """A record stream.  ``max_offsets_per_trigger`` (Kafka) and
    ``max_files_per_trigger`` (files) bound each micro-batch, so a backlog
    is consumed in batches of a known size instead of one huge batch."""
    reader = spark.readStream
    if kind == "kafka":
        if not (topic and servers):
            raise ValueError("kafka source needs topic and servers")
        reader = (reader.format("kafka")
                  .option("kafka.bootstrap.servers", servers)
                  .option("subscribe", topic)
                  .option("startingOffsets", starting_offsets)
                  # a reader option: on the writer it has no effect
                  .option("failOnDataLoss", str(bool(fail_on_data_loss)).lower()))
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    elif kind == "files":
        if not path:
            raise ValueError("file source needs path")
        reader = reader.format(fmt).schema(KAFKA_RECORD)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    else:
        raise ValueError(f"unknown stream kind {kind!r}")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path) if kind == "files" else reader.load()
