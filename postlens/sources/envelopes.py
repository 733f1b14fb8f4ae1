"""Envelope files (the nested API responses) -- scan, write, and a builder
that packs flat tables into envelopes for fixtures and replays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ENVELOPE, METRIC_NAMES


def read_envelopes(spark: SparkSession, path: str, fmt: str = "avro",
                   options: dict | None = None) -> DataFrame:
    """Scan every envelope file under ``path`` with the declared schema.

    ``fmt`` is any file source: ``avro`` (needs the spark-avro package on the
    classpath), ``parquet``, ``json``, ``orc``.  The explicit schema means no
    inference pass and lets nested-column pruning reach the scan.
    """
    reader = spark.read.format(fmt).schema(ENVELOPE)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


def write_envelopes(envelopes: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    envelopes.write.format(fmt).mode(mode).save(path)


def _envelope_id(numeric_id: F.Column, per_envelope: int) -> F.Column:
    """Whole-number ``id div per_envelope`` for numeric ids; another id gets an
    envelope by its hash (negative numbers), in effect its own."""
    n = numeric_id.try_cast("bigint")
    by_id = (n - F.pmod(n, F.lit(per_envelope))).cast("decimal(38,0)")
    by_hash = F.lit(-1) - F.pmod(F.xxhash64(numeric_id), F.lit(1 << 62)).cast("decimal(38,0)") - F.lit(1 << 62)
    return F.coalesce(by_id, by_hash)


def build_envelopes(posts: DataFrame, users: DataFrame, media: DataFrame,
                    posts_per_envelope: int = 100, media_per_envelope: int = 100) -> DataFrame:
    """Pack flat tables into envelopes of at most ``posts_per_envelope`` posts.

    Each envelope carries its posts (``data``), the distinct users who wrote
    them and a slice of at most ``media_per_envelope`` media items, so every
    collected group is bounded whatever the data size.  Numeric post ids
    (and media keys after their one-letter prefix) pick the envelope.
    """
    post_struct = F.struct(
        F.col("tweet_id").alias("id"),
        F.col("created_at").cast("string").alias("created_at"),
        F.col("text"),
        F.col("author_id"),
        F.struct(*[F.col(m).cast("bigint").alias(m) for m in METRIC_NAMES]).alias("public_metrics"),
        F.struct(F.col("data_media_keys").alias("media_keys")).alias("attachments"),
    )
    keyed = posts.withColumn("env", _envelope_id(F.col("tweet_id"), posts_per_envelope))
    data = keyed.groupBy("env").agg(F.collect_list(post_struct).alias("data"))
    u = (keyed.select("env", "author_id").distinct()
         .join(users, F.col("author_id") == F.col("users_id"))
         .groupBy("env").agg(F.collect_set(F.struct(
             "username", "description", F.col("users_id").alias("id"), "name")).alias("users")))
    m = (media.withColumn("env", _envelope_id(F.substring("media_key", 2, 64), media_per_envelope))
         .groupBy("env").agg(F.collect_list(F.struct(
             "media_key", F.col("media_type").alias("type"))).alias("media")))
    out = data.join(u, "env", "left").join(m, "env", "full")
    return out.select("data", F.struct("media", "users").alias("includes")).to(ENVELOPE)
