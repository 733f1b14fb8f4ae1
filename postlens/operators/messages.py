"""JSON messages: Kafka-record decode, permissive parse, and encode.

Parsing is PERMISSIVE ``from_json``: a malformed or null message stays a row
whose parsed columns are null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import JSON_WRITE_OPTIONS, MEDIA_JSON, METRIC_NAMES, POST_JSON, USER_JSON


def decode_records(records: DataFrame, with_time: bool = True) -> DataFrame:
    """``CAST(key AS STRING)``, ``CAST(value AS STRING)`` (+ the record timestamp)."""
    cols = [F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")]
    if with_time:
        cols.append(F.col("timestamp").cast("timestamp").alias("timestamp"))
    return records.select(*cols)


def parse_posts(decoded: DataFrame, time_alias: str | None = "dataTimestamp") -> DataFrame:
    """Post messages -> the 9 post columns (+ record time as ``time_alias``)."""
    d = F.col("d")
    cols = [
        d["id"].alias("tweet_id"),
        d["created_at"].alias("created_at"),
        d["text"].alias("text"),
        *[d["public_metrics"][m].cast("int").alias(m) for m in METRIC_NAMES],
        d["author_id"].alias("author_id"),
        d["attachments"]["media_keys"].alias("data_media_keys"),
    ]
    if time_alias and "timestamp" in decoded.columns:
        cols.append(F.col("timestamp").alias(time_alias))
    return decoded.select(F.from_json("value", POST_JSON).alias("d"), *(
        ["timestamp"] if "timestamp" in decoded.columns else [])).select(*cols)


def parse_users(decoded: DataFrame, time_alias: str | None = "userTimestamp") -> DataFrame:
    u = F.col("u")
    cols = [u["username"].alias("username"), u["description"].alias("description"),
            u["id"].alias("users_id"), u["name"].alias("name")]
    if time_alias and "timestamp" in decoded.columns:
        cols.append(F.col("timestamp").alias(time_alias))
    return decoded.select(F.from_json("value", USER_JSON).alias("u"), *(
        ["timestamp"] if "timestamp" in decoded.columns else [])).select(*cols)


def parse_media(decoded: DataFrame, time_alias: str | None = "mediaTimestamp") -> DataFrame:
    m = F.col("m")
    cols = [m["media_key"].alias("media_key"), m["type"].alias("media_type")]
    if time_alias and "timestamp" in decoded.columns:
        cols.append(F.col("timestamp").alias(time_alias))
    return decoded.select(F.from_json("value", MEDIA_JSON).alias("m"), *(
        ["timestamp"] if "timestamp" in decoded.columns else [])).select(*cols)


def encode(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """``CAST(key_col AS STRING) AS key, to_json(struct(*)) AS value``.

    Without ``key_col`` only ``value`` is produced.  Nulls are omitted from
    the JSON; timestamps keep microseconds.
    """
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_WRITE_OPTIONS).alias("value")
    if key_col is None:
        return df.select(value)
    return df.select(F.col(key_col).cast("string").alias("key"), value)


def encode_counts(counts: DataFrame, key_col: str = "word", value_col: str = "count") -> DataFrame:
    """``CAST(word AS STRING) key, CAST(count AS STRING) value``."""
    return counts.select(F.col(key_col).cast("string").alias("key"),
                         F.col(value_col).cast("string").alias("value"))


def decode_json(encoded: DataFrame, schema, keep_key: bool = True) -> DataFrame:
    """Parse an encoded ``value`` back into columns (inverse of :func:`encode`)."""
    cols = (["key"] if keep_key and "key" in encoded.columns else [])
    return (encoded.select(*cols, F.from_json("value", schema).alias("_v"))
            .select(*cols, "_v.*"))


# -- Kafka-shaped records built from flat tables (fixtures and replays) ------

def _records(df: DataFrame, key: F.Column | None, value: F.Column, ts: F.Column, topic: str,
             partitions: int = 8) -> DataFrame:
    key_bin = key.cast("binary") if key is not None else F.lit(None).cast("binary")
    return df.select(
        key_bin.alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.pmod(F.xxhash64(key if key is not None else value), F.lit(partitions))).cast("int").alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        ts.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def post_records(posts: DataFrame, topic: str = "posts", time_col: str = "created_at",
                 created: F.Column | None = None) -> DataFrame:
    """Posts -> records with the nested post JSON as value, keyed by id.

    ``created`` replaces the post time inside the JSON (e.g. by a text in
    another form).
    """
    value = F.to_json(F.struct(
        F.struct(*[F.col(m) for m in METRIC_NAMES]).alias("public_metrics"),
        F.col("author_id"),
        F.struct(F.col("data_media_keys").alias("media_keys")).alias("attachments"),
        F.col("tweet_id").alias("id"),
        (F.col("created_at").cast("timestamp") if created is None else created).alias("created_at"),
        F.col("text"),
    ), JSON_WRITE_OPTIONS)
    return _records(posts, F.col("tweet_id"), value, F.col(time_col), topic)


def user_records(users: DataFrame, topic: str = "users", time_col: str = "user_ts") -> DataFrame:
    value = F.to_json(F.struct(F.col("description"), F.col("username"), F.col("name"),
                               F.col("users_id").alias("id")), JSON_WRITE_OPTIONS)
    return _records(users, F.col("users_id"), value, F.col(time_col), topic)


def media_records(media: DataFrame, topic: str = "media", time_col: str = "media_ts") -> DataFrame:
    value = F.to_json(F.struct(F.col("media_key"), F.col("media_type").alias("type")), JSON_WRITE_OPTIONS)
    return _records(media, None, value, F.col(time_col), topic)
