"""All declared schemas, in one place.

ENVELOPE   nested API response: ``data`` posts plus ``includes`` media/users
POST_JSON  one post message as JSON (stream)
USER_JSON  one user message as JSON (stream)
MEDIA_JSON one media message as JSON (stream)
KAFKA_RECORD  the record layout of the Kafka source
"""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


METRIC_NAMES = ("retweet_count", "reply_count", "like_count", "quote_count")

ENVELOPE = _struct(
    ("data", ArrayType(_struct(
        ("id", StringType()),
        ("created_at", StringType()),
        ("text", StringType()),
        ("author_id", StringType()),
        ("public_metrics", _struct(*[(m, LongType()) for m in METRIC_NAMES])),
        ("attachments", _struct(("media_keys", ArrayType(StringType(), True)))),
    ), True)),
    ("includes", _struct(
        ("media", ArrayType(_struct(("media_key", StringType()), ("type", StringType())), True)),
        ("users", ArrayType(_struct(
            ("username", StringType()),
            ("description", StringType()),
            ("id", StringType()),
            ("name", StringType()),
        ), True)),
    )),
)

POST_JSON = _struct(
    ("public_metrics", _struct(*[(m, IntegerType()) for m in METRIC_NAMES])),
    ("author_id", StringType()),
    ("attachments", _struct(("media_keys", ArrayType(StringType(), True)))),
    ("id", StringType()),
    ("created_at", TimestampType()),
    ("text", StringType()),
)

USER_JSON = _struct(
    ("description", StringType()),
    ("username", StringType()),
    ("name", StringType()),
    ("id", StringType()),
)

MEDIA_JSON = _struct(
    ("media_key", StringType()),
    ("type", StringType()),
)

KAFKA_RECORD = _struct(
    ("key", BinaryType()),
    ("value", BinaryType()),
    ("topic", StringType()),
    ("partition", IntegerType()),
    ("offset", LongType()),
    ("timestamp", TimestampType()),
    ("timestampType", IntegerType()),
)

# Column layout of the flattened tables every operator consumes.
POST_COLUMNS = ("tweet_id", "created_at", "text", *METRIC_NAMES, "author_id", "data_media_keys")
USER_COLUMNS = ("username", "description", "users_id", "name")
MEDIA_COLUMNS = ("media_key", "media_type")

# Written timestamps keep microseconds (the JSON default stops at millis).
# Reading uses no pattern: Spark's own parser takes every ISO form.
JSON_WRITE_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
                "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
