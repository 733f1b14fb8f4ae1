"""Hand-written golden rows: nulls, empty arrays, orphans, fan-out,
punctuation-only words and unknown authors."""

from datetime import datetime, timedelta

from pyspark.sql.types import (ArrayType, IntegerType, StringType, StructField, StructType,
                               TimestampNTZType)

POSTS_SCHEMA = StructType([
    StructField("tweet_id", StringType()), StructField("created_at", TimestampNTZType()),
    StructField("text", StringType()), StructField("retweet_count", IntegerType()),
    StructField("reply_count", IntegerType()), StructField("like_count", IntegerType()),
    StructField("quote_count", IntegerType()), StructField("author_id", StringType()),
    StructField("data_media_keys", ArrayType(StringType())),
])


def t(sec):
    return datetime(2024, 1, 1) + timedelta(seconds=sec)


POSTS = [
    ("p1", t(10), "I abide THE law (today)", 1, 0, 5, 0, "u1", ["m1", "m2"]),
    ("p2", t(20), "Trump ... Biden", 2, 1, 7, 0, "u1", None),
    ("p3", t(30), None, 0, 0, None, 0, "u9", []),
    ("p4", t(40), "a  b @ .", 3, 0, 1, 1, "u2", ["x9"]),
]

USERS = [
    ("alice", "d1", "u1", "ALICE"),
    ("alice", "d1", "u1", "ALICE"),
    ("bob", "d2", "u2", "BOB"),
    ("carol", "d3", "u3", "CAROL"),
    ("bob", "other", "u2", "BOB"),
]

MEDIA = [("m1", "photo"), ("m2", "video"), ("m3", "animated_gif"), ("m1", "photo")]


def frames(spark):
    posts = spark.createDataFrame(POSTS, POSTS_SCHEMA)
    users = spark.createDataFrame(USERS, "username string, description string, users_id string, name string")
    media = spark.createDataFrame(MEDIA, "media_key string, media_type string")
    return posts, users, media
