"""Permissive JSON parse, encode round trip, record decode, envelopes."""

from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from fixtures import frames
from postlens.operators import flatten as fl
from postlens.operators import messages as msg
from postlens.sources.envelopes import build_envelopes, read_envelopes, write_envelopes

GOOD = ('{"public_metrics": {"retweet_count": 1, "reply_count": 2, "like_count": 3, "quote_count": 4},'
        ' "author_id": "u1", "attachments": {"media_keys": ["m1", null]}, "id": "p1",'
        ' "created_at": "2024-01-01T00:00:10.000000Z", "text": "hi"}')


def _decoded(spark, values):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "key string, value string")


FORMS = ["2022-05-01T12:00:00Z", "2022-05-01T12:00:00+02:00", "2022-05-01 12:00:00", "2022-05-01",
         "2022-05-01T12:00:00.123456789Z", "2022-05-01T12:00:00.123456", "2022-05-01T12:00:00.000Z"]


def test_times_are_read_as_plain_from_json_reads_them(spark):
    from pyspark.sql import functions as F

    from postlens.schemas import POST_JSON
    df = _decoded(spark, ['{"id": "p%d", "created_at": "%s"}' % x for x in enumerate(FORMS)])
    got = [r.created_at for r in msg.parse_posts(df).orderBy("tweet_id").collect()]
    want = df.select(F.from_json("value", POST_JSON).alias("d")).orderBy("d.id").select("d.created_at").collect()
    assert got == [r[0] for r in want] and None not in got


def test_parse_posts_is_permissive(spark):
    values = [
        GOOD,
        "not json",
        None,
        '{"public_metrics": {"like_count": "7"}, "id": "p2"}',
        '{"public_metrics": {"like_count": 99999999999}, "id": "p3"}',
        '{"created_at": "yesterday", "id": "p4"}',
        '{"id": 5}',
    ]
    out = msg.parse_posts(_decoded(spark, values)).collect()
    assert len(out) == len(values)
    good = out[0]
    assert good.tweet_id == "p1" and good.like_count == 3 and good.data_media_keys == ["m1", None]
    assert good.created_at == datetime(2024, 1, 1, 0, 0, 10)
    assert all(v is None for v in out[1])            # malformed -> all null
    assert all(v is None for v in out[2])            # null message -> all null
    assert out[3].like_count is None                 # string in int field
    assert out[4].like_count is None                 # out of range
    assert out[5].created_at is None                 # bad timestamp
    assert out[6].tweet_id == "5"                    # numeric id read as string


def test_encode_round_trip_and_nulls_omitted(spark):
    posts, users, media = frames(spark)
    enc = msg.encode(posts, "tweet_id")
    first = enc.where(F.col("key") == "p3").first()
    assert '"text"' not in first.value and '"like_count"' not in first.value
    back = msg.decode_json(enc, posts.schema)
    assert rows(back.drop("key")) == rows(posts)
    value_only = msg.encode(media)
    assert value_only.columns == ["value"]


def test_encode_counts(spark):
    df = spark.createDataFrame([("a", 3)], "word string, count bigint")
    assert msg.encode_counts(df).collect()[0].asDict() == {"key": "a", "value": "3"}


def test_records_decode_and_parse(spark):
    posts, users, media = frames(spark)
    rec = msg.post_records(posts)
    assert [f.name for f in rec.schema.fields] == ["key", "value", "topic", "partition", "offset",
                                                    "timestamp", "timestampType"]
    parsed = msg.parse_posts(msg.decode_records(rec))
    assert "dataTimestamp" in parsed.columns
    assert rows(parsed, "tweet_id", "author_id") == rows(posts, "tweet_id", "author_id")


def test_envelopes_round_trip(spark, scratch):
    posts, users, media = frames(spark)
    posts = posts.withColumn("tweet_id", F.regexp_replace("tweet_id", "p", ""))
    env = build_envelopes(posts, users.distinct(), media.withColumn(
        "media_key", F.regexp_replace("media_key", "x", "m")), posts_per_envelope=2)
    for fmt in ("parquet", "json"):
        path = scratch("env")
        write_envelopes(env, path, fmt)
        back = read_envelopes(spark, path, fmt)
        flat = fl.flatten_posts(back)
        assert flat.count() == 4
        assert fl.flatten_media(back).count() == 4          # duplicates kept
        assert fl.flatten_users(back).count() == 3          # u1, u2 (twice, two descriptions)
