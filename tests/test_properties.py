"""Property checks (hypothesis) of the join forms against Spark's plain joins."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from postlens.functions.time import seconds
from postlens.operators import joins as J

KEY = st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))
SIDE = st.lists(st.tuples(KEY, st.integers(min_value=0, max_value=400)), min_size=0, max_size=25)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
T0 = datetime(2024, 1, 1)


def _frames(spark, left, right):
    l = spark.createDataFrame([(f"l{i}", k, T0 + timedelta(seconds=s)) for i, (k, s) in enumerate(left)],
                              "lid string, lk string, lt timestamp_ntz")
    r = spark.createDataFrame([(f"r{i}", k, T0 + timedelta(seconds=s)) for i, (k, s) in enumerate(right)],
                              "rid string, rk string, rt timestamp_ntz")
    return l, r


@SETTINGS
@given(left=SIDE, right=SIDE)
def test_full_outer_join_properties(spark, left, right):
    l, r = _frames(spark, left, right)
    ours = J.full_outer_join(l, r, "lk", "rk")
    got = rows(ours, "lid", "rid")
    assert got == rows(l.join(r, l.lk == r.rk, "full_outer"), "lid", "rid")
    assert len(got) >= max(len(left), len(right))          # full outer keeps every row of both sides


@SETTINGS
@given(left=SIDE, right=SIDE, null_safe=st.booleans(), how=st.sampled_from(["inner", "left", "right", "full"]),
       upper=st.integers(min_value=0, max_value=90))
def test_interval_join_properties(spark, left, right, null_safe, how, upper):
    l, r = _frames(spark, left, right)
    out = J.interval_join(l, r, left_key="lk", right_key="rk", left_time="lt", right_time="rt",
                          lower=0, upper=upper, how=how, null_safe=null_safe)
    key = l.lk.eqNullSafe(r.rk) if null_safe else (l.lk == r.rk)
    cond = key & (l.lt >= r.rt + seconds(0)) & (l.lt <= r.rt + seconds(upper))
    kind = {"full": "full_outer", "left": "left_outer", "right": "right_outer", "inner": "inner"}[how]
    assert rows(out, "lid", "rid") == rows(l.join(r, cond, kind), "lid", "rid")


KEYS = st.lists(st.one_of(st.none(), st.sampled_from(["m1", "m2", "m3"])), max_size=3)
POSTS = st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3", None]), st.one_of(st.none(), KEYS),
                           st.one_of(st.none(), st.integers(0, 9))), max_size=12)
MEDIA = st.lists(st.tuples(st.sampled_from(["m1", "m2", "m4"]),
                           st.sampled_from(["photo", "video", "animated_gif", "other"])), max_size=6)
USERS = st.lists(st.tuples(st.sampled_from(["u1", "u2", "u5"]), st.sampled_from(["ann", "bob", None])),
                 max_size=5)


def _mart_frames(spark, posts, media, users):
    from pyspark.sql import functions as F
    p = spark.createDataFrame([(f"p{i}", a, k, v) for i, (a, k, v) in enumerate(posts)],
                              "tweet_id string, author_id string, data_media_keys array<string>, like_count int")
    for m in ("retweet_count", "reply_count", "quote_count"):
        p = p.withColumn(m, F.col("like_count"))
    m = spark.createDataFrame(media, "media_key string, media_type string")
    u = spark.createDataFrame(users, "users_id string, username string")
    return p, m, u


@SETTINGS
@given(posts=POSTS, media=MEDIA, users=USERS)
def test_pre_aggregated_marts_equal_row_level_joins(spark, posts, media, users):
    """Counting before joining gives the row-level full-outer-join answer,
    fan-out (duplicate media and users) and orphans included."""
    from pyspark.sql import functions as F
    from postlens.operators import aggregates as agg
    p, m, u = _mart_frames(spark, posts, media, users)
    ex = p.select("tweet_id", "author_id", F.explode("data_media_keys").alias("media_key"))
    pm = ex.join(m, "media_key", "full_outer")
    pmu = pm.join(u, pm.author_id == u.users_id, "full_outer")
    counts = [F.count(F.when(F.col("media_type") == t, 1)).alias(c)
              for t, c in (("photo", "photo_count"), ("video", "video_count"), ("animated_gif", "gif_count"))]
    assert rows(agg.media_counts(p, m, by=("tweet_id",))) == rows(pm.groupBy("tweet_id").agg(*counts))
    assert rows(agg.media_counts(p, m, u, by=("username",))) == rows(pmu.groupBy("username").agg(*counts))
    pu = p.join(u, p.author_id == u.users_id, "full_outer")
    sums = [F.sum(c).cast("bigint").alias(f"sum_{c}")
            for c in ("retweet_count", "reply_count", "like_count", "quote_count")]
    assert rows(agg.interaction_totals(p, u)) == rows(pu.groupBy("author_id", "username").agg(*sums))


TEXTS = st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3", None]),
                           st.one_of(st.none(), st.sampled_from(["the cat", "abide", "licence", "Bide", "x"]))),
                 max_size=12)


@SETTINGS
@given(posts=TEXTS, users=USERS)
def test_topic_mentions_equal_filter_after_full_outer(spark, posts, users):
    from pyspark.sql import functions as F
    from postlens.operators import aggregates as agg
    p = spark.createDataFrame(posts, "author_id string, text string")
    u = spark.createDataFrame(users, "users_id string, username string")
    for pattern in ("(?i)biden?", "(?i)licen[cs]e?", "(?i)the"):
        naive = (p.join(u, p.author_id == u.users_id, "full_outer").where(F.col("text").rlike(pattern))
                 .groupBy("username").agg(F.count(F.lit(1)).alias("count")))
        assert rows(agg.topic_mentions(p, u, pattern)) == rows(naive)
