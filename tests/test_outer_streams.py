"""The full outer and right outer stream jobs against plain batch joins, with late rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from postlens.functions.time import seconds
from postlens.operators import messages as msg
from postlens.operators import windows as W
from postlens.sources.streams import read_stream
from postlens.streaming import jobs
from postlens.streaming.runner import append_records, run_available_now

T0 = datetime(2024, 1, 1)
POST = ("tweet_id string, created_at timestamp, text string, retweet_count int, reply_count int, like_count int, "
        "quote_count int, author_id string, data_media_keys array<string>")


def posts(spark, items):
    return spark.createDataFrame([(i, T0 + timedelta(seconds=s), None, 0, 0, 0, 0, a, k) for i, s, a, k in items], POST)


def users(spark, items):
    return spark.createDataFrame([(u, "d", "n", name, T0 + timedelta(seconds=s)) for u, name, s in items],
                                 "users_id string, description string, name string, username string, user_ts timestamp")


def media(spark, items):
    return spark.createDataFrame([(k, t, T0 + timedelta(seconds=s)) for k, t, s in items],
                                 "media_key string, media_type string, media_ts timestamp")


# Batches: early rows; rows an hour later, twice (rows are late by the watermark of the batch before); a late post next to
# messages in time; closing rows.  Every side has rows in every batch, so the sides stay in step.
EARLY = dict(posts=[("p1", 100, "u1", ["m1", "m2"]), ("p2", 110, "u2", None), ("p3", 120, "u1", ["m1"]), ("p4", 130, None, ["m4"]),
                    ("p5", 140, "u9", []), ("p1b", 100, "u1", ["m1"]),
                    ("p6", 150, "u9", ["m1"])],
             users=[("u1", "ann", 95), ("u1", "ann", 60), ("u3", "zoe", 90), ("u2", "bob", 10), (None, "nul", 100)],
             media=[("m1", "photo", 80), ("m1", "video", 99), ("m2", "photo", 30), ("m7", "animated_gif", 100), (None, "photo", 100)])
LATER = dict(posts=[("q1", 3700, "u1", ["m1"]), ("q2", 3760, "u5", ["m5"])], users=[("u1", "ann", 3690), ("u5", "eve", 3700)],
             media=[("m1", "photo", 3699), ("m5", "photo", 3760), ("m5", "video", 3761)])
LATER2 = dict(posts=[("r1", 3800, "u2", ["m2"])], users=[("u2", "bob", 3800)], media=[("m2", "photo", 3770)])
LATE = dict(posts=[("late", 125, "u1", ["m1"])], users=[("u8", "lee", 3805)], media=[("m8", "photo", 3805)])
IN_TIME = [EARLY, LATER, LATER2, dict(LATE, posts=[])]
ALL = [EARLY, LATER, LATER2, LATE]
CLOSE = dict(posts=[("close", 9000, "c", ["c"])], users=[("c", "c", 9000)], media=[("c", "photo", 9000)])


def stage(spark, scratch, batches):
    paths = {n: scratch(f"os-{n}") for n in ("posts", "users", "media")}
    make = {"posts": (posts, msg.post_records), "users": (users, msg.user_records), "media": (media, msg.media_records)}
    for b in batches:
        for n, (frame, records) in make.items():
            append_records(records(frame(spark, b[n])).coalesce(1), paths[n])
    return lambda n: msg.decode_records(read_stream(spark, "files", path=paths[n], max_files_per_trigger=1))


def batch_frames(spark, batches):
    p = posts(spark, [x for b in batches for x in b["posts"]])
    p = p.select("tweet_id", "created_at", "author_id", F.explode_outer("data_media_keys").alias("media_key"))
    u = users(spark, [x for b in batches for x in b["users"]])
    m = media(spark, [x for b in batches for x in b["media"]]).withColumnRenamed("media_key", "c_media_key")
    near = lambda t: (F.col("created_at") >= F.col(t)) & (F.col("created_at") <= F.col(t) + seconds(60))
    return p, u, m, (F.col("media_key") == F.col("c_media_key")) & near("media_ts"), (F.col("author_id") == F.col("users_id")) & near("user_ts")


def run(spark, scratch, job):
    out, ck = scratch("oso"), scratch("osc")
    run_available_now(job, out, ck)
    return spark.read.parquet(out)


def test_full_outer_rows_and_counts_equal_batch(spark, scratch):
    src = stage(spark, scratch, [*ALL, CLOSE])
    p, u, m, on_media, on_user = batch_frames(spark, IN_TIME)       # the late post was behind the watermark
    rows_out = run(spark, scratch, jobs.full_outer_job(src("posts"), src("users"), src("media")))
    want = p.join(m, on_media, "full_outer").join(u, on_user, "full_outer").select(
        "tweet_id", F.coalesce("media_key", "c_media_key").alias("media_key"), "media_type", "username")
    got = rows_out.where("coalesce(tweet_id, '') <> 'close' and coalesce(media_key, '') <> 'c' and coalesce(username, '') <> 'c'")
    assert rows(got, "tweet_id", "media_key", "media_type", "username") == rows(want)
    kinds = {(r[0] is None, r[2] is None, r[3] is None) for r in rows(got, "tweet_id", "media_key", "media_type", "username")}
    assert {(True, False, True), (True, True, False), (False, True, True), (False, False, False)} <= kinds

    out = W.flatten_window(run(spark, scratch, jobs.media_counts_full_outer_job(src("posts"), src("users"), src("media"))))
    met = p.join(m, on_media, "full_outer").join(u, on_user, "full_outer")
    counted = W.flatten_window(met.groupBy(F.window("created_at", "5 minutes", "2 minutes").alias("window"), "username").agg(
        *[F.count_if(F.col("media_type") == t).alias(c) for t, c in (("photo", "photo_count"), ("video", "video_count"), ("animated_gif", "gif_count"))]))
    cols = ("window_start", "username", "photo_count", "video_count", "gif_count")
    assert rows(out.where("coalesce(username, '') <> 'c'"), *cols) == rows(counted, *cols)


def test_counts_leave_when_the_watermark_passes(spark, scratch):
    """Without closing rows the windows of the last hour stay in state; those before are out."""
    src = stage(spark, scratch, [EARLY, LATER])
    out = W.flatten_window(run(spark, scratch, jobs.media_counts_full_outer_job(src("posts"), src("users"), src("media"))))
    assert out.count() > 0 and out.agg(F.max("window_end")).first()[0] < T0 + timedelta(seconds=3600)


def test_right_outer_x2_equals_batch(spark, scratch):
    src = stage(spark, scratch, [*ALL, CLOSE])
    p, u, m, on_media, on_user = batch_frames(spark, IN_TIME)
    out = run(spark, scratch, jobs.right_outer_job(src("posts"), src("users"), src("media")))
    got = rows(out.where("coalesce(c_media_key, '') <> 'c'"), "username", "tweet_id", "c_media_key", "media_type")
    want = u.join(p, on_user, "right_outer").join(m, on_media, "right_outer")
    assert got == rows(want, "username", "tweet_id", "c_media_key", "media_type")
    assert any(r[1] is None for r in got)                                   # media that met no post
    assert any(r[1] is not None and r[0] is None for r in got)              # a post that met no user, kept by the first join


@pytest.mark.parametrize("job", ["full_outer_job", "right_outer_job"])
def test_a_late_post_is_not_joined(spark, scratch, job):
    src = stage(spark, scratch, [*ALL, CLOSE])
    out = run(spark, scratch, getattr(jobs, job)(src("posts"), src("users"), src("media")))
    assert out.where("tweet_id = 'late'").count() == 0 and out.where("tweet_id = 'q1'").count() > 0
