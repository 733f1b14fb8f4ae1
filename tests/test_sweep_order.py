"""Counting joined rows by a sweep, positions of sorted rows, texts that join late."""

import contextlib
import io
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from postlens.operators import aggregates as agg
from postlens.operators import joins as J
from postlens.operators import windows as W
from postlens.operators.order import with_positions
from postlens.plans import catalog

T0 = datetime(2024, 1, 1)


def explained(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("lower,upper", [(0, 60), (0, 0), (5, 17), (-20, 20)])
def test_sweep_counts_equal_the_join(spark, null_safe, lower, upper):
    r = random.Random(lower + upper)
    keys = [None, "a", "b"]
    left = [(r.choice(keys), T0 + timedelta(seconds=r.choice((0.0, 0.000001, 0.5)) + r.randrange(0, 200)) if i % 9 else None, r.choice("xyz"))
            for i in range(150)]
    right = [(r.choice(keys), T0 + timedelta(seconds=r.randrange(-80, 260)) if i % 11 else None) for i in range(90)]
    l = spark.createDataFrame(left, "k string, t timestamp_ntz, d string")
    m = spark.createDataFrame(right, "rk string, rt timestamp_ntz")
    ours = W.interval_pair_counts(l, m, left_key="k", right_key="rk", left_time="t", right_time="rt", lower=lower, upper=upper,
                                  null_safe=null_safe, carry=("d",)).groupBy("t", "d").agg(F.sum("n_rows").alias("n"))
    joined = J.interval_join(l, m, left_key="k", right_key="rk", left_time="t", right_time="rt", lower=lower, upper=upper,
                             how="left", null_safe=null_safe)
    assert rows(ours, "t", "d", "n") == rows(joined.groupBy("t", "d").agg(F.count(F.lit(1)).alias("n")), "t", "d", "n")


def test_sweep_builds_no_pair(spark):
    """No join of posts and media in the plan, and no exchange by key alone: a hot key is cut by time."""
    plan = explained(catalog.REGISTRY["interval_join_window_count"](spark, "/root/testdata/sf0.001"))
    by_key = re.findall(r"hashpartitioning\((_k#[^)]*)\)", plan)
    assert by_key and all("_b#" in x for x in by_key)
    joins = [x for x in plan.splitlines() if "Join" in x and "media_ts" in x]
    assert not joins


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_positions_are_the_sorted_places(spark, n):
    df = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(700)).alias("k"), F.col("id").cast("string").alias("name")).repartition(7)
    got = with_positions(df, [F.asc("k"), F.asc("name")], "place").collect()
    want = sorted((r["k"], r["name"]) for r in df.collect())
    assert [(r["k"], r["name"]) for r in sorted(got, key=lambda r: r["place"])] == want
    assert sorted(r["place"] for r in got) == list(range(1, n + 1))


def test_texts_join_late_and_once(spark):
    posts = spark.createDataFrame(
        [("1", "t", "u1", ["m1", "m2"]), ("1", "t", "u1", ["m1"]), ("2", None, "u1", ["m1"]), (None, "t", "u2", ["m9"]), (None, None, None, ["m2"]),
         ("3", "x", "u3", []), ("4", "y", "u3", None), ("1", "other", "u1", ["m1"])],
        "tweet_id string, text string, author_id string, data_media_keys array<string>")
    media = spark.createDataFrame([("m1", "photo"), ("m1", "video"), ("m2", "animated_gif"), ("m8", "photo")], "media_key string, media_type string")
    users = spark.createDataFrame([("u1", "ann"), ("u1", "ann2"), ("u7", "zoe"), (None, "nul")], "users_id string, username string")
    by = ("tweet_id", "username", "text")
    got = agg.media_counts(posts, media, users, by=by)
    full = (posts.select("tweet_id", "text", "author_id", F.explode("data_media_keys").alias("media_key"))
            .join(media, "media_key", "full_outer").join(users, F.col("author_id") == F.col("users_id"), "full_outer"))
    want = full.groupBy(*by).agg(*[F.count_if(F.col("media_type") == t).alias(c) for t, c in agg.MEDIA_TYPE_COLUMNS])
    cols = (*by, "photo_count", "video_count", "gif_count")
    assert rows(got, *cols) == rows(want, *cols)


def test_text_is_no_key_of_an_exchange(spark):
    plan = explained(catalog.REGISTRY["media_counts_by_post_user"](spark, "/root/testdata/sf0.001"))
    exchanges = [x for x in plan.splitlines() if x.startswith("Arguments: hashpartitioning")]
    assert exchanges and not any("text" in x for x in exchanges)
