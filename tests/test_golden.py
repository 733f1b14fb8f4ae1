"""Operators on hand-written rows (nulls, empty arrays, orphans, fan-out)."""

from pyspark.sql import functions as F

from conftest import rows
from fixtures import frames
from postlens.functions.text import word_pattern
from postlens.operators import aggregates as agg
from postlens.operators import flatten as fl
from postlens.operators import joins as J
from postlens.operators import words as WD


def _users(spark):
    return frames(spark)[1].distinct()


def test_explode_inner_drops_null_and_empty(spark):
    posts, _, _ = frames(spark)
    inner = fl.explode_media(posts, outer=False, keep=("tweet_id", "data_media_keys"))
    assert rows(inner) == [("p1", "m1"), ("p1", "m2"), ("p4", "x9")]


def test_explode_outer_keeps_one_null_row(spark):
    posts, _, _ = frames(spark)
    outer = fl.explode_media(posts, outer=True, keep=("tweet_id", "data_media_keys"))
    assert "data_media_keys" not in outer.columns
    assert rows(outer) == sorted([("p1", "m1"), ("p1", "m2"), ("p2", None), ("p3", None), ("p4", "x9")], key=repr)
    # property: outer = inner + posts without keys
    assert outer.count() == fl.explode_media(posts, outer=False).count() + 2


def test_media_counts_by_post_keeps_orphans_and_fanout(spark):
    posts, _, media = frames(spark)
    out = agg.media_counts(posts, media, by=("tweet_id",))
    assert rows(out) == sorted([("p1", 2, 1, 0), ("p4", 0, 0, 0), (None, 0, 0, 1)], key=repr)


def test_media_counts_by_user(spark):
    posts, _, media = frames(spark)
    out = agg.media_counts(posts, media, _users(spark), by=("username",))
    assert rows(out) == sorted([("alice", 2, 1, 0), ("bob", 0, 0, 0), ("carol", 0, 0, 0), (None, 0, 0, 1)],
                               key=repr)


def test_media_counts_no_orphans_gives_no_null_group(spark):
    posts, _, media = frames(spark)
    used = media.where(F.col("media_key") != "m3")
    out = agg.media_counts(posts, used, by=("tweet_id",))
    assert [r for r in rows(out) if r[0] is None] == []


def test_interaction_totals(spark):
    posts, _, _ = frames(spark)
    out = agg.interaction_totals(posts, _users(spark))
    assert rows(out) == sorted([
        ("u1", "alice", 3, 1, 12, 0),
        ("u9", None, 0, 0, None, 0),
        ("u2", "bob", 6, 0, 2, 2),          # two bob rows for u2: fan-out doubles
        (None, "carol", None, None, None, None),
    ], key=repr)


def test_full_outer_keeps_orphans_both_sides(spark):
    posts, _, media = frames(spark)
    ex = fl.explode_media(posts, outer=False, keep=("tweet_id", "data_media_keys"))
    out = J.join_media(ex, media, "full").select("media_key", "tweet_id", "media_type")
    assert rows(out) == sorted([
        ("m1", "p1", "photo"), ("m1", "p1", "photo"), ("m2", "p1", "video"),
        ("x9", "p4", None), ("m3", None, "animated_gif")], key=repr)


def test_topic_regex_is_substring_match(spark):
    posts, _, _ = frames(spark)
    users = _users(spark)
    assert rows(agg.topic_mentions(posts, users, "(?i)biden?")) == [("alice", 2)]   # "abide" matches
    assert rows(agg.topic_mentions(posts, users, "(?i)trump?")) == [("alice", 1)]
    assert rows(agg.topic_mentions(posts, users, word_pattern("the"))) == [("alice", 1)]
    assert rows(agg.topic_mentions(posts, users, word_pattern("bide"))) == []


def test_clean_words_counts_empty_tokens(spark):
    posts, _, _ = frames(spark)
    out = WD.word_frequency(WD.clean_words(posts))
    assert dict(rows(out)) == {"abide": 1, "law": 1, "today": 1, "trump": 1, "biden": 1, "": 4, "b": 1}


def test_raw_words_keep_case_and_filter_lower(spark):
    posts, _, _ = frames(spark)
    out = WD.word_frequency(WD.raw_words(posts))
    assert dict(rows(out)) == {"abide": 1, "law": 1, "(today)": 1, "Trump": 1, "Biden": 1, "": 1, "b": 1}


def test_top_words_tie_break(spark):
    posts, _, _ = frames(spark)
    out = WD.top_words(WD.clean_words(posts), 3).collect()
    assert [tuple(r) for r in out] == [("", 4), ("abide", 1), ("b", 1)]


def test_latest_users_and_dedupe_media(spark):
    _, users, media = frames(spark)
    assert fl.latest_users(users.distinct()).count() == 3
    assert fl.dedupe_media(media).count() == 3


def test_null_key_split_left_join(spark):
    posts, _, media = frames(spark)
    ex = fl.explode_media(posts, outer=True, keep=("tweet_id", "data_media_keys"))
    out = J.left_join_null_split(ex, media, "media_key")
    native = ex.join(media, "media_key", "left")
    assert rows(out, "tweet_id", "media_key", "media_type") == rows(native, "tweet_id", "media_key", "media_type")


def test_batch_sliding_windows_equal_window_function_in_any_zone(spark):
    """The pre-aggregated batch windows equal ``window()``, also for
    TIMESTAMP_NTZ across a daylight-saving change in the session zone."""
    from datetime import datetime, timedelta
    from postlens.operators import windows as W
    base = datetime(2024, 3, 10, 1, 58, 0)
    data = [(f"w{i % 3}", base + timedelta(seconds=7 * i + 0.25 * (i % 4))) for i in range(60)]
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("America/New_York", "Asia/Kolkata", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            for typ in ("timestamp_ntz", "timestamp"):
                df = spark.createDataFrame(data, f"word string, ts {typ}")
                for length, slide in (("25 seconds", "5 seconds"), ("5 minutes", "2 minutes")):
                    ours = W.flatten_window(W.sliding_agg(df, ("word",), "ts", length, slide,
                                                          {"count": F.count(F.lit(1))}))
                    native = W.flatten_window(df.groupBy("word", F.window("ts", length, slide).alias("window"))
                                              .agg(F.count(F.lit(1)).alias("count")))
                    assert rows(ours, "word", "window_start", "window_end", "count") == \
                        rows(native, "word", "window_start", "window_end", "count"), (tz, typ, length)
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_two_level_in_one_pass_equals_rewindow(spark):
    import random
    from datetime import datetime, timedelta
    from postlens.operators import windows as W
    rnd = random.Random(5)
    data = [(f"w{rnd.randrange(3)}", datetime(2024, 1, 1) + timedelta(seconds=rnd.uniform(0, 600)))
            for _ in range(300)]
    for typ in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame(data, f"word string, ts {typ}")
        for l1, s1, l2, s2 in (("25 seconds", "5 seconds", "1 minute", "30 seconds"),
                               ("5 minutes", "2 minutes", "7 minutes", "3 minutes")):
            first = W.sliding_counts(df, ("word",), "ts", l1, s1)
            two_step = W.flatten_window(W.rewindow(first, ("word",), l2, s2))
            one_pass = W.flatten_window(W.two_level_agg(df, ("word",), "ts", l1, s1, l2, s2,
                                                        {"count": F.count(F.lit(1))}))
            assert rows(one_pass) == rows(two_step), (typ, l1, l2)
