"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Results avoid array columns (arrays are joined with ","), keep timestamps
as TIMESTAMP_NTZ (wall clock, zone-free) and alias every computed column,
so they compare cleanly with a SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..functions.text import STOP_WORDS, TOPIC_A, TOPIC_B, word_pattern
from ..operators import aggregates as agg
from ..operators import flatten as fl
from ..operators import joins as J
from ..operators import messages as msg
from ..operators import windows as W
from ..operators import words as WD
from ..session import work_dir
from ..sources.envelopes import build_envelopes, read_envelopes, write_envelopes
from ..sources.tables import Tables

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}

# Fixed values used by the filter queries.
LITERAL_COLUMN = ("acuWeather", "19071682")
FILTER_USERNAME = "Customer#000000007"
INTERVAL_SECONDS = 60          # data time within [media time, media time + 1 minute]


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def ntz(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP column to TIMESTAMP_NTZ (same wall clock in the session zone)."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


def keys_text(col: str = "data_media_keys", alias: str = "media_keys") -> F.Column:
    return F.array_join(col, ",").alias(alias)


def _posts_flat(df: DataFrame) -> DataFrame:
    return df.select(*[keys_text() if c == "data_media_keys" else F.col(c) for c in df.columns])


def _envelopes(spark: SparkSession, t: Tables) -> DataFrame:
    """Pack the tables into envelopes, write them to the shared folder and
    scan them with the declared envelope schema."""
    path = work_dir(spark, "envelopes")
    write_envelopes(build_envelopes(t.posts, t.users, t.media), path, "parquet")
    return read_envelopes(spark, path, "parquet")


def _size(c: str) -> F.Column:
    return F.when(F.col(c).isNull(), 0).otherwise(F.size(c)).cast("bigint")


# -- sources, profile -------------------------------------------------------

@query("envelope_scan")
def envelope_scan(spark, sf):
    env = _envelopes(spark, Tables(spark, sf))
    return env.select(
        F.array_min("data.id").alias("first_post_id"),
        F.array_min("includes.media.media_key").alias("first_media_key"),
        _size("data.id").alias("n_posts"),
        _size("includes.media.media_key").alias("n_media"),
        _size("includes.users.id").alias("n_users"))


@query("kafka_decode")
def kafka_decode(spark, sf):
    t = Tables(spark, sf)
    dec = msg.decode_records(msg.post_records(t.posts))
    return ntz(dec.select("key", F.col("timestamp").alias("record_ts"),
                          F.get_json_object("value", "$.id").alias("value_id"),
                          F.get_json_object("value", "$.author_id").alias("value_author_id")))


@query("table_profile")
def table_profile(spark, sf):
    t = Tables(spark, sf)
    parts = [(n, getattr(t, n)) for n in ("posts", "users", "media", "media_messages", "user_messages")]
    out = None
    for name, df in parts:
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"))
        out = row if out is None else out.unionByName(row)
    return out


# -- encode ------------------------------------------------------------------

@query("kafka_encode_posts")
def kafka_encode_posts(spark, sf):
    posts = Tables(spark, sf).posts
    enc = msg.encode(posts, "tweet_id")
    return _posts_flat(msg.decode_json(enc, posts.schema))


@query("kafka_encode_users")
def kafka_encode_users(spark, sf):
    users = Tables(spark, sf).users
    return msg.decode_json(msg.encode(users, "users_id"), users.schema)


@query("kafka_encode_media")
def kafka_encode_media(spark, sf):
    media = Tables(spark, sf).media
    return msg.decode_json(msg.encode(media), media.schema)


@query("kafka_encode_word_counts")
def kafka_encode_word_counts(spark, sf):
    counts = WD.word_frequency(WD.clean_words(Tables(spark, sf).posts))
    enc = msg.encode_counts(counts)
    return enc.select(F.col("key").alias("word"), F.col("value").cast("bigint").alias("count"))


# -- flatten, parse ------------------------------------------------------------

@query("flatten_posts")
def flatten_posts(spark, sf):
    env = _envelopes(spark, Tables(spark, sf))
    return ntz(_posts_flat(fl.flatten_posts(env)))


@query("flatten_media")
def flatten_media(spark, sf):
    return fl.flatten_media(_envelopes(spark, Tables(spark, sf)))


@query("flatten_users")
def flatten_users(spark, sf):
    return fl.flatten_users(_envelopes(spark, Tables(spark, sf)))


@query("parse_posts_json")
def parse_posts_json(spark, sf):
    t = Tables(spark, sf)
    parsed = msg.parse_posts(msg.decode_records(msg.post_records(t.posts)))
    return ntz(_posts_flat(parsed))


@query("parse_posts_json_times")
def parse_posts_json_times(spark, sf):
    """Posts whose JSON writes the time in seven ISO forms, by post id."""
    posts = Tables(spark, sf).posts
    at = F.col("created_at")
    forms = ["yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss'+02:00'",
             "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'000Z'", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"]
    kind = F.col("tweet_id").cast("bigint") % len(forms)
    text = F.date_format(at, forms[0])
    for i, form in enumerate(forms[1:], start=1):
        shown = at + F.expr("INTERVAL 2 HOURS") if "+02:00" in form else at
        text = F.when(kind == i, F.date_format(shown, form)).otherwise(text)
    parsed = msg.parse_posts(msg.decode_records(msg.post_records(posts, created=text)), time_alias=None)
    return ntz(parsed.select("tweet_id", "created_at"))


@query("parse_users_json")
def parse_users_json(spark, sf):
    t = Tables(spark, sf)
    return ntz(msg.parse_users(msg.decode_records(msg.user_records(t.user_messages))))


@query("parse_media_json")
def parse_media_json(spark, sf):
    t = Tables(spark, sf)
    return ntz(msg.parse_media(msg.decode_records(msg.media_records(t.media_messages))))


@query("explode_media_inner")
def explode_media_inner(spark, sf):
    return fl.explode_media(Tables(spark, sf).posts, outer=False, keep=("tweet_id", "data_media_keys"))


@query("explode_media_outer")
def explode_media_outer(spark, sf):
    return fl.explode_media(Tables(spark, sf).posts, outer=True, keep=("tweet_id", "data_media_keys"))


@query("cast_posts")
def cast_posts(spark, sf):
    """String -> timestamp / int with ``try_cast`` (bad text becomes null)."""
    p = Tables(spark, sf).posts
    s = p.select("tweet_id", F.col("created_at").cast("string").alias("created_at_s"),
                 *[F.col(m).cast("string").alias(m + "_s") for m in ("retweet_count", "like_count")],
                 F.concat(F.col("tweet_id"), F.lit("x")).alias("bad_s"))
    return s.select("tweet_id",
                    F.col("created_at_s").try_cast("timestamp_ntz").alias("created_at"),
                    F.col("retweet_count_s").try_cast("int").alias("retweet_count"),
                    F.col("like_count_s").try_cast("int").alias("like_count"),
                    F.col("bad_s").try_cast("int").alias("bad_int"))


@query("all_columns")
def all_columns(spark, sf):
    t = Tables(spark, sf)
    exploded = fl.explode_media(t.posts, outer=False, keep=(
        "tweet_id", "author_id", "created_at", "text", "retweet_count", "reply_count", "like_count",
        "quote_count", "data_media_keys"))
    pmu = J.join_media_users_full(exploded, t.media, t.users)
    return pmu.select("tweet_id", "created_at", "username", "text", "retweet_count", "reply_count",
                      "like_count", "quote_count", "media_key", "media_type", "author_id", "name",
                      "description")


@query("literal_column")
def literal_column(spark, sf):
    name, value = LITERAL_COLUMN
    return Tables(spark, sf).posts.select("text", "like_count", "author_id").withColumn(name, F.lit(value))


@query("posts_with_date")
def posts_with_date(spark, sf):
    return Tables(spark, sf).posts.select("tweet_id", "created_at",
                                          F.to_date("created_at", "yyyy-MM-dd").alias("created_date"))


# -- filters -------------------------------------------------------------------

@query("topic_mentions_a")
def topic_mentions_a(spark, sf):
    t = Tables(spark, sf)
    return agg.topic_mentions(t.posts, t.users, TOPIC_A)


@query("topic_mentions_b")
def topic_mentions_b(spark, sf):
    t = Tables(spark, sf)
    return agg.topic_mentions(t.posts, t.users, TOPIC_B)


@query("topic_mentions_word_bounded")
def topic_mentions_word_bounded(spark, sf):
    t = Tables(spark, sf)
    return agg.topic_mentions(t.posts, t.users, word_pattern("the"))


@query("stopword_filter")
def stopword_filter(spark, sf):
    return WD.stop_word_split(Tables(spark, sf).posts, stop_words=STOP_WORDS)


@query("filter_equals")
def filter_equals(spark, sf):
    t = Tables(spark, sf)
    # the filter leaves only rows with a user: of the full outer join the users' side remains
    joined = J.equi_join(t.users.where(F.col("username") == FILTER_USERNAME), t.posts, "users_id", "author_id", "left")
    return (joined
            .select("tweet_id", "author_id", "users_id", "username", "like_count"))


@query("null_key_split")
def null_key_split(spark, sf):
    t = Tables(spark, sf)
    exploded = fl.explode_media(t.posts, outer=True, keep=("tweet_id", "data_media_keys"))
    return J.left_join_null_split(exploded, t.media, "media_key").select("tweet_id", "media_key", "media_type")


def _interval(spark, sf, how: str, null_safe: bool, cols=None):
    t = Tables(spark, sf)
    b = fl.explode_media(t.posts, outer=True, keep=("tweet_id", "author_id", "text", "created_at",
                                                    "data_media_keys"))
    c = t.media_messages.withColumnRenamed("media_key", "c_media_key")
    out = J.interval_join(b, c, left_key="media_key", right_key="c_media_key", left_time="created_at",
                          right_time="media_ts", lower=0, upper=INTERVAL_SECONDS, how=how,
                          null_safe=null_safe)
    cols = cols or ("tweet_id", "author_id", "media_key", "c_media_key", "media_type", "created_at", "media_ts")
    return out.select(*cols)


@query("join_null_safe")
def join_null_safe(spark, sf):
    return _interval(spark, sf, "inner", True)


# -- batch joins -------------------------------------------------------------

@query("join_media_full_outer")
def join_media_full_outer(spark, sf):
    t = Tables(spark, sf)
    exploded = fl.explode_media(t.posts, outer=False, keep=("tweet_id", "data_media_keys"))
    return J.join_media(exploded, t.media, "full").select("media_key", "tweet_id", "media_type")


@query("join_users_full_outer")
def join_users_full_outer(spark, sf):
    t = Tables(spark, sf)
    return (J.join_users(t.posts, t.users, "full")
            .select("tweet_id", "created_at", "author_id", "users_id", "username", "name", "like_count"))


@query("join_three_way_full_outer")
def join_three_way_full_outer(spark, sf):
    t = Tables(spark, sf)
    exploded = fl.explode_media(t.posts, outer=False, keep=("tweet_id", "author_id", "data_media_keys"))
    return (J.join_media_users_full(exploded, t.media, t.users)
            .select("tweet_id", "media_key", "media_type", "author_id", "users_id", "username"))


@query("join_media_left_outer")
def join_media_left_outer(spark, sf):
    t = Tables(spark, sf)
    exploded = fl.explode_media(t.posts, outer=True, keep=("tweet_id", "created_at", "data_media_keys"))
    return J.join_media(exploded, t.media, "left").select("tweet_id", "created_at", "media_key", "media_type")


# -- interval joins ------------------------------------------------------------

@query("interval_join_inner")
def interval_join_inner(spark, sf):
    t = Tables(spark, sf)
    b = fl.explode_media(t.posts, outer=True, keep=("tweet_id", "author_id", "created_at", "data_media_keys"))
    bu = b.join(t.users.select("users_id", "username"), F.col("author_id") == F.col("users_id"))
    c = t.media_messages.withColumnRenamed("media_key", "c_media_key")
    out = J.interval_join(bu, c, left_key="media_key", right_key="c_media_key", left_time="created_at",
                          right_time="media_ts", upper=INTERVAL_SECONDS, how="inner")
    return out.select("tweet_id", "author_id", "username", "media_key", "media_type", "created_at", "media_ts")


@query("interval_join_left")
def interval_join_left(spark, sf):
    return _interval(spark, sf, "left", False,
                     ("tweet_id", "author_id", "text", "media_key", "media_type", "created_at", "media_ts"))


@query("interval_join_left_nullsafe")
def interval_join_left_nullsafe(spark, sf):
    return _interval(spark, sf, "left", True,
                     ("tweet_id", "author_id", "text", "media_key", "media_type", "created_at", "media_ts"))


@query("interval_join_right_outer")
def interval_join_right_outer(spark, sf):
    return _interval(spark, sf, "right", False)


@query("interval_join_full_outer")
def interval_join_full_outer(spark, sf):
    return _interval(spark, sf, "full", False)


@query("interval_join_right_x2")
def interval_join_right_x2(spark, sf):
    """users RIGHT OUTER posts (post within 1 min of the user message), then
    that RIGHT OUTER media messages (post within 1 min of the media message)."""
    t = Tables(spark, sf)
    b = fl.explode_media(t.posts, outer=True, keep=("tweet_id", "author_id", "created_at", "data_media_keys"))
    a = t.user_messages.select("users_id", "username", "user_ts")
    ab = J.interval_join(b, a, left_key="author_id", right_key="users_id", left_time="created_at",
                         right_time="user_ts", upper=INTERVAL_SECONDS, how="left")
    c = t.media_messages.withColumnRenamed("media_key", "c_media_key")
    out = J.interval_join(ab, c, left_key="media_key", right_key="c_media_key", left_time="created_at",
                          right_time="media_ts", upper=INTERVAL_SECONDS, how="right")
    return out.select("username", "tweet_id", "created_at", "c_media_key", "media_type", "media_ts")


@query("interval_join_window_count")
def interval_join_window_count(spark, sf):
    """Rows of the null-safe interval join per text and window, by a sweep over times: no pair is built."""
    t = Tables(spark, sf)
    b = fl.explode_media(t.posts, outer=True, keep=("text", "created_at", "data_media_keys"))
    return W.flatten_window(W.interval_text_window_counts(
        b, t.media_messages, left_key="media_key", right_key="media_key", left_time="created_at", right_time="media_ts",
        upper=INTERVAL_SECONDS, null_safe=True, length="20 seconds", slide="5 seconds"))


# -- aggregates ---------------------------------------------------------------

@query("media_counts_by_post")
def media_counts_by_post(spark, sf):
    t = Tables(spark, sf)
    return agg.media_counts(t.posts, t.media, by=("tweet_id",))


@query("media_counts_by_post_user")
def media_counts_by_post_user(spark, sf):
    t = Tables(spark, sf)
    return agg.media_counts(t.posts, t.media, t.users, by=("tweet_id", "username", "text"))


@query("media_counts_by_user")
def media_counts_by_user(spark, sf):
    t = Tables(spark, sf)
    return agg.media_counts(t.posts, t.media, t.users, by=("username",))


@query("media_counts_windowed")
def media_counts_windowed(spark, sf):
    """Per (5-minute window sliding by 2 minutes, username): media-type counts
    of posts joined to media messages by key alone.

    Messages are counted per (key, type) and posts per (key, author, time
    bucket) before they meet: a pair adds the product of the two counts, so
    no pair is built."""
    t = Tables(spark, sf)
    return W.flatten_window(W.windowed_media_counts_by_key(t.posts, t.media_messages, t.users,
                                                           "5 minutes", "2 minutes"))


@query("media_counts_windowed_bounded")
def media_counts_windowed_bounded(spark, sf):
    """Per (5-minute window sliding by 2 minutes, username): media-type counts
    of posts joined to media messages of the minute before them.  Rows
    without a post time fall out of every window, so the outer joins of the
    original reduce to left joins from the posts."""
    t = Tables(spark, sf)
    b = fl.explode_media(t.posts, outer=True, keep=("tweet_id", "author_id", "created_at", "data_media_keys"))
    c = t.media_messages.withColumnRenamed("media_key", "c_media_key")
    bc = J.interval_join(b, c, left_key="media_key", right_key="c_media_key", left_time="created_at",
                         right_time="media_ts", upper=INTERVAL_SECONDS, how="left")
    bcu = bc.join(t.users.select("users_id", "username"), F.col("author_id") == F.col("users_id"), "left")
    out = W.windowed_media_counts(bcu, "created_at", ("username",), "5 minutes", "2 minutes")
    return W.flatten_window(out)


@query("interaction_totals")
def interaction_totals(spark, sf):
    t = Tables(spark, sf)
    return agg.interaction_totals(t.posts, t.users)


@query("likes_by_author")
def likes_by_author(spark, sf):
    out = agg.likes_by_author(Tables(spark, sf).posts)
    return out.withColumn("avg_like_count", F.round("avg_like_count", 6))


@query("likes_total")
def likes_total(spark, sf):
    return agg.likes_total(Tables(spark, sf).posts)


# -- order -----------------------------------------------------------------------

@query("posts_by_time")
def posts_by_time(spark, sf):
    """The order itself is part of the result: position 1 is the earliest row."""
    t = Tables(spark, sf)
    return agg.posts_by_time_numbered(J.join_users(t.posts, t.users, "full"))


@query("posts_per_day")
def posts_per_day(spark, sf):
    return agg.posts_per_day(Tables(spark, sf).posts)


@query("top_words")
def top_words(spark, sf):
    return WD.top_words(WD.clean_words(Tables(spark, sf).posts), 10)


# -- text ---------------------------------------------------------------------------

@query("word_tokens_clean")
def word_tokens_clean(spark, sf):
    return WD.tokens_per_post(Tables(spark, sf).posts, clean=True)


@query("word_tokens_raw")
def word_tokens_raw(spark, sf):
    return WD.tokens_per_post(Tables(spark, sf).posts, clean=False)


@query("word_frequency")
def word_frequency(spark, sf):
    return WD.word_frequency(WD.clean_words(Tables(spark, sf).posts))


@query("word_count_per_media_rows")
def word_count_per_media_rows(spark, sf):
    """The streaming word count's row set when media keys are exploded
    first: a post with two media keys counts each of its words twice."""
    p = fl.explode_media(Tables(spark, sf).posts, outer=True, keep=("text", "data_media_keys"))
    return WD.word_frequency(WD.raw_words(p))


# -- windows ---------------------------------------------------------------------------

@query("word_count_sliding")
def word_count_sliding(spark, sf):
    t = Tables(spark, sf)
    return W.flatten_window(W.text_window_counts(t.posts, WD.raw_words, t.post_sizes))


@query("word_count_sliding_clean")
def word_count_sliding_clean(spark, sf):
    t = Tables(spark, sf)
    return W.flatten_window(W.text_window_counts(t.posts, WD.clean_words, t.post_sizes))


@query("word_count_two_level")
def word_count_two_level(spark, sf):
    t = Tables(spark, sf)
    return W.flatten_window(W.text_window_counts(t.posts, WD.clean_words, t.post_sizes,
                                                 length2="1 minute", slide2="30 seconds"))
