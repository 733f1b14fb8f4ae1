"""Streaming jobs over Kafka-shaped record streams.

Library functions take *decoded* record streams (``key``, ``value``,
``timestamp``) and return streaming DataFrames; start them with a sink
from :mod:`postlens.streaming.sinks`.  The ``stream_*`` entries of the
query registry replay the test tables through these jobs with
``availableNow`` and return the written result as a batch DataFrame.

Guards the library adds to the original jobs: watermark set *before* a
stream distinct where one is asked for, TIMESTAMP_NTZ cast to
TIMESTAMP before ``withWatermark``, ``IS NOT NULL`` on both keys of an
``=`` outer interval join, and an optional time bound for the users join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import flatten as fl
from ..operators import joins as J
from ..operators import messages as msg
from ..operators import windows as W
from ..operators import words as WD
from ..plans.catalog import INTERVAL_SECONDS, ntz, query
from ..session import drop_dir, work_dir
from ..sources.streams import read_stream
from ..sources.tables import Tables, table
from .results import ResultTable
from .seen import DistinctTable
from .runner import KEPT_STATE, max_time, run_available_now, stage_records, time_cuts

WATERMARK = "30 seconds"
CLOSE = "__close"
#: Micro-batches of data that a replay of the test tables is cut into.
REPLAY_BATCHES = 5
#: Posts of a micro-batch at most, where state is evicted by the watermark: what it holds does not grow with the input.
BATCH_POSTS = 1_500_000
#: Posts for each state partition: of one micro-batch, and of all of them where state is kept for good (on disk).
PARTITION_POSTS, PARTITION_KEPT_POSTS, LEAST_PARTITIONS = 25_000, 1_000_000, 8


# -- jobs --------------------------------------------------------------------

def distinct_by_text_digest(df: DataFrame, text_col: str = "text", time_col: str | None = None) -> DataFrame:
    """``distinct()`` whose dedupe state holds a SHA-256 digest of the text
    instead of the text itself (whole documents can be 100 KB each).

    Rows are equal exactly when their digests and other columns are, barring
    a SHA-256 collision; a null text keeps a null digest.  The state is kept
    for good, unless ``time_col`` names a watermarked column: then the
    columns but that one are the key, and it is forgotten after the watermark
    delay (``dropDuplicatesWithinWatermark``).
    """
    others = [c for c in df.columns if c not in (text_col, time_col)]
    keyed = df.withColumn("_text_digest", F.sha2(F.col(text_col), 256))
    drop = keyed.dropDuplicatesWithinWatermark if time_col else keyed.dropDuplicates
    return drop(["_text_digest", *others]).drop("_text_digest")


def posts_stream(decoded: DataFrame, explode_media: bool = True, late_text: bool = False) -> DataFrame:
    """Parsed posts; by default one row per media key (``explode_outer``).

    ``late_text=True``: ``text`` is the digest of the text, which :func:`with_texts` puts back at the end.
    """
    p = msg.parse_posts(decoded)
    if late_text:
        p = p.withColumn("text", F.sha2("text", 256))
    return fl.explode_media(p, outer=True) if explode_media else p


def texts_stream(decoded: DataFrame) -> DataFrame:
    """digest, text of the posts that have one: what :func:`with_texts` needs of the posts' stream."""
    p = msg.parse_posts(decoded, time_alias=None).where(F.col("text").isNotNull())
    return p.select(F.sha2("text", 256).alias("digest"), "text")


def with_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows whose ``text`` is a digest, with the text itself (batch); rows without one stay out of the join."""
    known = texts.groupBy("digest").agg(F.first("text").alias("__text"))       # equal digests, equal texts
    keyed, none = J.split_null_keys(rows, "text")
    keyed = keyed.withColumnRenamed("text", "digest").join(known, "digest", "left").withColumnRenamed("__text", "text")
    return keyed.select(*rows.columns).unionByName(none.select(*rows.columns))


USER_KEY = ["username", "description", "users_id", "name"]


def users_stream(decoded: DataFrame, watermark: str | None = None, within_watermark: bool = False,
                 with_time: bool = False) -> DataFrame:
    """Parsed users, distinct on their four columns; late users count too.

    ``with_time=True`` keeps the message time and makes it part of the key
    (a user sent at two times stays twice); with a ``watermark`` that state
    is evicted.  ``within_watermark=True`` is the bounded form: a user re-sent
    at another time is a duplicate if it arrives within the watermark delay
    (``dropDuplicatesWithinWatermark`` on the four user columns).
    """
    if within_watermark:
        return (msg.parse_users(decoded).withWatermark("userTimestamp", watermark or WATERMARK)
                .dropDuplicatesWithinWatermark(USER_KEY))
    if not with_time:
        if watermark:
            raise ValueError("a watermark bounds the state only within_watermark or with_time")
        return msg.parse_users(decoded, time_alias=None).dropDuplicates(USER_KEY)
    u = msg.parse_users(decoded)
    if watermark:
        u = u.withWatermark("userTimestamp", watermark)
    return u.dropDuplicates()


def media_stream(decoded: DataFrame) -> DataFrame:
    return msg.parse_media(decoded)


def _words(posts_decoded: DataFrame, clean: bool, per_media_rows: bool) -> DataFrame:
    p = posts_stream(posts_decoded, explode_media=per_media_rows)
    fn = WD.clean_words if clean else WD.raw_words
    return fn(p, keep=("created_at",))


def word_count_job(posts_decoded: DataFrame, watermark: str = WATERMARK, length: str = "25 seconds",
                   slide: str = "5 seconds", clean: bool = False, per_media_rows: bool = False) -> DataFrame:
    """Sliding-window word count on the post time (any output mode).

    ``per_media_rows=True`` explodes media keys first, as the original job
    did (each word then counts once per media key).
    """
    words = _words(posts_decoded, clean, per_media_rows)
    return W.sliding_counts(words, ("word",), "created_at", length, slide, watermark)


def word_count_partials_job(posts_decoded: DataFrame, watermark: str = WATERMARK,
                            length: str = "25 seconds", slide: str = "5 seconds", clean: bool = False,
                            per_media_rows: bool = False):
    """Complete-mode word count as (stream of bucket partials, finisher).

    Start the stream in complete mode with ``foreachBatch`` and apply the
    finisher to each result table: it yields exactly the rows of
    :func:`word_count_job`, from a state that is length/slide times smaller.
    """
    words = _words(posts_decoded, clean, per_media_rows)
    partials = W.bucket_counts(words, ("word",), "created_at", length, slide, watermark)

    def finish(batch: DataFrame) -> DataFrame:
        return W.expand_buckets(batch, ("word",), length, slide)
    return partials, finish


def word_count_table(spark: SparkSession, path: str, compact_every: int = 10) -> ResultTable:
    """The maintained result of :func:`word_count_updates`: what each batch adds to a (word, bucket)."""
    return ResultTable(spark, path, ("word", "bucket_us"), compact_every, adding=True)


#: The posts of one bucket are counted in so many parts.
BUCKET_PARTS = 16


def word_count_updates(posts_decoded: DataFrame, watermark: str = WATERMARK, length: str = "25 seconds",
                       slide: str = "5 seconds", clean: bool = False, per_media_rows: bool = False):
    """The complete result, kept incrementally: (stream of posts, batch writer, reader).

    Counts add up, so no state is kept: the writer (of a :class:`ResultTable`)
    counts the words of a micro-batch per bucket and adds those rows; the
    reader spreads what was written over the sliding windows and sums it,
    once.  Late rows count as in complete mode.  A batch shuffles its texts,
    by bucket, and not their words.
    """
    posts = posts_stream(posts_decoded, explode_media=per_media_rows).select("created_at", "text")
    g = F.lit(W.bucket_micros(length, slide))
    words = WD.clean_words if clean else WD.raw_words

    def counted(batch: DataFrame) -> DataFrame:
        us = F.unix_micros("created_at")
        rows = batch.where(F.col("created_at").isNotNull()).select(
            "text", (us - F.pmod(us, g)).alias("bucket_us"), F.pmod(F.xxhash64("text"), F.lit(BUCKET_PARTS)).alias("_part"))
        # a number of partitions that is not reduced: texts are several times as large as words
        n = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return (words(rows.repartition(n, "bucket_us", "_part"), keep=("bucket_us", "_part"))
                .groupBy("word", "bucket_us", "_part").agg(F.count(F.lit(1)).alias("count")).drop("_part"))

    def writer(table: ResultTable):
        return lambda batch, batch_id: table.write_batch(counted(batch), batch_id)

    def read(table: ResultTable) -> DataFrame:
        rows = table.read("word string, bucket_us bigint, count bigint", merged=False)
        return W.expand_bucket_rows(rows, ("word",), length, slide)
    return posts, writer, read


def heavy_authors(posts: DataFrame, share: float = 0.01, author: str = "author_id") -> list[str]:
    """Authors of at least ``share`` of the posts (batch), at most 1 / share of them.

    Exact counts, summed per task before they are shuffled: a hot author is one row a task.
    """
    n = posts.where(F.col(author).isNotNull()).groupBy(author).agg(F.count(F.lit(1)).alias("n"))
    total = posts.count()
    return sorted(r[0] for r in n.where(F.col("n") >= max(1, share * total)).collect())


def _salted_users_join(b: DataFrame, a: DataFrame, hot: list[str], salts: int) -> DataFrame:
    """Posts INNER users on author, the posts of ``hot`` authors dealt over ``salts`` keys.

    Only hot authors' users are copied to each of their salts, everyone else
    has salt 0: the state of one author is cut into ``salts`` parts and grows
    by that many user rows.  The set and the number are part of the state's
    layout and stay as they are for the life of a checkpoint.
    """
    salt = F.when(F.col("author_id").isin(hot), F.pmod(F.xxhash64("tweet_id", "media_key"), F.lit(salts))).otherwise(F.lit(0))
    copies = F.when(F.col("users_id").isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = b.withColumn("_salt", salt.cast("int"))
    right = a.withColumn("_copy", F.explode(copies))
    return left.join(right, (left["author_id"] == right["users_id"]) & (left["_salt"] == right["_copy"]), "inner") \
        .drop("_salt", "_copy")


def _with_users(b: DataFrame, users_decoded: DataFrame, user_bound: int | None,
                watermark: str | None, hot: list[str] | None = None, salts: int = 16) -> DataFrame:
    """Post rows (with ``dataTimestamp``) INNER users on author.

    With ``user_bound`` (seconds) a post meets user messages at most so much
    older; the join is bucketed by time, so a hot author is spread and both
    sides' state is evicted by the watermark.  Without it the join keeps all
    posts and users in state, as the original job does.
    """
    if user_bound is None:
        a = users_stream(users_decoded)
        if hot:
            return _salted_users_join(b, a, hot, salts)
        return b.join(a, b["author_id"] == a["users_id"], "inner")
    a = users_stream(users_decoded, watermark or WATERMARK, with_time=True)
    return J.stream_interval_join(b, a, left_key="author_id", right_key="users_id", left_time="dataTimestamp",
                                  right_time="userTimestamp", lower=0, upper=user_bound, how="inner")


def join_users_job(posts_decoded: DataFrame, users_decoded: DataFrame,
                   user_bound: int | None = None, watermark: str | None = None,
                   distinct_within: bool = False, hot: list[str] | None = None, salts: int = 16,
                   distinct: bool = True, late_text: bool = False) -> DataFrame:
    """Posts INNER users on author, then the distinct projection.

    ``user_bound`` bounds the join state (see ``_with_users``).  ``hot``
    (see :func:`heavy_authors`) spreads the state of authors with very many
    posts over ``salts`` keys.  ``distinct=False`` leaves the distinct to a
    :class:`.seen.DistinctTable`, which keeps no state for it.  The distinct
    keeps every row's digest for good unless ``distinct_within``: then equal
    rows are dropped only within the watermark delay, the post's message time
    stays in the result, and the distinct's state is bounded too.
    ``late_text``: the state and the result hold digests of the texts (see :func:`posts_stream`).
    """
    b = posts_stream(posts_decoded, late_text=late_text)
    if watermark or user_bound is not None or distinct_within:
        b = b.withWatermark("dataTimestamp", watermark or WATERMARK)
    cols = ["username", "text", "retweet_count", "reply_count", "like_count", "quote_count", "created_at"]
    out = _with_users(b, users_decoded, user_bound, watermark, hot, salts).select(
        *cols, *(["dataTimestamp"] if distinct_within else []))
    if not distinct:
        return out
    return distinct_by_text_digest(out, time_col="dataTimestamp" if distinct_within else None)


def join_users_media_job(posts_decoded: DataFrame, users_decoded: DataFrame | None, media_decoded: DataFrame,
                         watermark: str = WATERMARK, bound: int = INTERVAL_SECONDS,
                         null_safe: bool = True, user_bound: int | None = None,
                         users_snapshot: DataFrame | None = None, distinct_within: bool = False,
                         late_text: bool = False) -> DataFrame:
    """Posts INNER users and LEFT OUTER media messages of the minute before
    the post (null-safe key), then distinct (text, username, media_key).

    A post without a media key gives the same row whether or not it meets a
    media message without one (both media keys are null), so such posts go
    around the media join and the others join with ``=``: no pairing of all
    null posts with all null media of a minute.  ``null_safe`` therefore does
    not change the result; it is accepted for callers that state it.

    ``users_snapshot`` (a batch DataFrame with ``users_id`` and ``username``)
    replaces the users stream by a stream-static join: no users state at all,
    where a snapshot of the users table exists.  ``late_text``: the states and
    the result hold digests of the texts (see :func:`posts_stream`).
    """
    b = posts_stream(posts_decoded, late_text=late_text).withWatermark("dataTimestamp", watermark) \
        .select("text", "author_id", "media_key", "dataTimestamp")
    c = (media_stream(media_decoded).withWatermark("mediaTimestamp", watermark)
         .withColumnRenamed("media_key", "c_media_key"))
    keyed = J.stream_interval_join(b.where(F.col("media_key").isNotNull()), c.where(F.col("c_media_key").isNotNull()),
                                   left_key="media_key", right_key="c_media_key", left_time="dataTimestamp",
                                   right_time="mediaTimestamp", lower=0, upper=bound, how="left")
    plain = b.where(F.col("media_key").isNull()).withColumn("c_media_key", F.lit(None).cast("string"))
    cols = ["text", "author_id", "c_media_key", "dataTimestamp"]
    bc = keyed.select(*cols).unionByName(plain.select(*cols))
    if users_snapshot is not None:
        abc = bc.join(users_snapshot.select("users_id", "username"), F.col("author_id") == F.col("users_id"), "inner")
    else:
        abc = _with_users(bc, users_decoded, user_bound, watermark)
    out = abc.select("text", "username", F.col("c_media_key").alias("media_key"),
                     *(["dataTimestamp"] if distinct_within else []))
    return distinct_by_text_digest(out, time_col="dataTimestamp" if distinct_within else None)


def _posts_left_media(posts: DataFrame, media: DataFrame, bound: int) -> DataFrame:
    """Posts LEFT OUTER the media messages of the ``bound`` seconds before them (``=``); event time: the post's.

    Posts without a media key can meet nothing and go around the join's state.
    """
    c = media.withColumnRenamed("media_key", "c_media_key")
    keyed = J.stream_interval_join(posts.where(F.col("media_key").isNotNull()), c.where(F.col("c_media_key").isNotNull()),
                                   left_key="media_key", right_key="c_media_key", left_time="dataTimestamp",
                                   right_time="mediaTimestamp", lower=0, upper=bound, how="left")
    cols = [*posts.columns, "c_media_key", "media_type"]
    plain = posts.where(F.col("media_key").isNull()).select(
        *posts.columns, *[F.lit(None).cast("string").alias(x) for x in ("c_media_key", "media_type")])
    return keyed.select(*cols).unionByName(plain)


def _left_users(rows: DataFrame, users: DataFrame, user_bound: int) -> DataFrame:
    """Rows with a post time LEFT OUTER the messages of their author in the ``user_bound`` seconds before."""
    out = J.stream_interval_join(rows, users, left_key="author_id", right_key="users_id", left_time="dataTimestamp",
                                 right_time="userTimestamp", lower=0, upper=user_bound, how="left")
    return out.select(*rows.columns, "username")


def _three(posts_decoded: DataFrame, users_decoded: DataFrame, media_decoded: DataFrame, watermark: str):
    b = posts_stream(posts_decoded).withWatermark("dataTimestamp", watermark).select(
        "tweet_id", "author_id", "media_key", "dataTimestamp")
    a = msg.parse_users(users_decoded).withWatermark("userTimestamp", watermark).select(
        "users_id", "username", "userTimestamp")
    c = media_stream(media_decoded).withWatermark("mediaTimestamp", watermark)
    return b, a, c


def full_outer_job(posts_decoded: DataFrame, users_decoded: DataFrame, media_decoded: DataFrame,
                   watermark: str = WATERMARK, bound: int = INTERVAL_SECONDS,
                   user_bound: int = INTERVAL_SECONDS) -> DataFrame:
    """Posts FULL OUTER media messages FULL OUTER user messages, each of the seconds before the post.

    A media message that met no post has no author and no post time, so it can
    meet no user: it leaves after the first join instead of sitting in the
    second one's state, where a null event time would never be evicted.  What
    users meet are posts, and the first join keeps every post, so the users
    without one follow from the posts themselves.  Every part is released by
    the watermark of its preserved side.
    """
    b, a, c = _three(posts_decoded, users_decoded, media_decoded, watermark)
    rows = _left_users(_posts_left_media(b, c, bound), a, user_bound)
    cols = ["tweet_id", "dataTimestamp", "media_key", "media_type", "username"]
    met = rows.select("tweet_id", "dataTimestamp", F.coalesce("media_key", "c_media_key").alias("media_key"), "media_type", "username")
    none = {"tweet_id": "string", "dataTimestamp": "timestamp", "media_key": "string", "media_type": "string", "username": "string"}

    def alone(side: DataFrame, key: str, time: str, left_key: str, upper: int, have: tuple[str, ...]) -> DataFrame:
        """Messages of one side that met no post."""
        marked = b.select(F.col(left_key).alias("__k"), "dataTimestamp", F.lit(True).alias("__post"))
        keyed = J.stream_interval_join(marked.where(F.col("__k").isNotNull()), side.where(F.col(key).isNotNull()),
                                       left_key="__k", right_key=key, left_time="dataTimestamp", right_time=time,
                                       lower=0, upper=upper, how="right").where(F.col("__post").isNull())
        both = keyed.select(key, *have).unionByName(side.where(F.col(key).isNull()).select(key, *have))
        both = both.withColumnRenamed(key, "media_key") if left_key == "media_key" else both
        return both.select(*[F.col(x) if x in both.columns else F.lit(None).cast(none[x]).alias(x) for x in cols])

    media_only = alone(c.withColumnRenamed("media_key", "c_media_key"), "c_media_key", "mediaTimestamp", "media_key", bound,
                       ("media_type",))
    users_only = alone(a, "users_id", "userTimestamp", "author_id", user_bound, ("username",))
    return met.unionByName(media_only).unionByName(users_only)


def media_counts_full_outer_job(posts_decoded: DataFrame, users_decoded: DataFrame, media_decoded: DataFrame,
                                watermark: str = WATERMARK, bound: int = INTERVAL_SECONDS,
                                user_bound: int = INTERVAL_SECONDS, length: str = "5 minutes",
                                slide: str = "2 minutes") -> DataFrame:
    """Media types per (window of the post time, username) over :func:`full_outer_job`, in append mode.

    Two chained outer joins, then a window aggregation: each operator's
    watermark is the one before it less what its join may still release, so a
    window closes once no join can add to it.  Messages that met no post have
    no time to be counted at and fall out of every window; of the full outer
    joins the posts' side is what remains, and only that is kept in state.
    """
    b, a, c = _three(posts_decoded, users_decoded, media_decoded, watermark)
    rows = _left_users(_posts_left_media(b, c, bound), a, user_bound)
    return W.windowed_media_counts(rows, "dataTimestamp", ("username",), length, slide)


def right_outer_job(posts_decoded: DataFrame, users_decoded: DataFrame, media_decoded: DataFrame,
                    watermark: str = WATERMARK, bound: int = INTERVAL_SECONDS,
                    user_bound: int = INTERVAL_SECONDS) -> DataFrame:
    """(User messages RIGHT OUTER posts) RIGHT OUTER media messages, each post in the seconds after the message.

    The event time is the preserved side's: the post's after the first join,
    the media message's after the second.  Media messages without a key meet
    nothing and go around the state of the second join; posts without one can
    meet no media message and are not preserved, so they need not enter it.
    """
    b, a, c = _three(posts_decoded, users_decoded, media_decoded, watermark)
    ab = _left_users(b.where(F.col("media_key").isNotNull()), a, user_bound)
    c = c.withColumnRenamed("media_key", "c_media_key")
    out = J.stream_interval_join(ab, c.where(F.col("c_media_key").isNotNull()), left_key="media_key", right_key="c_media_key",
                                 left_time="dataTimestamp", right_time="mediaTimestamp", lower=0, upper=bound, how="right")
    cols = ["username", "tweet_id", "dataTimestamp", "c_media_key", "media_type", "mediaTimestamp"]
    plain = c.where(F.col("c_media_key").isNull()).select(
        *[F.lit(None).cast(t).alias(x) for x, t in (("username", "string"), ("tweet_id", "string"), ("dataTimestamp", "timestamp"))],
        "c_media_key", "media_type", "mediaTimestamp")
    return out.select(*cols).unionByName(plain)


# -- replay of the test tables -------------------------------------------------

def _closing_posts(mx: DataFrame) -> DataFrame:
    arr = F.array(F.lit(CLOSE))
    return msg.post_records(mx.select(
        F.lit(CLOSE).alias("tweet_id"), (F.col("t") + F.expr("INTERVAL 1 HOUR")).alias("created_at"),
        F.lit(None).cast("string").alias("text"),
        *[F.lit(None).cast("int").alias(m) for m in ("retweet_count", "reply_count", "like_count", "quote_count")],
        F.lit(CLOSE).alias("author_id"), arr.alias("data_media_keys")))


def _closing_users(mx: DataFrame) -> DataFrame:
    return msg.user_records(mx.select(
        F.lit(CLOSE).alias("users_id"), F.lit(CLOSE).alias("username"), F.lit(CLOSE).alias("description"),
        F.lit(CLOSE).alias("name"), (F.col("t") + F.expr("INTERVAL 1 HOUR")).alias("user_ts")))


def _closing_media(mx: DataFrame) -> DataFrame:
    return msg.media_records(mx.select(
        F.lit(CLOSE).alias("media_key"), F.lit("photo").alias("media_type"),
        (F.col("t") + F.expr("INTERVAL 1 HOUR")).alias("media_ts")))


class Replay:
    """Record files for the tables of one data folder, staged in the order of
    event time and opened as streams of several micro-batches."""

    def __init__(self, spark: SparkSession, sf_dir: str, closing: bool = False, bounded: bool = False):
        """``bounded``: the job's state is evicted by the watermark, so it is as large as its micro-batches."""
        self.spark, self.t, self.sf_dir = spark, Tables(spark, sf_dir), sf_dir
        self.closing, self.bounded = closing, bounded
        self._cuts = self._posts = None
        self._staged: list[str] = []

    def n_posts(self) -> int:
        if self._posts is None:
            self._posts = self.t.post_times.count()
        return self._posts

    def batches(self) -> int:
        return max(REPLAY_BATCHES, -(-self.n_posts() // BATCH_POSTS)) if self.bounded else REPLAY_BATCHES

    def partitions(self) -> int:
        """State partitions by the posts they hold; at most what the session has."""
        n = -(-self.n_posts() // (self.batches() * PARTITION_POSTS if self.bounded else PARTITION_KEPT_POSTS))
        return min(max(LEAST_PARTITIONS, n), int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def _max(self) -> DataFrame:
        """The latest time: media and user messages are sent before their posts."""
        t = self.t
        return max_time((t.post_times, "created_at"))

    def cuts(self) -> list:
        """Times that cut the posts into equal micro-batches; all streams use the same."""
        if self._cuts is None:
            self._cuts = time_cuts(self.t.post_times, "created_at", self.batches())
        return self._cuts

    def _open(self, name: str, records: DataFrame, closing_fn) -> DataFrame:
        staged = stage_records(self.spark, records, f"stream-in-{name}", self.cuts(),
                               # the last rows push the watermark past every real row
                               closing_fn(self._max()) if self.closing else None)
        self._staged.append(staged.path)
        raw = read_stream(self.spark, "files", path=staged.path, max_files_per_trigger=staged.files)
        return msg.decode_records(raw)

    def close(self, *more: str) -> None:
        """Drop the record files, and ``more`` folders: the streams have ended and nothing reads them again."""
        for path in (*self._staged, *more):
            drop_dir(self.spark, path)
        self._staged = []

    def posts(self) -> DataFrame:
        return self._open("posts", msg.post_records(self.t.posts), _closing_posts)

    def users(self, per_post: bool = False) -> DataFrame:
        """Users stamped before their first post, or once for each of their posts."""
        sent = self.t.user_messages_per_post if per_post else self.t.user_messages
        return self._open("users", msg.user_records(sent), _closing_users)

    def media(self) -> DataFrame:
        return self._open("media", msg.media_records(self.t.media_messages), _closing_media)


def _run(spark: SparkSession, df: DataFrame, name: str, mode: str = "append", finish=None,
         partitions: int | None = None, replay: Replay | None = None, conf: dict[str, str] | None = None) -> DataFrame:
    """``replay``: its record files and the checkpoint go when the stream has ended."""
    out, ckpt = work_dir(spark, f"stream-out-{name}"), work_dir(spark, f"stream-ckpt-{name}")
    final = run_available_now(df, out, ckpt, mode, finish=finish, partitions=partitions, conf=conf)
    if replay is not None:
        replay.close(ckpt)
    return spark.read.parquet(final)


def _texts(spark: SparkSession, posts_decoded: DataFrame, name: str) -> DataFrame:
    """The texts of a posts' stream by digest, kept in files."""
    kept = ResultTable(spark, work_dir(spark, f"stream-out-{name}-texts"))
    ckpt = work_dir(spark, f"stream-ckpt-{name}-texts")
    run_available_now(texts_stream(posts_decoded), kept.path, ckpt, "append", write=kept.write_batch)
    drop_dir(spark, ckpt)
    return kept.read("digest string, text string")


@query("stream_ingest_posts")
def stream_ingest_posts(spark, sf):
    """The posts job: parsed posts, one row per media key."""
    out = _run(spark, posts_stream(Replay(spark, sf).posts()), "ingest-posts")
    return ntz(out.select("tweet_id", "created_at", "text", "like_count", "author_id", "media_key", "dataTimestamp"))


@query("stream_ingest_media")
def stream_ingest_media(spark, sf):
    return ntz(_run(spark, media_stream(Replay(spark, sf).media()), "ingest-media"))


@query("stream_distinct_users")
def stream_distinct_users(spark, sf):
    """The users job: each user is sent once per post and comes out once."""
    return _run(spark, users_stream(Replay(spark, sf).users(per_post=True)), "distinct-users")


@query("stream_distinct_users_files")
def stream_distinct_users_files(spark, sf):
    """The users job with its distinct kept in files instead of a state store."""
    sent = msg.parse_users(Replay(spark, sf).users(per_post=True), time_alias=None)
    kept = DistinctTable(spark, work_dir(spark, "stream-out-distinct-files"), USER_KEY, compact_every=3)
    run_available_now(sent, kept.path, work_dir(spark, "stream-ckpt-distinct-files"), "append", write=kept.write_batch)
    return kept.read().select(*USER_KEY)


@query("stream_join_users_salted")
def stream_join_users_salted(spark, sf):
    """The users join with its hot authors spread over salts, and the distinct kept in files."""
    r = Replay(spark, sf)
    hot = heavy_authors(table(spark, sf, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("author_id")))
    posts = r.posts()
    texts = _texts(spark, posts, "join-salted")
    rows = join_users_job(posts, r.users(), hot=hot, salts=4, distinct=False, late_text=True)
    kept = DistinctTable(spark, work_dir(spark, "stream-out-join-salted"), rows.columns)
    ckpt = work_dir(spark, "stream-ckpt-join-salted")

    def write(batch: DataFrame, batch_id: int) -> None:
        # the distinct reads the batch twice; the join is to read and write its state once
        once = work_dir(spark, "stream-batch-join-salted")
        batch.write.parquet(once)
        kept.write_batch(spark.read.schema(batch.schema).parquet(once), batch_id)
        drop_dir(spark, once)

    run_available_now(rows, kept.path, ckpt, "append", write=write, partitions=r.partitions(), conf=KEPT_STATE)
    r.close(ckpt)
    return ntz(with_texts(kept.read(), texts))


@query("stream_join_users")
def stream_join_users(spark, sf):
    r = Replay(spark, sf)
    return ntz(_run(spark, join_users_job(r.posts(), r.users()), "join-users"))


@query("stream_join_users_media")
def stream_join_users_media(spark, sf):
    r = Replay(spark, sf, closing=True)
    posts = r.posts()
    texts = _texts(spark, posts, "join-users-media")
    job = join_users_media_job(posts, r.users(), r.media(), late_text=True)
    out = _run(spark, job, "join-users-media", partitions=r.partitions(), replay=r, conf=KEPT_STATE)
    return with_texts(out.where((F.col("username") != CLOSE) | F.col("username").isNull()), texts)


@query("stream_full_outer")
def stream_full_outer(spark, sf):
    """J10's rows: posts FULL OUTER media messages FULL OUTER user messages (users sent before each post)."""
    r = Replay(spark, sf, closing=True, bounded=True)
    out = _run(spark, full_outer_job(r.posts(), r.users(per_post=True), r.media()), "full-outer", partitions=r.partitions(), replay=r)
    close = [F.coalesce(F.col(x), F.lit("")) == CLOSE for x in ("tweet_id", "media_key", "username")]
    return ntz(out.where(~(close[0] | close[1] | close[2])).withColumnRenamed("dataTimestamp", "created_at"))


@query("stream_media_counts_full_outer")
def stream_media_counts_full_outer(spark, sf):
    """J10: media types per window and user, over posts FULL OUTER media FULL OUTER users."""
    r = Replay(spark, sf, closing=True, bounded=True)
    out = _run(spark, media_counts_full_outer_job(r.posts(), r.users(per_post=True), r.media()), "media-counts-full", partitions=r.partitions())
    return ntz(W.flatten_window(out))


@query("stream_right_outer_x2")
def stream_right_outer_x2(spark, sf):
    """J11: users RIGHT OUTER posts RIGHT OUTER media messages."""
    r = Replay(spark, sf, closing=True, bounded=True)
    out = _run(spark, right_outer_job(r.posts(), r.users(), r.media()), "right-x2", partitions=r.partitions())
    out = out.where((F.col("c_media_key") != CLOSE) | F.col("c_media_key").isNull())
    return ntz(out.withColumnsRenamed({"dataTimestamp": "created_at", "mediaTimestamp": "media_ts"}))


def _stream_counts(spark, sf, name: str, clean: bool) -> DataFrame:
    r, ckpt = Replay(spark, sf), work_dir(spark, f"stream-ckpt-{name}")
    posts, writer, read = word_count_updates(r.posts(), clean=clean)
    kept = word_count_table(spark, work_dir(spark, f"stream-out-{name}"))
    run_available_now(posts, kept.path, ckpt, "update", write=writer(kept))
    r.close(ckpt)
    return ntz(W.flatten_window(read(kept)))


@query("stream_word_count_sliding")
def stream_word_count_sliding(spark, sf):
    return _stream_counts(spark, sf, "word-count", clean=False)


@query("stream_word_count_sliding_clean")
def stream_word_count_sliding_clean(spark, sf):
    return _stream_counts(spark, sf, "word-count-clean", clean=True)
