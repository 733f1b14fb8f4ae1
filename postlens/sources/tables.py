"""Adapter from the generated test tables to the posts / users / media model.

Every view reads whole tables (no row filter); only the columns a view needs
are selected, so the parquet scans are pruned.

posts           events (one post per event) left-joined to documents for text
users           customer, one user per customer
media           part, one media item per part
media_messages  one media message per (post, known media key), plus a
                null-key message for every post without an attachment array
user_messages   users that posted, stamped 10 s before their first post
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Fixed values of the adapter (shared with the SQL oracle): the media-key
# pool size, the event-type -> attachment mapping and the part-size ->
# media-type mapping.
MEDIA_KEY_POOL = 200
MEDIA_TYPES_BY_SIZE_MOD4 = ("photo", "video", "animated_gif", "other")
MEDIA_SHIFT_SECONDS = 45   # media message time = post time - 45 s * (id % 3)
NULL_MEDIA_SHIFT_SECONDS = 20
USER_SHIFT_SECONDS = 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _media_keys(event_id, event_type):
    k1 = F.concat(F.lit("m"), (event_id % MEDIA_KEY_POOL).cast("string"))
    k2 = F.concat(F.lit("m"), ((event_id * 7 + 3) % MEDIA_KEY_POOL).cast("string"))
    arr = ArrayType(StringType(), True)
    return (F.when(event_type == "signup", F.lit(None).cast(arr))
            .when(event_type == "error", F.array().cast(arr))
            .when(event_type == "view", F.array(k1))
            .when(event_type == "click", F.array(k1, k2))
            .otherwise(F.array(F.concat(F.lit("x"), event_id.cast("string")))))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    eid = F.col("event_id")
    return (e.join(d, e.event_id == d.doc_id, "left")
            .select(
                eid.cast("string").alias("tweet_id"),
                F.col("ts").alias("created_at"),
                F.col("text"),
                F.floor("value").try_cast("int").alias("retweet_count"),
                (eid % 7).cast("int").alias("reply_count"),
                F.get_json_object("props", "$.k").try_cast("int").alias("like_count"),
                (eid % 3).cast("int").alias("quote_count"),
                F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("author_id"),
                _media_keys(eid, F.col("event_type")).alias("data_media_keys"),
            ))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("users_id"),
        F.col("c_name").alias("username"),
        F.col("c_mktsegment").alias("description"),
        F.upper("c_name").alias("name"),
    )


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    size4 = F.col("p_size") % 4
    mtype = F.when(size4 == 0, MEDIA_TYPES_BY_SIZE_MOD4[0])
    for i, t in enumerate(MEDIA_TYPES_BY_SIZE_MOD4[1:-1], start=1):
        mtype = mtype.when(size4 == i, t)
    mtype = mtype.otherwise(MEDIA_TYPES_BY_SIZE_MOD4[-1])
    return p.select(F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("media_key"),
                    mtype.alias("media_type"))


def _seconds(n):
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))


def media_messages(spark: SparkSession, sf_dir: str, posts_df: DataFrame | None = None,
                   media_df: DataFrame | None = None) -> DataFrame:
    p = posts_df if posts_df is not None else posts(spark, sf_dir)
    m = media_df if media_df is not None else media(spark, sf_dir)
    keyed = (p.select("tweet_id", "created_at", F.explode("data_media_keys").alias("media_key"))
             .join(m, "media_key")
             .select("media_key", "media_type",
                     (F.col("created_at")
                      - _seconds(F.col("tweet_id").cast("bigint") % 3 * MEDIA_SHIFT_SECONDS)).alias("media_ts")))
    unkeyed = (p.filter(F.col("data_media_keys").isNull())
               .select(F.lit(None).cast("string").alias("media_key"), F.lit("photo").alias("media_type"),
                       (F.col("created_at") - _seconds(F.lit(NULL_MEDIA_SHIFT_SECONDS))).alias("media_ts")))
    return keyed.unionByName(unkeyed)


def user_messages(spark: SparkSession, sf_dir: str, posts_df: DataFrame | None = None,
                  users_df: DataFrame | None = None) -> DataFrame:
    p = posts_df if posts_df is not None else posts(spark, sf_dir)
    u = users_df if users_df is not None else users(spark, sf_dir)
    first = p.groupBy("author_id").agg(F.min("created_at").alias("first_ts"))
    return (u.join(first, u.users_id == first.author_id)
            .select("users_id", "username", "description", "name",
                    (F.col("first_ts") - _seconds(F.lit(USER_SHIFT_SECONDS))).alias("user_ts")))


def user_messages_per_post(spark: SparkSession, sf_dir: str, posts_df: DataFrame | None = None,
                           users_df: DataFrame | None = None) -> DataFrame:
    """Users that posted, sent 10 s before each of their posts."""
    p = posts_df if posts_df is not None else posts(spark, sf_dir)
    u = users_df if users_df is not None else users(spark, sf_dir)
    sent = p.select("author_id", "created_at")
    return (u.join(sent, u.users_id == sent.author_id)
            .select("users_id", "username", "description", "name",
                    (F.col("created_at") - _seconds(F.lit(USER_SHIFT_SECONDS))).alias("user_ts")))


class Tables:
    """Lazily built adapter views of the given tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name, fn):
        if name not in self._cache:
            self._cache[name] = fn()
        return self._cache[name]

    @property
    def posts(self):
        return self._get("posts", lambda: posts(self.spark, self.sf_dir))

    @property
    def post_times(self):
        """The posts' times alone, without their texts."""
        return self._get("post_times", lambda: table(self.spark, self.sf_dir, "events").select(F.col("ts").alias("created_at")))

    @property
    def post_sizes(self):
        """Time and bytes of text of the posts that have one; the join moves no texts."""
        def sizes():
            e = table(self.spark, self.sf_dir, "events").select("event_id", F.col("ts").alias("created_at"))
            d = table(self.spark, self.sf_dir, "documents").select("doc_id", F.octet_length("text").alias("n_bytes"))
            return e.join(d, e.event_id == d.doc_id).select("created_at", "n_bytes")
        return self._get("post_sizes", sizes)

    @property
    def users(self):
        return self._get("users", lambda: users(self.spark, self.sf_dir))

    @property
    def media(self):
        return self._get("media", lambda: media(self.spark, self.sf_dir))

    @property
    def media_messages(self):
        return self._get("media_messages",
                         lambda: media_messages(self.spark, self.sf_dir, self.posts, self.media))

    @property
    def user_messages_per_post(self):
        return self._get("user_messages_per_post",
                         lambda: user_messages_per_post(self.spark, self.sf_dir, self.posts, self.users))

    @property
    def user_messages(self):
        return self._get("user_messages",
                         lambda: user_messages(self.spark, self.sf_dir, self.posts, self.users))
