"""Aggregated marts over posts, users and media.

The marts group rows of full outer joins.  They are computed by
aggregating *before* joining wherever the result is the same: a post side
reduced to one row per join key cannot be skewed by a hot author or media
key, and the partial (map-side) aggregation absorbs the hot key.  Fan-out
is preserved: a key matching two user or media rows still contributes
twice, exactly as the row-level join would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import METRIC_NAMES
from .flatten import explode_media
from .joins import full_outer_join, left_join_null_split, left_join_spread_nulls
from .order import with_positions

# The media types counted and the output column for each.
MEDIA_TYPE_COLUMNS = (("photo", "photo_count"), ("video", "video_count"), ("animated_gif", "gif_count"))


TIME_COLUMNS = ("tweet_id", "created_at", "username", "text", "retweet_count", "reply_count", "like_count", "quote_count")
TIME_ORDER = ("created_at", "tweet_id", "users_id", "description")


def media_type_totals(media: DataFrame) -> DataFrame:
    """One row per media key with the number of media rows of each type."""
    return media.groupBy("media_key").agg(*[
        F.count_if(F.col("media_type") == t).alias(c) for t, c in MEDIA_TYPE_COLUMNS])


def _counted_rows(exploded: DataFrame, media: DataFrame) -> DataFrame:
    """Rows of ``exploded FULL OUTER JOIN media USING media_key``, with media
    rows pre-counted per key (columns photo_count/video_count/gif_count).

    Media keys no post uses collapse into one all-null row: they can only
    ever land in the all-null group of any grouping below.
    """
    totals = media_type_totals(media)
    post_side = left_join_null_split(exploded, totals, "media_key")
    used = exploded.select("media_key").where(F.col("media_key").isNotNull()).distinct()
    orphans = (totals.join(used, "media_key", "left_anti")
               .agg(*[F.sum(c).alias(c) for _, c in MEDIA_TYPE_COLUMNS])
               .where(F.col(MEDIA_TYPE_COLUMNS[0][1]).isNotNull()))   # no orphans -> no row
    return post_side.unionByName(orphans, allowMissingColumns=True)


def _finish(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[
        F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for _, c in MEDIA_TYPE_COLUMNS])


def media_counts(posts: DataFrame, media: DataFrame, users: DataFrame | None = None,
                 by: tuple[str, ...] = ("tweet_id",)) -> DataFrame:
    """Photo / video / gif counts grouped by ``by``.

    Row set (as in the original marts): posts exploded on their media keys
    (posts without keys drop out) FULL OUTER media, then FULL OUTER users on
    ``author_id = users_id`` when ``users`` is given.
    """
    by = list(by)
    post_cols = [c for c in by if c in posts.columns]
    if "text" in post_cols:
        return _with_late_text(posts, media, users, by, post_cols)
    need = list(dict.fromkeys(post_cols + (["author_id"] if users is not None else [])))
    exploded = explode_media(posts, outer=False, keep=tuple(need + ["data_media_keys"]))
    rows = _counted_rows(exploded, media)
    if users is None:
        return _finish(rows, by)
    # one row per (post-side group, author) before meeting the users
    pre = _finish(rows, need)
    user_cols = [c for c in by if c in users.columns and c not in need]
    joined = full_outer_join(pre, users.select("users_id", *user_cols), "author_id", "users_id",
                             left_keys=exploded.select("author_id"))
    return _finish(joined, by)


def _with_late_text(posts: DataFrame, media: DataFrame, users: DataFrame | None, by: list[str],
                    post_cols: list[str]) -> DataFrame:
    """Counts by a digest of the grouping columns of the posts; the columns, whole texts among them, join at the end.

    The texts meet one exchange, the one that brings each group's columns
    together, and the counts join them there.  Groups without a post (media
    and users alone) have a null digest and null columns.
    """
    parts = [F.coalesce(F.concat(F.lit("v"), F.sha2(F.col(c).cast("string"), 256)), F.lit("n")) for c in post_cols]
    # a post of which all these columns are null is in one group with the rows without a post
    some = F.coalesce(*[F.col(c).cast("string") for c in post_cols]).isNotNull()
    keyed = posts.withColumn("__group", F.when(some, F.sha2(F.concat(*parts), 256)))
    narrow = keyed.select("__group", "data_media_keys", *(["author_id"] if users is not None else []))
    counts = media_counts(narrow, media, users, tuple(["__group", *[c for c in by if c not in post_cols]]))
    groups = (keyed.where((F.size("data_media_keys") > 0) & F.col("__group").isNotNull()).select(F.col("__group").alias("__g"), *post_cols)
              .dropDuplicates(["__g"]))
    out = left_join_spread_nulls(counts, groups, "__group", "__g")
    return out.select(*by, *[c for _, c in MEDIA_TYPE_COLUMNS])


def interaction_totals(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Sum of the four metrics per (author_id, username) over posts FULL OUTER users.

    All-null groups keep a null sum.  Posts are summed per author first.
    """
    per_author = posts.groupBy("author_id").agg(*[F.sum(m).alias(m) for m in METRIC_NAMES])
    joined = full_outer_join(per_author, users.select("users_id", "username"), "author_id", "users_id")
    return joined.groupBy("author_id", "username").agg(
        *[F.sum(m).cast("bigint").alias(f"sum_{m}") for m in METRIC_NAMES])


def topic_mentions(posts: DataFrame, users: DataFrame, pattern: str) -> DataFrame:
    """Posts whose text matches ``pattern``, counted per username.

    The text test rejects the user-only rows of the full outer join, so this
    is posts LEFT JOIN users; posts are counted per author first.
    """
    per_author = (posts.where(F.col("text").rlike(pattern))
                  .groupBy("author_id").agg(F.count(F.lit(1)).alias("n")))
    joined = per_author.join(users.select("users_id", "username"),
                             per_author.author_id == F.col("users_id"), "left")
    return joined.groupBy("username").agg(F.sum("n").cast("bigint").alias("count"))


def likes_by_author(posts: DataFrame) -> DataFrame:
    return posts.groupBy("author_id").agg(F.sum("like_count").cast("bigint").alias("sum_like_count"),
                                          F.avg("like_count").alias("avg_like_count"))


def likes_total(posts: DataFrame) -> DataFrame:
    return posts.agg(F.sum("like_count").cast("bigint").alias("sum_like_count"))


def posts_per_day(posts: DataFrame, time_col: str = "created_at") -> DataFrame:
    return (posts.groupBy(F.to_date(time_col).alias("day"))
            .agg(F.count(F.lit(1)).alias("n_posts")))


def posts_by_time(joined: DataFrame) -> DataFrame:
    """Posts FULL OUTER users, eight columns, ordered by post time.

    The global sort is range-partitioned on its keys.  Users without posts
    all have a null time and a null post id; ``users_id`` and
    ``description`` break that tie so those rows spread over ranges
    instead of forming one partition.
    """
    return joined.orderBy(*[F.asc_nulls_first(c) for c in TIME_ORDER]).select(*TIME_COLUMNS)


def posts_by_time_numbered(joined: DataFrame) -> DataFrame:
    """:func:`posts_by_time` with each row's place in that order (``position``, from 1)."""
    ties = [c for c in TIME_COLUMNS if c not in (*TIME_ORDER, "text")]
    order = [*[F.asc_nulls_first(c) for c in (*TIME_ORDER, *ties)], F.xxhash64("text").asc()]
    rows = joined.select(*dict.fromkeys([*TIME_COLUMNS, "users_id", "description"]))
    return with_positions(rows, order).select("position", *TIME_COLUMNS)
