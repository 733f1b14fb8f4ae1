"""Flatten envelopes into posts / media / users and explode media keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import METRIC_NAMES


def flatten_posts(envelopes: DataFrame) -> DataFrame:
    """One row per post; metrics and time are ``try_cast`` so bad values become null."""
    d = F.col("d")
    return (envelopes.select(F.explode("data").alias("d"))
            .select(
                d["id"].alias("tweet_id"),
                d["created_at"].try_cast("timestamp").alias("created_at"),
                d["text"].alias("text"),
                *[d["public_metrics"][m].try_cast("int").alias(m) for m in METRIC_NAMES],
                d["author_id"].alias("author_id"),
                d["attachments"]["media_keys"].alias("data_media_keys"),
            ))


def flatten_media(envelopes: DataFrame) -> DataFrame:
    """One row per included media item; duplicates across envelopes are kept."""
    m = F.col("m")
    return (envelopes.select(F.explode("includes.media").alias("m"))
            .select(m["media_key"].alias("media_key"), m["type"].alias("media_type")))


def flatten_users(envelopes: DataFrame, distinct: bool = True) -> DataFrame:
    """Included users, distinct over all four columns."""
    u = F.col("u")
    out = (envelopes.select(F.explode("includes.users").alias("u"))
           .select(u["username"].alias("username"), u["description"].alias("description"),
                   u["id"].alias("users_id"), u["name"].alias("name")))
    return out.distinct() if distinct else out


def explode_media(posts: DataFrame, outer: bool = True, keep: tuple[str, ...] | None = None,
                  array_col: str = "data_media_keys", key_col: str = "media_key") -> DataFrame:
    """One row per (post, media key).

    ``outer=True`` keeps posts with a null or empty array as one row with a
    null key (and drops the array column); ``outer=False`` drops them.
    """
    gen = F.explode_outer(array_col) if outer else F.explode(array_col)
    cols = [c for c in (keep if keep is not None else posts.columns) if c != array_col]
    return posts.select(*cols, gen.alias(key_col))


def latest_users(users: DataFrame, order_col: str | None = None) -> DataFrame:
    """One row per ``users_id`` (removes the description fan-out).

    Picks the greatest row per id (by ``order_col`` when given, else by the
    row itself) with a max-by aggregate, so no window sort is needed.
    """
    cols = [c for c in users.columns if c != "users_id"]
    ordering = F.col(order_col) if order_col else F.struct(*cols)
    return (users.groupBy("users_id")
            .agg(F.max_by(F.struct(*cols), ordering).alias("_u"))
            .select("users_id", *[F.col("_u")[c].alias(c) for c in cols]))


def dedupe_media(media: DataFrame) -> DataFrame:
    """Drop exact duplicate media rows (removes the media fan-out)."""
    return media.dropDuplicates()
