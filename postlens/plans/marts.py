"""The batch job: flatten envelopes once, then build and write the nine marts.

The flattened posts / users / media are written once to the shared folder
and read back, so the nine marts do not each rescan and re-explode the
envelopes, and a lost executor recomputes from those files rather than
from the envelopes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import TOPIC_A, TOPIC_B
from ..operators import aggregates as agg
from ..operators import flatten as fl
from ..operators import joins as J
from ..operators import words as WD
from ..session import work_dir


def flatten_once(spark: SparkSession, envelopes: DataFrame, path: str | None = None,
                 dedupe_media: bool = False, latest_user: bool = False,
                 profile: dict[str, dict] | None = None) -> dict[str, DataFrame]:
    """Flatten and persist posts / users / media as parquet under ``path``.

    ``profile`` is filled with each table's rows and null counts, observed
    while it is written: no scan is added.
    """
    path = path or work_dir(spark, "flat")
    users = fl.flatten_users(envelopes)
    if latest_user:
        users = fl.latest_users(users)
    media = fl.flatten_media(envelopes)
    if dedupe_media:
        media = fl.dedupe_media(media)
    frames = {"posts": fl.flatten_posts(envelopes), "users": users, "media": media}
    out = {}
    for name, df in frames.items():
        observed(df, name, profile, lambda x, n=name: x.write.mode("overwrite").parquet(f"{path}/{n}"))
        out[name] = spark.read.parquet(f"{path}/{name}")
    return out


def build_marts(posts: DataFrame, users: DataFrame, media: DataFrame,
                topics: tuple[str, str] = (TOPIC_A, TOPIC_B)) -> dict[str, DataFrame]:
    """df1..df9 of the original job, by name."""
    return {
        "df1": agg.media_counts(posts, media, by=("tweet_id",)),
        "df2": agg.media_counts(posts, media, users, by=("tweet_id", "username", "text")),
        "df3": agg.media_counts(posts, media, users, by=("username",)),
        "df4": agg.posts_by_time(J.join_users(posts, users, "full")),
        "df5": agg.interaction_totals(posts, users),
        "df6": agg.topic_mentions(posts, users, topics[0]),
        "df7": J.join_media_users_full(fl.explode_media(posts, outer=False), media, users).select(
            "tweet_id", "created_at", "username", "text", "retweet_count", "reply_count", "like_count",
            "quote_count", "media_key", "media_type", "author_id", "name", "description"),
        "df8": WD.word_frequency(WD.clean_words(posts)).orderBy(F.desc("count"), F.asc("word")),
        "df9": agg.topic_mentions(posts, users, topics[1]),
    }


def observed(df: DataFrame, name: str, profile: dict[str, dict] | None, write: Callable[[DataFrame], None]) -> None:
    """Writes ``df``; if ``profile`` is given, its row count and each column's nulls are counted in passing."""
    if profile is None:
        write(df)
        return
    seen = Observation(f"profile-{name}")
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]
    write(df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls))
    profile[name] = seen.get


def write_marts(marts: dict[str, DataFrame], writer: Callable[[str, DataFrame], None],
                profile: dict[str, dict] | None = None) -> None:
    """Write every mart, e.g. ``writer = lambda n, df: jdbc_write(df, jdbc_options(url, n))``."""
    for name, df in marts.items():
        observed(df, name, profile, lambda x, n=name: writer(n, x))
