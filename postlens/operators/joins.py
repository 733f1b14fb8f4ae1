"""Joins of posts, users and media.

Two scale-minded building blocks:

``full_outer_join``
    A full outer equi-join written as ``left LEFT JOIN right`` plus the
    right rows whose key the left never has (``LEFT ANTI`` against the
    *distinct* left keys).  Spark's adaptive execution can split skewed
    partitions and switch to a broadcast by runtime size for left-outer and
    anti joins, but not for a full outer sort-merge join; and the distinct
    key set is pre-aggregated map-side, so one hot key costs one row per
    map task in the anti join's shuffle.

``interval_join``
    Key match plus ``lower <= left_time - right_time <= upper``.  Batch form:
    both sides get a time bucket of width ``upper - lower``; one side is
    replicated into the (usually two) buckets its range touches, the other
    keeps its single bucket, and the join is an equi-join on
    ``(key, bucket)`` plus the exact time test.  A hot key -- including the
    null key of a null-safe join -- is therefore spread over its time buckets
    instead of landing in one task, and each pair is found exactly once.
    Stream form: Spark's stream-stream join on the same (key, bucket) plus
    range condition, so the state store is split per bucket too and is
    still evicted by watermark (full outer: two such joins, see
    :func:`stream_interval_join`).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import epoch_seconds, seconds

#: Accepted names after lower-casing and dropping underscores.
_JOIN_KINDS = {"inner": "inner", "left": "left", "leftouter": "left", "right": "right", "rightouter": "right",
               "full": "full", "outer": "full", "fullouter": "full"}
#: A null key is spread over so many stand-ins.
NULL_SALTS = 64


def _norm_how(how: str) -> str:
    try:
        return _JOIN_KINDS[how.lower().replace("_", "")]
    except KeyError:
        raise ValueError(f"unsupported join kind {how!r}") from None


def full_outer_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str | None = None,
                    coalesce_key: bool = False, left_keys: DataFrame | None = None) -> DataFrame:
    """Full outer equi-join (``=``, nulls never match) in skew-tolerant form.

    ``coalesce_key=True`` gives USING semantics: a single key column named
    ``left_on`` holding whichever side's key is present.  Apart from the
    keys, the two sides' column names must be distinct (as for any join
    whose result is used by name).  ``left_keys``: a narrow frame with the
    column ``left_on`` holding the left side's keys, where one is at hand
    (a base scan instead of a joined frame).
    """
    right_on = right_on or left_on
    rk = right_on
    if rk == left_on or rk in left.columns:
        rk = f"__r_{right_on}"
        right = right.withColumnRenamed(right_on, rk)
    matched = left_join_spread_nulls(left, right, left_on, rk)
    out = matched.unionByName(unmatched(right, rk, left if left_keys is None else left_keys, left_on),
                              allowMissingColumns=True)
    if coalesce_key:
        cols = [F.coalesce(F.col(left_on), F.col(rk)).alias(left_on) if c == left_on else F.col(c)
                for c in out.columns if c != rk]
        return out.select(*cols)
    if rk != right_on:
        out = out.withColumnRenamed(rk, right_on)
    return out


def unmatched(right: DataFrame, right_on: str, left: DataFrame, left_on: str) -> DataFrame:
    """Rows of ``right`` whose key ``left`` never has (its distinct keys are reduced map-side)."""
    keys = left.select(F.col(left_on).alias("__lk")).where(F.col("__lk").isNotNull()).distinct()
    return right.join(keys, right[right_on] == keys["__lk"], "left_anti")


def left_join_spread_nulls(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """``left LEFT JOIN right ON left_on = right_on`` (distinct column names), one evaluation of each side.

    A null key never matches ``=``, but in a shuffle all null keys hash to
    one task; a second join column is 0 for every row with a key and a hash
    of the row for the others, which spreads them.
    """
    salt = F.when(F.col(left_on).isNull(), F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(NULL_SALTS)) + 1)
    spread = left.withColumn("__ls", F.coalesce(salt, F.lit(0)).cast("int"))
    other = right.withColumn("__rs", F.lit(0))
    return spread.join(other, (F.col(left_on) == F.col(right_on)) & (F.col("__ls") == F.col("__rs")), "left") \
        .drop("__ls", "__rs")


def join_media_users_full(exploded_posts: DataFrame, media: DataFrame, users: DataFrame) -> DataFrame:
    """Posts (one row per media key) FULL OUTER media USING ``media_key``, FULL OUTER users on the author.

    Media that no post has carry no author, so they go around the users join,
    and the users without posts follow from the posts' own authors: each full
    outer join reads the posts once more, for their keys only.
    """
    other = media.withColumnRenamed("media_key", "__r_media_key")
    matched = left_join_spread_nulls(exploded_posts, other, "media_key", "__r_media_key").drop("__r_media_key")
    whole = left_join_spread_nulls(matched, users, "author_id", "users_id")
    return (whole
            .unionByName(unmatched(media, "media_key", exploded_posts, "media_key"), allowMissingColumns=True)
            .unionByName(unmatched(users, "users_id", exploded_posts, "author_id"), allowMissingColumns=True))


def equi_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str | None = None,
              how: str = "full", coalesce_key: bool = False) -> DataFrame:
    """Equi-join dispatch; ``full`` uses :func:`full_outer_join`, ``left``
    spreads null keys."""
    h = _norm_how(how)
    right_on = right_on or left_on
    if h == "full":
        return full_outer_join(left, right, left_on, right_on, coalesce_key)
    if coalesce_key and right_on == left_on:
        if h == "right":
            return right.join(left, left_on, "left")
        if h == "left":
            return left_join_null_split(left, right, left_on)
        return left.join(right, left_on, h)
    if h == "left" and right_on not in left.columns:
        return left_join_spread_nulls(left, right, left_on, right_on)
    return left.join(right, left[left_on] == right[right_on], h)


def join_media(exploded_posts: DataFrame, media: DataFrame, how: str = "full") -> DataFrame:
    """Posts (one row per media key) with media, USING ``media_key``."""
    return equi_join(exploded_posts, media, "media_key", "media_key", how, coalesce_key=True)


def join_users(posts: DataFrame, users: DataFrame, how: str = "full") -> DataFrame:
    """Posts with users on ``author_id = users_id``; both keys kept."""
    return equi_join(posts, users, "author_id", "users_id", how)


def split_null_keys(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows with a null key).

    Null-key rows can never match an ``=`` join; sending them around the join
    keeps them out of the shuffle (where they would all hash to one task).
    """
    return df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())


def left_join_null_split(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left LEFT JOIN right USING key`` with null-key left rows bypassing the join."""
    keyed, unkeyed = split_null_keys(left, key)
    return keyed.join(right, key, "left").unionByName(unkeyed, allowMissingColumns=True)


# -- interval joins ---------------------------------------------------------

def _secs(x) -> float:
    if isinstance(x, timedelta):
        return x.total_seconds()
    return float(x)


def _key_match(lk: Column, rk: Column, null_safe: bool) -> Column:
    return lk.eqNullSafe(rk) if null_safe else (lk == rk)


def _time_match(lt: Column, rt: Column, lower: float, upper: float) -> Column:
    return (lt >= rt + seconds(lower)) & (lt <= rt + seconds(upper))


class _Buckets:
    """Time buckets of width ``w`` seconds for one interval condition."""

    def __init__(self, lower: float, upper: float, bucket_seconds: float | None):
        self.lower, self.upper = lower, upper
        self.w = max(1, int(bucket_seconds or max(upper - lower, 1.0)))

    def own(self, df: DataFrame, tcol: str) -> DataFrame:
        e = epoch_seconds(F.col(tcol), df.schema[tcol].dataType)
        return df.withColumn("__b", F.floor(e / self.w))

    def spread_right(self, df: DataFrame, tcol: str) -> DataFrame:
        # a right row at t matches left times in [t + lower, t + upper]
        e = epoch_seconds(F.col(tcol), df.schema[tcol].dataType)
        lo = F.floor((e + F.lit(self.lower) - 1) / self.w).cast("bigint")
        hi = F.floor((e + F.lit(self.upper) + 1) / self.w).cast("bigint")
        return df.withColumn("__b", F.explode(F.sequence(lo, hi)))

    def spread_left(self, df: DataFrame, tcol: str) -> DataFrame:
        # a left row at t matches right times in [t - upper, t - lower]
        e = epoch_seconds(F.col(tcol), df.schema[tcol].dataType)
        lo = F.floor((e - F.lit(self.upper) - 1) / self.w).cast("bigint")
        hi = F.floor((e - F.lit(self.lower) + 1) / self.w).cast("bigint")
        return df.withColumn("__b", F.explode(F.sequence(lo, hi)))


def interval_join(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str,
                  left_time: str, right_time: str, lower=0, upper=60, how: str = "left",
                  null_safe: bool = False, bucket_seconds: float | None = None) -> DataFrame:
    """Rows of ``left``/``right`` whose keys match and whose times satisfy
    ``right_time + lower <= left_time <= right_time + upper`` (seconds or
    ``timedelta``).  ``how`` is inner / left / right / full;
    ``null_safe=True`` matches a null key with a null key (``<=>``).

    Works on batch DataFrames; for streams use :func:`stream_interval_join`.
    Column names of the two sides must be distinct.
    """
    lower, upper = _secs(lower), _secs(upper)
    if upper < lower:
        raise ValueError("upper bound must not be below lower bound")
    h = _norm_how(how)
    bk = _Buckets(lower, upper, bucket_seconds)

    def cond(l: DataFrame, r: DataFrame) -> Column:
        return (_key_match(l[left_key], r[right_key], null_safe)
                & (l["__b"] == r["__b"])
                & _time_match(l[left_time], r[right_time], lower, upper))

    def joined(l: DataFrame, r: DataFrame, kind: str) -> DataFrame:
        return l.join(r, cond(l, r), kind).drop(l["__b"]).drop(r["__b"])

    if h in ("inner", "left"):
        return joined(bk.own(left, left_time), bk.spread_right(right, right_time), h)
    if h == "right":
        return joined(bk.spread_left(left, left_time), bk.own(right, right_time), "right")
    # full: every left row once (left join), plus right rows that match nothing
    lpart = joined(bk.own(left, left_time), bk.spread_right(right, right_time), "left")
    l2, r2 = bk.spread_left(left, left_time), bk.own(right, right_time)
    unmatched = r2.join(l2, cond(l2, r2), "left_anti").drop("__b")
    return lpart.unionByName(unmatched, allowMissingColumns=True)


def stream_interval_join(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str,
                         left_time: str, right_time: str, lower=0, upper=60, how: str = "left",
                         null_safe: bool = False, bucket_seconds: float | None = None,
                         bucketed: bool = True) -> DataFrame:
    """Stream-stream interval join (both sides need watermarks).

    The state store keeps rows per join key, and every arriving row is
    compared with all stored rows of its key; a hot key (the null key of a
    null-safe join, a viral media item) makes that quadratic.  So the time
    bucket joins the key, as in the batch form: state is split per
    (key, bucket), and the range condition still drives watermark eviction.
    Inner / left / right joins replicate the side that cannot come out
    unmatched.  A full outer join is the bucketed left join plus the
    right-only rows of the bucketed right join (two joins, each side kept
    exactly once where it may be unmatched).

    With plain ``=`` the condition gets ``IS NOT NULL`` on both keys: a
    stream-stream outer join would otherwise pair null keys.
    """
    lower, upper = _secs(lower), _secs(upper)
    h = _norm_how(how)

    def one(l: DataFrame, r: DataFrame, kind: str, replicate: str | None) -> DataFrame:
        if replicate is not None:
            bk = _Buckets(lower, upper, bucket_seconds)
            if replicate == "left":
                l, r = bk.spread_left(l, left_time), bk.own(r, right_time)
            else:
                l, r = bk.own(l, left_time), bk.spread_right(r, right_time)
            r = r.withColumnRenamed("__b", "__rb")
        c = _key_match(l[left_key], r[right_key], null_safe)
        if not null_safe:
            c = c & l[left_key].isNotNull() & r[right_key].isNotNull()
        if replicate is not None:
            c = c & (l["__b"] == r["__rb"])
        c = c & _time_match(l[left_time], r[right_time], lower, upper)
        out = l.join(r, c, {"inner": "inner", "left": "left_outer", "right": "right_outer",
                            "full": "full_outer"}[kind])
        return out.drop("__b", "__rb") if replicate is not None else out

    if not bucketed:
        return one(left, right, h, None)
    if h in ("inner", "left"):
        return one(left, right, h, "right")
    if h == "right":
        return one(left, right, "right", "left")
    matched_and_left = one(left, right, "left", "right")
    marked = left.withColumn("__lpresent", F.lit(True))
    right_only = (one(marked, right, "right", "left")
                  .where(F.col("__lpresent").isNull()).drop("__lpresent"))
    return matched_and_left.unionByName(right_only)
