"""Event-time window aggregations (the same functions serve batch and streams).

Batch sliding windows are computed by pre-aggregating: every window
boundary is a multiple of g = gcd(length, slide), so all rows of one
g-bucket fall in exactly the same windows.  Counting per (keys, g-bucket)
first and then spreading each bucket's partial count over its
ceil(length/slide) windows turns "Expand every row x5, then aggregate"
into "aggregate, Expand the much smaller partials, aggregate"; all the
words of one post share a bucket, so the first aggregation already folds
repeats map-side.  Streams keep ``window()`` so the watermark can evict
state.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from .aggregates import MEDIA_TYPE_COLUMNS
from .joins import left_join_spread_nulls

_UNITS = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000,
          "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000}


def duration_micros(text: str) -> int:
    """'25 seconds' / '1 minute' / '2 hours' -> microseconds."""
    m = re.fullmatch(r"\s*(\d+)\s*([a-z]+?)s?\s*", text.lower())
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"unsupported duration {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def bucket_micros(length: str, slide: str) -> int:
    """Width of the buckets that every window of (length, slide) is made of."""
    return math.gcd(duration_micros(length), duration_micros(slide))


def _to_micros(ts: Column, ntz: bool) -> Column:
    """Microseconds since 1970-01-01; a TIMESTAMP_NTZ is read field by field
    (date, hour, minute, second) so no session time zone is involved."""
    if ntz:
        return (F.unix_date(F.to_date(ts)).cast("bigint") * 86_400_000_000
                + F.hour(ts).cast("bigint") * 3_600_000_000 + F.minute(ts).cast("bigint") * 60_000_000
                + (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("bigint"))
    return F.unix_micros(ts)


def _from_micros(us: Column, ntz: bool) -> Column:
    if ntz:   # TIMESTAMP_NTZ + day-time interval is plain arithmetic; the interval is a product of integers
        return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.expr("INTERVAL '0.000001' SECOND") * us
    return F.timestamp_micros(us)


def sliding_agg(df: DataFrame, keys: tuple[str, ...], time_col: str, length: str, slide: str,
                partials: dict[str, Column]) -> DataFrame:
    """Batch sliding-window aggregation of additive partials.

    ``partials`` maps output names to aggregate expressions whose results
    add up across buckets (counts, sums).  Output: keys, ``window`` struct
    (start, end) like ``window()``, and one column per partial.  Rows with
    a null time fall out, as with ``window()``.
    """
    L, S = duration_micros(length), duration_micros(slide)
    g = math.gcd(L, S)
    n = -(-L // S)
    ntz = isinstance(df.schema[time_col].dataType, TimestampNTZType)
    us = _to_micros(F.col(time_col), ntz)
    pre = (df.where(F.col(time_col).isNotNull())
           .groupBy(*keys, (us - F.pmod(us, F.lit(g))).alias("_b"))
           .agg(*[e.alias(name) for name, e in partials.items()]))
    spread = (pre.select(*keys, "_b", *partials, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_i"))
              .withColumn("_s", F.col("_b") - F.pmod("_b", F.lit(S)) - F.col("_i") * S)
              .where(F.col("_s") + L > F.col("_b")))
    out = spread.groupBy(*keys, "_s").agg(*[F.sum(name).cast("bigint").alias(name) for name in partials])
    window = F.struct(_from_micros(F.col("_s"), ntz).alias("start"),
                      _from_micros(F.col("_s") + L, ntz).alias("end")).alias("window")
    return out.select(*keys, window, *partials)


def two_level_agg(df: DataFrame, keys: tuple[str, ...], time_col: str, length1: str, slide1: str,
                  length2: str, slide2: str, partials: dict[str, Column]) -> DataFrame:
    """Window over window in one pass (batch).

    Equal to :func:`sliding_agg` at (length1, slide1) followed by
    :func:`rewindow` at (length2, slide2): a bucket's partial belongs to
    each first-level window containing it, and that window's time
    (end - 1 microsecond) to each second-level window containing it.  One
    aggregation per bucket, one Expand of the (few) partials, one final
    aggregation -- the first-level table is never built.
    """
    L1, S1 = duration_micros(length1), duration_micros(slide1)
    L2, S2 = duration_micros(length2), duration_micros(slide2)
    g = math.gcd(L1, S1)
    n1, n2 = -(-L1 // S1), -(-L2 // S2)
    ntz = isinstance(df.schema[time_col].dataType, TimestampNTZType)
    us = _to_micros(F.col(time_col), ntz)
    pre = (df.where(F.col(time_col).isNotNull())
           .groupBy(*keys, (us - F.pmod(us, F.lit(g))).alias("_b"))
           .agg(*[e.alias(name) for name, e in partials.items()]))
    lvl1 = (pre.select(*keys, "_b", *partials, F.explode(F.sequence(F.lit(0), F.lit(n1 - 1))).alias("_i"))
            .withColumn("_s1", F.col("_b") - F.pmod("_b", F.lit(S1)) - F.col("_i") * S1)
            .where(F.col("_s1") + L1 > F.col("_b"))
            .select(*keys, *partials, (F.col("_s1") + (L1 - 1)).alias("_wt")))
    lvl2 = (lvl1.select(*keys, *partials, "_wt", F.explode(F.sequence(F.lit(0), F.lit(n2 - 1))).alias("_j"))
            .withColumn("_s", F.col("_wt") - F.pmod("_wt", F.lit(S2)) - F.col("_j") * S2)
            .where(F.col("_s") + L2 > F.col("_wt")))
    out = lvl2.groupBy(*keys, "_s").agg(*[F.sum(name).cast("bigint").alias(name) for name in partials])
    window = F.struct(_from_micros(F.col("_s"), ntz).alias("start"),
                      _from_micros(F.col("_s") + L2, ntz).alias("end")).alias("window")
    return out.select(*keys, window, *partials)


#: A time block is so many times as wide as the span of a row's windows: few rows are copied to two blocks.
BLOCK_SPANS = 10
#: Bytes of text that one task counts, and from which the words of a block are dealt over all tasks.
TASK_BYTES, HOT_BYTES = 4_000_000, 32_000_000
#: Rows of (word, bucket) counts that one task spreads over its windows.
TASK_ROWS = 500_000


def _blocks(b: Column, before: int, after: int, slide: int) -> Column:
    """Starts of the blocks that own a window of bucket ``b``: a window is owned by the block it starts in.

    The bucket's windows start after ``b - before`` and not after ``b + after``.
    """
    width = F.lit(_block_width(before, after, slide))
    first, last = b - F.lit(before - 1), b + F.lit(after)
    return F.sequence(first - F.pmod(first, width), last - F.pmod(last, width), width)


def _block_width(before: int, after: int, slide: int) -> int:
    return slide * -(-BLOCK_SPANS * (before + after) // slide)


def _spread(rows: DataFrame, length: int, slide: int, count_col: str = "count") -> DataFrame:
    """Bucket counts summed over the sliding windows that start in their block (no shuffle if dealt by block)."""
    width = _block_width(length, 0, slide)
    return (rows.select("_blk", "word", "_b", count_col, F.explode(F.sequence(F.lit(0), F.lit(-(-length // slide) - 1))).alias("_i"))
            .withColumn("_s", F.col("_b") - F.pmod("_b", F.lit(slide)) - F.col("_i") * slide)
            .where((F.col("_s") + length > F.col("_b")) & (F.col("_s") >= F.col("_blk")) & (F.col("_s") < F.col("_blk") + width))
            .groupBy("_blk", "word", "_s").agg(F.sum(count_col).cast("bigint").alias("count")))


def _spread_two_level(rows: DataFrame, length1: int, slide1: int, length2: int, slide2: int) -> DataFrame:
    """Bucket counts summed over the second-level windows that start in their block.

    A bucket counts in a second-level window once for each first-level window
    that holds it and whose time (end - 1 microsecond) the other one holds:
    so many multiples of ``slide1`` lie between the bounds of its start.
    """
    width = _block_width(length2, length1 - 1, slide2)
    b, s = F.col("_b"), F.col("_s")
    last = b + (length1 - 1)
    low = F.greatest(b, s) - (length1 - 1)
    high = F.least(b, s + (length2 - length1))
    multiple = high - F.pmod(high, F.lit(slide1))
    below = (low - 1) - F.pmod(low - 1, F.lit(slide1))
    times = ((multiple - below) / slide1).cast("bigint")
    n = -(-(length1 + length2) // slide2)
    return (rows.select("_blk", "word", "_b", "count", F.explode(F.sequence(F.lit(0), F.lit(n))).alias("_i"))
            .withColumn("_s", last - F.pmod(last, F.lit(slide2)) - F.col("_i") * slide2)
            .where((s >= F.col("_blk")) & (s < F.col("_blk") + width))
            .withColumn("_n", times).where(F.col("_n") > 0)
            .groupBy("_blk", "word", "_s").agg(F.sum(F.col("count") * F.col("_n")).cast("bigint").alias("count")))


def text_window_counts(posts: DataFrame, words: Callable[..., DataFrame], sizes: DataFrame | None = None,
                       time_col: str = "created_at", length: str = "25 seconds", slide: str = "5 seconds",
                       length2: str | None = None, slide2: str | None = None) -> DataFrame:
    """Words of the posts' texts per sliding window (batch); with ``length2`` per window over these windows.

    ``words(rows, keep=columns)`` splits the texts.  Not the words but the
    posts are shuffled, to the time blocks whose windows they are in (one or
    two of them); a block's words are then split, counted per bucket and
    summed over its windows without another exchange.  The words of a block
    of very much text are dealt by word as well.  ``sizes``: time and
    ``n_bytes`` of every text, where there is a cheaper source than the posts.
    """
    L, S = duration_micros(length), duration_micros(slide)
    two = length2 is not None
    L2, S2 = (duration_micros(length2), duration_micros(slide2)) if two else (L, S)
    g = math.gcd(L, S)
    before, after = L2, (L - 1 if two else 0)
    ntz = isinstance(posts.schema[time_col].dataType, TimestampNTZType)

    def dealt(df: DataFrame, col: str) -> DataFrame:
        us = _to_micros(F.col(time_col), ntz)
        rows = df.where(F.col(time_col).isNotNull()).select(col, (us - F.pmod(us, F.lit(g))).alias("_b"))
        return rows.select(col, "_b", F.explode(_blocks(F.col("_b"), before, after, S2)).alias("_blk"))

    if sizes is None:
        sizes = posts.select(time_col, F.octet_length("text").alias("n_bytes"))
    per_block = dealt(sizes, "n_bytes").groupBy("_blk").agg(F.sum("n_bytes").alias("n"))
    total = per_block.agg(F.sum("n")).first()[0] or 0
    # at most a thousand blocks
    hot = [r[0] for r in per_block.where(F.col("n") > max(HOT_BYTES, total / 1000)).collect()] if total > HOT_BYTES else []
    tasks = max(1, -(-total // TASK_BYTES))

    def counted(rows: DataFrame) -> DataFrame:
        n = rows.groupBy("_blk", "word", "_b").agg(F.count(F.lit(1)).alias("count"))
        return _spread_two_level(n, L, S, L2, S2) if two else _spread(n, L, S)

    rows, keep = dealt(posts, "text"), ("_blk", "_b")
    if hot:
        is_hot = F.col("_blk").isin(hot)
        out = counted(words(rows.where(~is_hot).repartition(tasks, "_blk"), keep=keep)).unionByName(
            counted(words(rows.where(is_hot), keep=keep).repartition(tasks, "_blk", "word")))
    else:
        out = counted(words(rows.repartition(tasks, "_blk"), keep=keep))
    window = F.struct(_from_micros(F.col("_s"), ntz).alias("start"), _from_micros(F.col("_s") + L2, ntz).alias("end"))
    return out.select("word", window.alias("window"), "count")


def sliding_counts(df: DataFrame, keys: tuple[str, ...], time_col: str,
                   length: str = "25 seconds", slide: str = "5 seconds",
                   watermark: str | None = None) -> DataFrame:
    """``groupBy(*keys, window(time, length, slide)).count()``.

    Streams: ``window()`` with the watermark (if any) so old state is
    dropped.  Batch: the pre-aggregated form of :func:`sliding_agg`.
    """
    if df.isStreaming:
        src = df.withWatermark(time_col, watermark) if watermark else df
        return src.groupBy(*keys, F.window(time_col, length, slide).alias("window")).agg(
            F.count(F.lit(1)).alias("count"))
    return sliding_agg(df, keys, time_col, length, slide, {"count": F.count(F.lit(1))})


def bucket_counts(df: DataFrame, keys: tuple[str, ...], time_col: str, length: str = "25 seconds",
                  slide: str = "5 seconds", watermark: str | None = None) -> DataFrame:
    """Tumbling counts per (keys, gcd(length, slide) bucket) -- the additive
    partials of sliding windows.  As a stream in complete mode this keeps
    ceil(length/slide) times fewer state rows than ``window(length, slide)``
    and no Expand runs on the stateful path; :func:`expand_buckets` turns
    each emitted result table into the sliding-window counts."""
    g = math.gcd(duration_micros(length), duration_micros(slide))
    src = df.withWatermark(time_col, watermark) if (watermark and df.isStreaming) else df
    return src.groupBy(*keys, F.window(time_col, f"{g} microseconds").alias("bucket")).agg(
        F.count(F.lit(1)).alias("count"))


def expand_buckets(partials: DataFrame, keys: tuple[str, ...], length: str = "25 seconds",
                   slide: str = "5 seconds", count_col: str = "count") -> DataFrame:
    """Sliding-window counts from :func:`bucket_counts` output (batch)."""
    src = partials.select(*keys, F.col("bucket.start").alias("_bs"), count_col)
    return sliding_agg(src, keys, "_bs", length, slide, {"count": F.sum(count_col)})


def bucket_rows(partials: DataFrame, keys: tuple[str, ...], count_col: str = "count") -> DataFrame:
    """:func:`bucket_counts` as plain rows: keys, bucket start in microseconds, count."""
    return partials.select(*keys, F.unix_micros("bucket.start").alias("bucket_us"), count_col)


def expand_bucket_rows(rows: DataFrame, keys: tuple[str, ...], length: str = "25 seconds", slide: str = "5 seconds",
                       count_col: str = "count") -> DataFrame:
    """Sliding-window counts from rows of (keys, bucket, count), as :func:`bucket_rows` gives them: one shuffle.

    Rows of the same keys and bucket add up.  Words are shuffled with their
    time block, so the rows are shuffled once and not those of every window.
    """
    L, S = duration_micros(length), duration_micros(slide)
    if keys == ("word",):
        tasks = max(1, -(-rows.count() // TASK_ROWS))
        dealt = rows.select("word", F.col("bucket_us").alias("_b"), count_col,
                            F.explode(_blocks(F.col("bucket_us"), L, 0, S)).alias("_blk")).repartition(tasks, "_blk", "word")
        out = _spread(dealt, L, S, count_col)
        window = F.struct(_from_micros(F.col("_s"), False).alias("start"), _from_micros(F.col("_s") + L, False).alias("end"))
        return out.select("word", window.alias("window"), "count")
    b = F.col("bucket_us")
    out = (rows.select(*keys, "bucket_us", count_col, F.explode(F.sequence(F.lit(0), F.lit(-(-L // S) - 1))).alias("_i"))
           .withColumn("_s", b - F.pmod(b, F.lit(S)) - F.col("_i") * S).where(F.col("_s") + L > b)
           .groupBy(*keys, "_s").agg(F.sum(count_col).cast("bigint").alias("count")))
    window = F.struct(_from_micros(F.col("_s"), False).alias("start"), _from_micros(F.col("_s") + L, False).alias("end"))
    return out.select(*keys, window.alias("window"), "count")


def flatten_window(df: DataFrame, window_col: str = "window") -> DataFrame:
    """Replace the window struct with ``window_start`` / ``window_end`` columns."""
    others = [c for c in df.columns if c != window_col]
    return df.select(*others, F.col(f"{window_col}.start").alias("window_start"),
                     F.col(f"{window_col}.end").alias("window_end"))


def rewindow(counts: DataFrame, keys: tuple[str, ...], length: str = "1 minute",
             slide: str = "30 seconds", window_col: str = "window",
             count_col: str = "count") -> DataFrame:
    """Window over window: re-bucket each first-level window by its event
    time (end - 1 microsecond, as ``window_time``) and add up the counts.
    On a stream ``window_time`` keeps the watermark, so append mode works."""
    if counts.isStreaming:
        wt = counts.withColumn("_wt", F.window_time(window_col))
        return (wt.groupBy(*keys, F.window("_wt", length, slide).alias("window"))
                .agg(F.sum(count_col).cast("bigint").alias("count")))
    wt = counts.withColumn("_wt", F.col(f"{window_col}.end") - F.expr("INTERVAL '0.000001' SECOND"))
    return sliding_agg(wt, keys, "_wt", length, slide, {"count": F.sum(count_col)})


def windowed_media_counts(rows: DataFrame, time_col: str, keys: tuple[str, ...] = ("username",),
                          length: str = "5 minutes", slide: str = "2 minutes") -> DataFrame:
    """Photo / video / gif counts per (window, keys)."""
    parts = {c: F.count_if(F.col("media_type") == t) for t, c in MEDIA_TYPE_COLUMNS}
    if rows.isStreaming:
        return rows.groupBy(F.window(time_col, length, slide).alias("window"), *keys).agg(
            *[e.alias(c) for c, e in parts.items()])
    return sliding_agg(rows, keys, time_col, length, slide, parts)


def windowed_media_counts_by_key(posts: DataFrame, media_messages: DataFrame, users: DataFrame,
                                 length: str = "5 minutes", slide: str = "2 minutes") -> DataFrame:
    """Photo / video / gif counts per (window, username) of posts LEFT JOIN media messages on the key alone.

    Posts are counted per (media key, author, time bucket) and messages per
    (media key, type); the join multiplies the counts instead of building
    the pairs, and what is left is counted per bucket before it is spread
    over windows.
    """
    g = math.gcd(duration_micros(length), duration_micros(slide))
    ntz = isinstance(posts.schema["created_at"].dataType, TimestampNTZType)
    us = _to_micros(F.col("created_at"), ntz)
    rows = posts.where(F.col("created_at").isNotNull()).select(
        "author_id", F.explode_outer("data_media_keys").alias("media_key"), (us - F.pmod(us, F.lit(g))).alias("_b"))
    seen = rows.groupBy("media_key", "author_id", "_b").agg(F.count(F.lit(1)).alias("_n"))
    sums = {c: F.count_if(F.col("media_type") == t) for t, c in MEDIA_TYPE_COLUMNS}
    sent = media_messages.where(F.col("media_key").isNotNull()).groupBy("media_key").agg(
        *[e.alias(c) for c, e in sums.items()])
    met = seen.join(sent, "media_key", "left").groupBy("author_id", "_b").agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(0)) * F.col("_n")).alias(c) for c in sums])
    named = met.join(users.select("users_id", "username"), F.col("author_id") == F.col("users_id"), "left")
    timed = named.withColumn("_t", _from_micros(F.col("_b"), ntz))
    return sliding_agg(timed, ("username",), "_t", length, slide, {c: F.sum(c) for c in sums})


def interval_pair_counts(left: DataFrame, right: DataFrame, *, left_key: str, right_key: str, left_time: str,
                         right_time: str, lower: int = 0, upper: int = 60, null_safe: bool = False,
                         carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``left LEFT JOIN right`` on the key and the interval, counted without building them (batch).

    One row per (``left_time``, ``carry``...) of a key with ``n_rows``, the
    number of joined rows.  A sweep over the merged times of each key: the
    right rows are summed up to both ends of a left row's interval, and the
    difference is the number it meets.  A key is cut into time buckets as
    wide as the interval, each with the right rows of the bucket before, so a
    hot key (the null key of a null-safe join too) is spread over time and a
    task's sums start anew.  Rows of ``left`` without a time meet nothing and
    have no bucket; they come out too.
    """
    ntz = isinstance(left.schema[left_time].dataType, TimestampNTZType)
    rntz = isinstance(right.schema[right_time].dataType, TimestampNTZType)
    low, high = int(lower * 1_000_000), int(upper * 1_000_000)
    width = max(1_000_000, high - low)
    bucket = lambda us: us - F.pmod(us, F.lit(width))  # noqa: E731  (its start)
    t, r = _to_micros(F.col(left_time), ntz), _to_micros(F.col(right_time), rntz)

    nothing = [F.lit(None).cast(left.schema[c].dataType).alias(c) for c in (left_time, *carry)]
    rights = right.where(F.col(right_time).isNotNull())
    if not null_safe:
        rights = rights.where(F.col(right_key).isNotNull())
    # a right row at r is met by left times from r + low to r + high
    rights = rights.select(F.col(right_key).alias("_k"), r.alias("_at"),
                           F.explode(F.sequence(bucket(r + low), bucket(r + high), F.lit(width))).alias("_b"),
                           F.lit(1).alias("_side"), F.lit(1).alias("_one"), *nothing)
    probes = left.where(F.col(left_time).isNotNull()).select(
        F.col(left_key).alias("_k"), left_time, *carry, t.alias("_t"),
        # before the right rows at t - high, behind those at t - low
        F.explode(F.array(F.struct((t - high).alias("at"), F.lit(0).alias("side")),
                          F.struct((t - low).alias("at"), F.lit(2).alias("side")))).alias("_p"))
    probes = probes.select("_k", F.col("_p.at").alias("_at"), bucket(F.col("_t")).alias("_b"),
                           F.col("_p.side").alias("_side"), F.lit(0).alias("_one"), left_time, *carry)
    upto = Window.partitionBy("_k", "_b").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    summed = rights.unionByName(probes).withColumn("_sum", F.sum("_one").over(upto)).where(F.col("_side") != 1)
    met = summed.groupBy("_k", "_b", left_time, *carry).agg(
        F.sum(F.col("_sum") * (F.col("_side") - 1)).alias("_pairs"), F.count_if(F.col("_side") == 2).alias("_rows"))
    # equal left rows meet equally many: either all of them stand for pairs, or each comes out once
    counted = met.select(left_time, *carry, F.greatest("_pairs", "_rows").cast("bigint").alias("n_rows"))
    timeless = left.where(F.col(left_time).isNull()).select(left_time, *carry, F.lit(1).cast("bigint").alias("n_rows"))
    return counted.unionByName(timeless)


def interval_text_window_counts(posts: DataFrame, media: DataFrame, *, left_key: str, right_key: str, left_time: str,
                                right_time: str, upper: int = 60, null_safe: bool = True, text: str = "text",
                                length: str = "20 seconds", slide: str = "5 seconds") -> DataFrame:
    """Rows of the interval join per (text, window of the post time): texts are grouped by digest and join at the end."""
    keyed = posts.withColumn("_digest", F.sha2(F.col(text), 256))
    pairs = interval_pair_counts(keyed, media, left_key=left_key, right_key=right_key, left_time=left_time,
                                 right_time=right_time, upper=upper, null_safe=null_safe, carry=("_digest",))
    counts = sliding_agg(pairs, ("_digest",), left_time, length, slide, {"count": F.sum("n_rows")})
    texts = keyed.where(F.col(text).isNotNull()).select(F.col("_digest").alias("_d"), text).dropDuplicates(["_d"])
    return left_join_spread_nulls(counts, texts, "_digest", "_d").select(text, "window", "count")
