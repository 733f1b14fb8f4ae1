"""Word counts by time block: one shuffle of texts, equal to window(), hot blocks and stateless stream counts."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from postlens.operators import messages as msg
from postlens.operators import windows as W
from postlens.operators import words as WD
from postlens.sources.streams import read_stream
from postlens.streaming import jobs
from postlens.streaming.results import ResultTable
from postlens.streaming.runner import append_records
from test_streams import _post_rows

COLS = ("word", "window_start", "window_end", "count")


def _posts(spark, ntz=True):
    t = F.timestamp_seconds(F.col("id") * 37 % 1501 - 700 + F.col("id") / 8)
    text = F.when(F.col("id") % 7 > 0, F.concat(F.lit("a b a w"), F.col("id") % 3))
    df = spark.range(300).select(F.when(F.col("id") % 50 > 0, t).alias("created_at"), text.alias("text"))
    return df.withColumn("created_at", F.col("created_at").cast("timestamp_ntz")) if ntz else df


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("ntz", [False, True])
@pytest.mark.parametrize("length,slide", [("25 seconds", "5 seconds"), ("25 seconds", "10 seconds"), ("1 minute", "1 minute")])
def test_equal_to_window_function(spark, monkeypatch, length, slide, ntz, hot):
    if hot:
        monkeypatch.setattr(W, "HOT_BYTES", 60)
    posts = _posts(spark, ntz)
    ours = W.flatten_window(W.text_window_counts(posts, WD.raw_words, length=length, slide=slide))
    words = WD.raw_words(posts, keep=("created_at",))
    want = W.flatten_window(words.groupBy("word", F.window("created_at", length, slide).alias("window")).count())
    assert rows(ours, *COLS) == rows(want, *COLS)


@pytest.mark.parametrize("spans", [("25 seconds", "5 seconds", "1 minute", "30 seconds"),
                                   ("25 seconds", "10 seconds", "45 seconds", "20 seconds"),
                                   ("1 minute", "30 seconds", "20 seconds", "15 seconds")])
def test_two_levels_equal_to_window_over_window(spark, spans):
    l1, s1, l2, s2 = spans
    posts = _posts(spark)
    ours = W.flatten_window(W.text_window_counts(posts, WD.clean_words, length=l1, slide=s1, length2=l2, slide2=s2))
    words = WD.clean_words(posts, keep=("created_at",))
    want = W.flatten_window(W.rewindow(W.sliding_agg(words, ("word",), "created_at", l1, s1, {"count": F.count(F.lit(1))}),
                                       ("word",), l2, s2))
    assert rows(ours, *COLS) == rows(want, *COLS)


def test_the_words_and_windows_are_not_shuffled(spark):
    """One exchange, of the posts: the counts are summed in the partitions the texts were dealt to."""
    for more in ({}, {"length2": "1 minute", "slide2": "30 seconds"}):
        plan = _plan(W.text_window_counts(_posts(spark), WD.clean_words, **more))
        assert plan.count("Exchange") == 1
    rows_ = spark.range(50).select(F.lit("w").alias("word"), (F.col("id") * 5_000_000).alias("bucket_us"), F.lit(1).alias("count"))
    assert _plan(W.expand_bucket_rows(rows_, ("word",))).count("Exchange") == 1


def test_the_stream_of_counts_has_no_state(spark, scratch):
    path = scratch("posts")
    append_records(_post_rows(spark, [("p1", "x y x", 3)]), path)
    posts, writer, read = jobs.word_count_updates(msg.decode_records(read_stream(spark, "files", path=path)))
    assert "Aggregate" not in posts._jdf.queryExecution().analyzed().toString()


def test_added_counts_are_summed_and_a_repeated_batch_counts_once(spark, scratch):
    t = ResultTable(spark, scratch("add"), ("word",), compact_every=2, adding=True)
    for i, n in enumerate((1, 2, 3, 4)):
        for _ in range(2):
            t.write_batch(spark.createDataFrame([("a", n), ("a", n), (None, 1)], "word string, n long"), i)
    assert sorted(rows(t.read(), "word", "n"), key=str) == sorted([("a", 20), (None, 4)], key=str)
