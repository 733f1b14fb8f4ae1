"""Maintained result tables: commits, retries, compaction, and the word count kept in one."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from postlens.operators import messages as msg
from postlens.operators import windows as W
from postlens.sources.streams import read_stream
from postlens.streaming import jobs
from postlens.streaming.results import ResultTable
from postlens.streaming.runner import append_records, run_available_now
from test_streams import LATE, _one_file_each, _post_rows

COUNTS = "word string, n long"


def counts(spark, **n):
    return spark.createDataFrame(list(n.items()), COUNTS)


@pytest.mark.parametrize("growing", [False, True])
def test_last_version_of_each_key_counts(spark, scratch, growing):
    t = ResultTable(spark, scratch("rt"), ("word",), compact_every=3, growing=growing)
    assert t.read(counts(spark, a=1).schema).count() == 0
    for i, batch in enumerate(({"a": 1, "b": 1}, {"a": 2}, {"b": 5, "c": 1}, {}, {"a": 7}, {"c": 9})):
        t.write_batch(counts(spark, **batch) if batch else counts(spark, a=1).limit(0), i)
    assert rows(t.read(), "word", "n") == [("a", 7), ("b", 5), ("c", 9)]
    assert len(t.folders()) <= 4                          # compacted on the way
    t.compact()
    assert len(t.folders()) == 1 and rows(t.read(), "word", "n") == [("a", 7), ("b", 5), ("c", 9)]


def test_last_write_wins_even_if_smaller(spark, scratch):
    t = ResultTable(spark, scratch("rt"), ("word",))
    for i in range(12):
        t.write_batch(counts(spark, a=100 - i), i)
    assert rows(t.read(), "word", "n") == [("a", 89)]


def test_a_failed_batch_is_not_seen_and_a_repeated_one_counts_once(spark, scratch):
    t = ResultTable(spark, scratch("rt"), compact_every=0)
    t.write_batch(counts(spark, a=1), 0)
    before = rows(t.read(), "word", "n")
    bad = counts(spark, b=1, c=2).select("word", F.when(F.col("word") == "c", F.raise_error(F.lit("lost"))).otherwise(F.col("n")).alias("n"))
    with pytest.raises(Exception, match="lost"):
        t.write_batch(bad, 1)
    assert rows(t.read(), "word", "n") == before          # a reader in between: the batch before
    # files are there but the commit is not: the writer died between the two
    counts(spark, z=1).write.parquet(f"{t.path}/data/1-dead")
    assert rows(t.read(), "word", "n") == before
    for _ in range(2):
        t.write_batch(counts(spark, b=1, c=2), 1)
    assert rows(t.read(), "word", "n") == [("a", 1), ("b", 1), ("c", 2)]


def test_a_reader_keeps_its_snapshot_through_a_compaction(spark, scratch):
    t = ResultTable(spark, scratch("rt"), compact_every=0)
    for i in range(3):
        t.write_batch(counts(spark, **{f"w{i}": i}), i)
    opened = t.read()
    t.compact()
    t.write_batch(counts(spark, w9=9), 3)
    assert opened.count() == 3 and t.read().count() == 4
    fails = ResultTable(spark, scratch("rt2"))
    with pytest.raises(ValueError):
        fails.read()


def test_incremental_word_count_equals_complete_mode(spark, scratch):
    items = [(f"p{i}", "x y x z" if i % 2 else "y q", 3 * i) for i in range(40)] + LATE
    path = _one_file_each(spark, scratch, items[:5])
    append_records(_post_rows(spark, items[5:25]), path)
    src = lambda: msg.decode_records(read_stream(spark, "files", path=path, max_files_per_trigger=2))
    table = jobs.word_count_table(spark, scratch("inc"), compact_every=2)
    ck, written = scratch("incc"), []

    def run():
        partials, writer, read = jobs.word_count_updates(src())
        write = writer(table)

        def counted(batch, batch_id):
            written.append(batch.count())
            write(batch, batch_id)
            write(batch, batch_id)                        # every batch is replayed once
        run_available_now(partials, table.path, ck, "update", write=counted)
        return W.flatten_window(read(table))

    run()
    append_records(_post_rows(spark, items[25:]), path)
    got = run()                                           # restarted from the checkpoint
    out = run_available_now(jobs.word_count_job(src()), scratch("cmp"), scratch("cmpc"), "complete")
    want = W.flatten_window(spark.read.parquet(out))
    cols = ("word", "window_start", "window_end", "count")
    assert rows(got, *cols) == rows(want, *cols)
    assert sum(written) < 2 * table.read().count()        # changed rows only, not the result again and again


def test_expand_bucket_rows_for_any_window(spark):
    df = spark.range(200).select(F.concat(F.lit("w"), F.col("id") % 3).alias("word"),
                                 F.timestamp_seconds(F.col("id") * 7 % 501 + F.col("id") / 8).alias("created_at"))
    for length, slide in (("25 seconds", "5 seconds"), ("25 seconds", "10 seconds"), ("1 minute", "1 minute")):
        parts = W.bucket_rows(W.bucket_counts(df, ("word",), "created_at", length, slide), ("word",))
        ours = W.flatten_window(W.expand_bucket_rows(parts, ("word",), length, slide))
        want = W.flatten_window(df.groupBy("word", F.window("created_at", length, slide).alias("window")).count())
        cols = ("word", "window_start", "window_end", "count")
        assert rows(ours, *cols) == rows(want, *cols)
