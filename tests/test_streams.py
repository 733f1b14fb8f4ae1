"""Structured Streaming behaviour: late rows, output modes, engine limits,
restart from checkpoint, idempotent foreachBatch, null keys in stream joins."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from postlens.operators import joins as J
from postlens.operators import messages as msg
from postlens.operators import windows as W
from postlens.operators import words as WD
from postlens.sources.streams import read_stream
from postlens.streaming import jobs, sinks
from postlens.streaming.runner import append_records, run_available_now

T0 = datetime(2024, 1, 1)


def _post_rows(spark, items):
    """items: (id, text, seconds or None) -> post records."""
    data = [(i, T0 + timedelta(seconds=s) if s is not None else None, txt, 0, 0, 0, 0, "u1", None)
            for i, txt, s in items]
    df = spark.createDataFrame(data, "tweet_id string, created_at timestamp, text string, retweet_count int, "
                                     "reply_count int, like_count int, quote_count int, author_id string, "
                                     "data_media_keys array<string>")
    return msg.post_records(df)


def _one_file_each(spark, scratch, items):
    path = scratch("late-in")
    for it in items:
        append_records(_post_rows(spark, [it]).coalesce(1), path)
    return path


LATE = [("alpha", "alpha", 10), ("b", "b", 5000), ("b2", "b2", 5001), ("late", "late", 20), ("c", "c", 9000),
        ("n", "n", None)]


def _word_counts_complete(spark, scratch):
    path = _one_file_each(spark, scratch, LATE)
    src = msg.decode_records(read_stream(spark, "files", path=path, max_files_per_trigger=1))
    out, ck = scratch("late-out"), scratch("late-ck")
    return spark.read.parquet(run_available_now(jobs.word_count_job(src), out, ck, "complete"))


def test_late_rows_kept_in_complete_mode(spark, scratch):
    out = _word_counts_complete(spark, scratch)
    words = {r.word for r in out.collect()}
    assert "late" in words and "n" not in words            # null time falls out of every window
    # property: sum of window counts = windows per row x rows with a time
    assert out.agg(F.sum("count")).first()[0] == 5 * 5


def test_late_rows_dropped_in_update_mode(spark, scratch):
    path = _one_file_each(spark, scratch, LATE)
    src = msg.decode_records(read_stream(spark, "files", path=path, max_files_per_trigger=1))
    q = sinks.start_stream(jobs.word_count_job(src), "memory", mode="update", query_name="late_update",
                           available_now=True)
    q.awaitTermination(300)
    got = {r.word for r in spark.sql("select * from late_update").collect()}
    assert "late" not in got and {"alpha", "b", "b2", "c"} <= got


def test_append_emits_only_closed_windows(spark, scratch):
    path = _one_file_each(spark, scratch, LATE)
    src = msg.decode_records(read_stream(spark, "files", path=path, max_files_per_trigger=1))
    out, ck = scratch("app-out"), scratch("app-ck")
    run_available_now(jobs.word_count_job(src), out, ck, "append")
    got = spark.read.parquet(out)
    words = {r.word for r in got.collect()}
    assert "alpha" in words and "late" not in words and "c" not in words   # c's windows are still open


def _two_streams(spark, scratch):
    a = spark.createDataFrame([("k", T0)], "k string, ta timestamp")
    pa = scratch("sa")
    a.write.parquet(pa)
    b = spark.createDataFrame([("k", T0)], "k2 string, tb timestamp")
    pb = scratch("sb")
    b.write.parquet(pb)
    sa = spark.readStream.schema(a.schema).parquet(pa)
    sb = spark.readStream.schema(b.schema).parquet(pb)
    return sa, sb


def test_engine_limits_still_hold(spark, scratch):
    sa, sb = _two_streams(spark, scratch)
    ck = scratch("lim")
    # 1: stream-stream join + aggregation is not allowed in complete mode
    with pytest.raises(AnalysisException):
        sa.join(sb, sa.k == sb.k2).groupBy("k").count().writeStream.outputMode("complete") \
            .format("memory").queryName("lim1").option("checkpointLocation", ck + "/1").start()
    # 2: append-mode aggregation needs a watermark
    with pytest.raises(AnalysisException):
        sa.groupBy("k").count().writeStream.outputMode("append").format("memory") \
            .queryName("lim2").option("checkpointLocation", ck + "/2").start()
    # 4: sorting needs an aggregated stream in complete mode
    with pytest.raises(AnalysisException):
        sa.orderBy("k").writeStream.format("memory").queryName("lim4") \
            .option("checkpointLocation", ck + "/4").start()
    # 5: outer join needs watermark + range
    with pytest.raises(AnalysisException):
        sa.withWatermark("ta", "10 minutes").join(sb.withWatermark("tb", "10 minutes"),
                                                  sa.k == sb.k2, "left_outer") \
            .writeStream.format("memory").queryName("lim5").option("checkpointLocation", ck + "/5").start()


def test_stream_sort_after_aggregation_in_complete(spark, scratch):
    sa, _ = _two_streams(spark, scratch)
    q = sa.groupBy("k").count().orderBy(F.desc("count")).writeStream.outputMode("complete") \
        .format("memory").queryName("sorted_counts").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.sql("select * from sorted_counts").count() == 1


def test_full_outer_stream_join_now_supported_with_guard(spark, scratch):
    """Null keys: batch '=' never pairs them; the library guard keeps the
    stream full outer join equal to batch."""
    left = [(None, T0 + timedelta(seconds=10)), ("m1", T0 + timedelta(seconds=11)),
            ("__close", T0 + timedelta(hours=1))]
    right = [(None, T0 + timedelta(seconds=9)), ("m1", T0 + timedelta(seconds=9)),
             ("__close", T0 + timedelta(hours=1))]
    l = spark.createDataFrame(left, "lk string, lt timestamp")
    r = spark.createDataFrame(right, "rk string, rt timestamp")
    pl, pr = scratch("nl"), scratch("nr")
    l.limit(2).write.parquet(pl)
    r.limit(2).write.parquet(pr)
    append_records(l.where("lk = '__close'"), pl)
    append_records(r.where("rk = '__close'"), pr)
    files_l = len(spark.read.parquet(pl).inputFiles())
    sl = spark.readStream.schema(l.schema).option("maxFilesPerTrigger", 1).parquet(pl).withWatermark("lt", "30 seconds")
    sr = spark.readStream.schema(r.schema).option("maxFilesPerTrigger", 1).parquet(pr).withWatermark("rt", "30 seconds")
    assert files_l >= 2
    j = J.stream_interval_join(sl, sr, left_key="lk", right_key="rk", left_time="lt", right_time="rt",
                               lower=0, upper=60, how="full")
    out, ck = scratch("nfo"), scratch("nfoc")
    run_available_now(j, out, ck, "append")
    got = [(a, b) for a, b in rows(spark.read.parquet(out), "lk", "rk") if "__close" not in (a, b)]
    batch = J.interval_join(l, r, left_key="lk", right_key="rk", left_time="lt", right_time="rt",
                            lower=0, upper=60, how="full")
    want = [(a, b) for a, b in rows(batch, "lk", "rk") if "__close" not in (a, b)]
    assert got == want
    assert (None, None) in got          # the two null keys stay unpaired


def test_restart_resumes_from_checkpoint(spark, scratch):
    path = scratch("rs-in")
    append_records(_post_rows(spark, [("1", "x", 1)]).coalesce(1), path)
    out, ck = scratch("rs-out"), scratch("rs-ck")

    def run():
        src = msg.decode_records(read_stream(spark, "files", path=path))
        parsed = msg.parse_posts(src).select("tweet_id", "text")
        q = sinks.json_sink(parsed, out, ck, available_now=True)
        q.awaitTermination(120)

    run()
    append_records(_post_rows(spark, [("2", "y", 2)]).coalesce(1), path)
    run()
    run()   # nothing new: no duplicates
    got = spark.read.schema("tweet_id string, text string").json(out)
    assert rows(got) == [("1", "x"), ("2", "y")]


def test_foreach_batch_writer_is_idempotent(spark, scratch):
    path = scratch("fb")
    write = sinks.batch_table_writer(path)
    df = spark.createDataFrame([("a",), ("b",)], "w string")
    write(df, 0)
    write(df, 1)
    write(df, 1)          # replay of batch 1
    assert spark.read.parquet(path).count() == 4


def test_start_stream_requires_checkpoint(spark, scratch):
    sa, _ = _two_streams(spark, scratch)
    with pytest.raises(ValueError):
        sinks.start_stream(sa, "parquet", path=scratch("x"))
    with pytest.raises(ValueError):
        sinks.start_stream(sa, "memory", mode="sideways")


def test_console_sink_runs(spark, scratch):
    sa, _ = _two_streams(spark, scratch)
    q = sinks.start_stream(sa, "console", options={"truncate": "false", "numRows": "2"}, available_now=True)
    q.awaitTermination(60)
    assert not q.isActive


def test_jdbc_options_take_credentials_from_caller():
    o = sinks.jdbc_options("jdbc:postgresql://db:5432/x", "df1", user="u", password="p",
                           driver="org.postgresql.Driver")
    assert o == {"url": "jdbc:postgresql://db:5432/x", "dbtable": "df1", "user": "u", "password": "p",
                 "driver": "org.postgresql.Driver"}


def test_read_stream_kafka_options_validated(spark):
    with pytest.raises(ValueError):
        read_stream(spark, "kafka", topic="t")
    with pytest.raises(ValueError):
        read_stream(spark, "files")


def test_windowed_two_level_matches_direct(spark):
    """Window over window equals re-windowing the raw rows' window times."""
    df = spark.createDataFrame([("w", T0 + timedelta(seconds=s)) for s in (1, 7, 33, 61, 95)],
                               "word string, created_at timestamp")
    first = W.sliding_counts(df, ("word",), "created_at", "25 seconds", "5 seconds")
    second = W.rewindow(first, ("word",), "1 minute", "30 seconds")
    assert second.agg(F.sum("count")).first()[0] == 5 * 5 * 2


def test_partials_word_count_equals_window_word_count(spark, scratch):
    items = [(f"p{i}", "x y x z" if i % 2 else "y q", 3 * i) for i in range(40)] + LATE
    path = _one_file_each(spark, scratch, items[:5])
    append_records(_post_rows(spark, items[5:]), path)
    src = lambda: msg.decode_records(read_stream(spark, "files", path=path, max_files_per_trigger=2))
    out1, ck1 = scratch("wc1"), scratch("wc1c")
    out1 = run_available_now(jobs.word_count_job(src()), out1, ck1, "complete")
    partials, finish = jobs.word_count_partials_job(src())
    out2, ck2 = scratch("wc2"), scratch("wc2c")
    out2 = run_available_now(partials, out2, ck2, "complete", finish=finish)
    a = W.flatten_window(spark.read.parquet(out1))
    b = W.flatten_window(spark.read.parquet(out2))
    assert rows(a, "word", "window_start", "window_end", "count") == rows(b, "word", "window_start", "window_end", "count")


def _user_records(spark, items):
    df = spark.createDataFrame([(u, "d", "n", name, T0 + timedelta(seconds=s)) for u, name, s in items],
                               "users_id string, description string, name string, username string, user_ts timestamp")
    return msg.user_records(df)


def test_users_distinct_within_watermark(spark, scratch):
    path = scratch("uw")
    append_records(_user_records(spark, [("u1", "alice", 0), ("u1", "alice", 5), ("u2", "bob", 6)]), path)
    src = msg.decode_records(read_stream(spark, "files", path=path))
    exact = jobs.users_stream(src, with_time=True)
    bounded = jobs.users_stream(msg.decode_records(read_stream(spark, "files", path=path)),
                                within_watermark=True)
    o1, c1, o2, c2 = scratch("o1"), scratch("c1"), scratch("o2"), scratch("c2")
    run_available_now(exact, o1, c1)
    run_available_now(bounded, o2, c2)
    assert spark.read.parquet(o1).count() == 3          # time is part of the key
    assert spark.read.parquet(o2).count() == 2          # re-send within 30 s is a duplicate


def test_users_distinct_on_four_columns_keeps_late_users(spark, scratch):
    path, out, ck = scratch("ul"), scratch("ulo"), scratch("ulc")
    for u in (("u1", "alice", 5000), ("u1", "alice", 5001), ("u2", "bob", 0), ("u3", "carl", 9000), ("u2", "bob", 1)):
        append_records(_user_records(spark, [u]).coalesce(1), path)
    src = msg.decode_records(read_stream(spark, "files", path=path, max_files_per_trigger=1))
    run_available_now(jobs.users_stream(src), out, ck)
    assert rows(spark.read.parquet(out), "users_id") == [("u1",), ("u2",), ("u3",)]


def test_replay_comes_in_ordered_batches(spark):
    from conftest import SF_SMALL
    r = jobs.Replay(spark, SF_SMALL)
    assert len(r.cuts()) == jobs.REPLAY_BATCHES - 1
    seen = []
    q = (r.posts().writeStream.foreachBatch(lambda b, i: seen.append(tuple(b.agg(
        F.min("timestamp"), F.max("timestamp"), F.count("*")).first())))
        .trigger(availableNow=True).start())
    q.awaitTermination()
    data = [x for x in seen if x[2]]
    assert len(data) == jobs.REPLAY_BATCHES
    assert all(a[1] < b[0] for a, b in zip(data, data[1:]))
    assert sum(x[2] for x in data) == r.t.posts.count()


def test_rewindow_runs_on_a_stream_in_append_mode(spark, scratch):
    path, out, ck = scratch("rw"), scratch("rwo"), scratch("rwc")
    items = [(f"p{i}", "x y", 7 * i) for i in range(40)] + [("end", "end", 100_000), ("end2", "end2", 200_000)]
    append_records(_post_rows(spark, items[:40]), path)
    append_records(_post_rows(spark, items[40:41]).coalesce(1), path)
    append_records(_post_rows(spark, items[41:]).coalesce(1), path)
    src = lambda: msg.decode_records(read_stream(spark, "files", path=path, max_files_per_trigger=50))
    run_available_now(W.rewindow(jobs.word_count_job(src()), ("word",)), out, ck, "append")
    got = W.flatten_window(spark.read.parquet(out)).where("word in ('x', 'y')")
    static = msg.parse_posts(msg.decode_records(spark.read.parquet(path)))
    once = W.sliding_counts(WD.raw_words(static, keep=("created_at",)), ("word",), "created_at")
    want = W.flatten_window(W.rewindow(once, ("word",))).where("word in ('x', 'y')")
    assert rows(got, "word", "window_start", "count") == rows(want, "word", "window_start", "count")
    assert got.count() > 0


def test_jdbc_writer_repairs_a_batch_that_failed_half_way(spark):
    """A fake table that fails after its first partition, as an appending JDBC job can.  No database is run."""
    table, fail = [], [True]

    def delete(_, options, batch_id):
        table[:] = [r for r in table if r["batch_id"] != batch_id]

    def append(batch, options):
        got = batch.collect()
        if fail[0]:
            table.extend(got[:1])
            raise RuntimeError("lost")
        table.extend(got)

    write = sinks.batch_jdbc_writer({"dbtable": "t"}, delete, append)
    one = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "word string, count int")
    with pytest.raises(RuntimeError):
        write(one, 0)
    assert len(table) == 1
    fail[0] = False
    for batch_id in (0, 0, 1, 0):                        # retry, replays
        write(one, batch_id)
    assert sorted((r["word"], r["batch_id"]) for r in table) == [(w, i) for w in "abc" for i in (0, 1)]

    def broken(*_):
        raise PermissionError("no rights")

    with pytest.raises(PermissionError):
        sinks.batch_jdbc_writer({"dbtable": "t"}, broken, append)(one, 2)


def test_upserts_keep_the_newest_row_per_key(spark, scratch):
    path, keys = scratch("ups"), ("word",)
    write = sinks.batch_upsert_writer(path, keys)
    for i, counts in enumerate(({"a": 1, "b": 1}, {"a": 2}, {"b": 5, "c": 1})):
        write(spark.createDataFrame(list(counts.items()), "word string, count int"), i)
    assert rows(sinks.read_upserts(spark, path, keys), "word", "count") == [("a", 2), ("b", 5), ("c", 1)]


def test_join_users_bound_limits_matches(spark, scratch):
    pp, pu = scratch("jp"), scratch("ju")
    append_records(_post_rows(spark, [("1", "early", 5), ("2", "late", 500)]), pp)
    append_records(_user_records(spark, [("u1", "alice", 0)]), pu)
    posts = lambda: msg.decode_records(read_stream(spark, "files", path=pp))
    users = lambda: msg.decode_records(read_stream(spark, "files", path=pu))
    o1, c1, o2, c2 = scratch("jo1"), scratch("jc1"), scratch("jo2"), scratch("jc2")
    run_available_now(jobs.join_users_job(posts(), users()), o1, c1)
    run_available_now(jobs.join_users_job(posts(), users(), user_bound=60, watermark="30 seconds"), o2, c2)
    assert {r.text for r in spark.read.parquet(o1).collect()} == {"early", "late"}
    assert {r.text for r in spark.read.parquet(o2).collect()} == {"early"}


def test_per_media_rows_counts_words_once_per_media_key(spark, scratch):
    df = spark.createDataFrame([("1", T0, "hello world", 0, 0, 0, 0, "u1", ["m1", "m2"])],
                               "tweet_id string, created_at timestamp, text string, retweet_count int, "
                               "reply_count int, like_count int, quote_count int, author_id string, "
                               "data_media_keys array<string>")
    path = scratch("pm")
    append_records(msg.post_records(df), path)
    for per_media, expect in ((False, 5), (True, 10)):
        src = msg.decode_records(read_stream(spark, "files", path=path))
        out, ck = scratch("pmo"), scratch("pmc")
        out = run_available_now(jobs.word_count_job(src, per_media_rows=per_media), out, ck, "complete")
        got = spark.read.parquet(out).where("word = 'hello'").agg(F.sum("count")).first()[0]
        assert got == expect


def test_processing_time_trigger(spark, scratch):
    sa, _ = _two_streams(spark, scratch)
    q = sinks.start_stream(sa, "memory", query_name="ptrigger", trigger_seconds=1)
    try:
        q.processAllAvailable()
        assert spark.sql("select * from ptrigger").count() == 1
        assert q.lastProgress is not None
    finally:
        q.stop()


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_bucketed_stream_interval_join_equals_batch(spark, scratch, how):
    """The (key, time-bucket) stream join gives the batch interval join's rows,
    null-safe, with hot (and null) keys spread over buckets."""
    import random
    rnd = random.Random(11)
    keys = [None, "k0", "k1"]
    left = [(f"l{i}", rnd.choice(keys), T0 + timedelta(seconds=rnd.uniform(0, 300))) for i in range(60)]
    right = [(f"r{i}", rnd.choice(keys), T0 + timedelta(seconds=rnd.uniform(-60, 300))) for i in range(40)]
    close = T0 + timedelta(hours=2)
    l = spark.createDataFrame(left, "lid string, lk string, lt timestamp")
    r = spark.createDataFrame(right, "rid string, rk string, rt timestamp")
    pl, pr = scratch("bl"), scratch("br")
    l.coalesce(1).write.parquet(pl)
    r.coalesce(1).write.parquet(pr)
    append_records(spark.createDataFrame([("lclose", "zz", close)], l.schema), pl)
    append_records(spark.createDataFrame([("rclose", "zz", close)], r.schema), pr)
    sl = spark.readStream.schema(l.schema).option("maxFilesPerTrigger", 1).parquet(pl).withWatermark("lt", "30 seconds")
    sr = spark.readStream.schema(r.schema).option("maxFilesPerTrigger", 1).parquet(pr).withWatermark("rt", "30 seconds")
    j = J.stream_interval_join(sl, sr, left_key="lk", right_key="rk", left_time="lt", right_time="rt",
                               lower=0, upper=60, how=how, null_safe=True)
    out, ck = scratch("bo"), scratch("bc")
    run_available_now(j, out, ck, "append")
    got = [x for x in rows(spark.read.parquet(out), "lid", "rid") if "lclose" not in x and "rclose" not in x]
    want = rows(J.interval_join(l, r, left_key="lk", right_key="rk", left_time="lt", right_time="rt",
                                lower=0, upper=60, how=how, null_safe=True), "lid", "rid")
    assert got == want


def test_three_way_join_with_users_snapshot_equals_stream(spark, scratch):
    from conftest import SF_SMALL
    r = jobs.Replay(spark, SF_SMALL, closing=True)
    snap = r.t.user_messages.select("users_id", "username")
    static_job = jobs.join_users_media_job(r.posts(), None, r.media(), users_snapshot=snap)
    out, ck = scratch("snap"), scratch("snapc")
    run_available_now(static_job, out, ck)
    got = rows(spark.read.parquet(out).where("username is null or username != '__close'"))
    want = rows(jobs.stream_join_users_media(spark, SF_SMALL))
    assert got == want


def test_kafka_sink_needs_the_connector_here(spark, scratch):
    """No Kafka connector on this classpath: the sink fails at start with a
    data-source error instead of silently doing nothing."""
    sa, _ = _two_streams(spark, scratch)
    with pytest.raises(Exception) as err:
        q = sinks.kafka_sink(sa, "localhost:1", "t", scratch("kck"), key_col="k", available_now=True)
        q.awaitTermination(30)
    assert "kafka" in str(err.value).lower()


def test_batch_jdbc_writer_without_a_database_raises(spark):
    """The JDBC path is wired (the write is attempted) but no database is
    started here, so it must fail loudly rather than drop the batch."""
    write = sinks.batch_jdbc_writer(sinks.jdbc_options("jdbc:nosuchdb://nowhere/x", "wc"))
    df = spark.createDataFrame([("a", 1)], "word string, count int")
    with pytest.raises(Exception):
        write(df, 0)
