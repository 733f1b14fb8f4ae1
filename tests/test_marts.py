"""The batch job end to end: envelopes -> flatten once -> nine marts -> tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from postlens.operators import aggregates as agg
from postlens.plans import catalog
from postlens.plans.marts import build_marts, flatten_once, write_marts
from postlens.sources.envelopes import build_envelopes, read_envelopes, write_envelopes
from postlens.sources.tables import Tables
from postlens.streaming.sinks import write_table


def test_marts_from_envelopes(spark, scratch):
    t = Tables(spark, SF_SMALL)
    env_path = scratch("env")
    write_envelopes(build_envelopes(t.posts, t.users, t.media), env_path, "json")
    env = read_envelopes(spark, env_path, "json")
    flat = flatten_once(spark, env, scratch("flat"))
    assert flat["posts"].count() == t.posts.count()
    marts = build_marts(flat["posts"], flat["users"], flat["media"])
    assert sorted(marts) == [f"df{i}" for i in range(1, 10)]
    out = scratch("marts")
    write_marts(marts, lambda name, df: write_table(df, f"{out}/{name}"))
    for name in marts:
        assert spark.read.parquet(f"{out}/{name}").count() > 0, name
    # df5 over the envelope users equals the same mart over the adapter users who posted
    posters = t.users.join(t.posts.select("author_id").distinct(), F.col("users_id") == F.col("author_id"),
                           "left_semi")
    expect = agg.interaction_totals(t.posts, posters)
    assert rows(spark.read.parquet(f"{out}/df5")) == rows(expect)


def test_flatten_once_options(spark, scratch):
    t = Tables(spark, SF_SMALL)
    env = build_envelopes(t.posts, t.users, t.media.unionByName(t.media.limit(3)))
    flat = flatten_once(spark, env, scratch("flat2"), dedupe_media=True, latest_user=True)
    assert flat["media"].count() == t.media.count()
    assert flat["users"].count() == flat["users"].select("users_id").distinct().count()


def test_cli_marts_to_files(spark, scratch):
    from postlens import cli
    t = Tables(spark, SF_SMALL)
    env_path, out = scratch("cli-env"), scratch("cli-out")
    write_envelopes(build_envelopes(t.posts, t.users, t.media), env_path, "parquet")
    cli.main(["marts", "--envelopes", env_path, "--format", "parquet", "--out", out])
    assert spark.read.parquet(f"{out}/df5").count() > 0
    assert spark.read.parquet(f"{out}/df8").count() > 0


def test_cli_word_count_from_record_files(spark, scratch):
    from postlens import cli
    from postlens.operators import messages as msg
    from postlens.streaming.runner import append_records
    t = Tables(spark, SF_SMALL)
    root, out, ck = scratch("cli-rec"), scratch("cli-wc"), scratch("cli-ck")
    append_records(msg.post_records(t.posts), f"{root}/posts")
    cli.main(["word-count", "--files", root, "--checkpoint", ck, "--out", out, "--available-now"])
    res = scratch("cli-wr")
    cli.main(["word-count-result", "--table", out, "--out", res])
    want = catalog.REGISTRY["word_count_sliding"](spark, SF_SMALL)
    cols = ("word", "window_start", "count")
    got = spark.read.parquet(res).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    assert rows(got, *cols) == rows(want, *cols)
    up, ck2 = scratch("cli-wu"), scratch("cli-wuc")
    cli.main(["word-count", "--files", root, "--checkpoint", ck2, "--out", up, "--available-now", "--mode", "update"])
    from postlens.streaming.sinks import read_upserts
    newest = read_upserts(spark, up, ("word", "window_start", "window_end"))
    assert newest.count() == got.count() and newest.agg({"count": "sum"}).first() == got.agg({"count": "sum"}).first()


def test_cli_ingest_and_join_users_from_record_files(spark, scratch):
    from postlens import cli
    from postlens.operators import messages as msg
    from postlens.streaming.runner import append_records
    t = Tables(spark, SF_SMALL)
    root = scratch("cli-i")
    append_records(msg.post_records(t.posts), f"{root}/posts")
    append_records(msg.user_records(t.user_messages_per_post), f"{root}/users")
    append_records(msg.media_records(t.media_messages), f"{root}/media")
    found = {}
    for cmd, more in (("posts", ()), ("users", ()), ("media", ()), ("join-users", ())):
        out = scratch(f"cli-{cmd}")
        cli.main([cmd, "--files", root, "--checkpoint", scratch(f"ck-{cmd}"), "--out", out, "--available-now", *more])
        found[cmd] = spark.read.parquet(out)
    assert found["users"].count() == t.user_messages.count()
    assert found["media"].count() == t.media_messages.count()
    assert found["posts"].select("tweet_id").distinct().count() == t.posts.count()
    assert found["join-users"].count() > 0


def test_session_settings_in_a_fresh_process():
    import subprocess
    import sys
    code = ("from postlens.session import build_session, DEFAULT_CONF\n"
            "s = build_session(master='local[1]')\n"
            "assert all(s.conf.get(k) == v for k, v in DEFAULT_CONF.items() if k.startswith('spark.sql'))\n"
            "assert s.conf.get('spark.sql.shuffle.partitions') == '200'\n"
            "import inspect, postlens.cli as c\n"
            "assert 'build_session(master=None' in inspect.getsource(c.main)\n")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


def test_cli_join_users_media_from_record_files(spark, scratch):
    from postlens import cli
    from postlens.operators import messages as msg
    from postlens.streaming.runner import append_records
    t = Tables(spark, SF_SMALL)
    root, out, ck = scratch("cli-j"), scratch("cli-jo"), scratch("cli-jc")
    append_records(msg.post_records(t.posts), f"{root}/posts")
    append_records(msg.user_records(t.user_messages), f"{root}/users")
    append_records(msg.media_records(t.media_messages), f"{root}/media")
    cli.main(["join-users-media", "--files", root, "--checkpoint", ck, "--out", out, "--available-now"])
    got = spark.read.parquet(out)
    assert got.count() > 0 and set(got.columns) == {"text", "username", "media_key"}


def test_mart_df7_is_the_catalogs_join(spark):
    """df7 equals the three-way join built one full outer join at a time, fan-out, unknown authors and repeats included."""
    from fixtures import frames
    from postlens.operators import flatten as fl
    from postlens.operators import joins as J
    posts, users, media = frames(spark)
    posts = posts.unionByName(posts.where("tweet_id = 'p1'"))
    got = build_marts(posts, users, media)["df7"]
    want = J.join_users(J.join_media(fl.explode_media(posts, outer=False), media, "full"), users, "full")
    assert rows(got) == rows(want.select(*got.columns))


def test_cli_outer_jobs_from_record_files(spark, scratch):
    from postlens import cli
    from postlens.operators import messages as msg
    from postlens.streaming.runner import append_records
    t = Tables(spark, SF_SMALL)
    root = scratch("cli-o")
    append_records(msg.post_records(t.posts), f"{root}/posts")
    append_records(msg.user_records(t.user_messages), f"{root}/users")
    append_records(msg.media_records(t.media_messages), f"{root}/media")
    for cmd, col in (("full-outer", "username"), ("media-counts", "photo_count"), ("right-outer", "c_media_key")):
        out = scratch(f"cli-{cmd}")
        cli.main([cmd, "--files", root, "--checkpoint", scratch(f"ck-{cmd}"), "--out", out, "--available-now", "--watermark", "1 second"])
        assert col in spark.read.parquet(out).columns and spark.read.parquet(out).count() > 0


def test_cli_word_count_options_and_sinks(spark, scratch, monkeypatch):
    from postlens import cli
    from postlens.operators import messages as msg
    from postlens.streaming import sinks
    from postlens.streaming.runner import append_records
    t = Tables(spark, SF_SMALL)
    root = scratch("cli-w")
    append_records(msg.post_records(t.posts), f"{root}/posts")
    totals = {}
    for flag in ([], ["--clean"], ["--per-media"]):
        out, res = scratch("cli-wo"), scratch("cli-wres")
        cli.main(["word-count", "--files", root, "--checkpoint", scratch("ck"), "--out", out, "--available-now", *flag])
        cli.main(["word-count-result", "--table", out, "--out", res])
        totals[tuple(flag)] = spark.read.parquet(res).agg(F.sum("count")).first()[0]
    assert totals[("--clean",)] < totals[()] < totals[("--per-media",)]

    tables = []
    monkeypatch.setattr(sinks, "jdbc_complete_writer", lambda o: lambda batch, i: tables.append((o["dbtable"], batch.columns, batch.count())))
    cli.main(["word-count", "--files", root, "--checkpoint", scratch("ck"), "--available-now", "--jdbc-url", "jdbc:x://y", "--jdbc-table", "wc"])
    assert tables[-1][0] == "wc" and tables[-1][1] == ["word", "count", "window_start", "window_end"] and tables[-1][2] > 0

    sent = []
    real = msg.encode_counts

    def kafka(counts, servers, topic, checkpoint, **kw):
        encoded = real(counts)
        sent.append((servers, topic, encoded.columns, kw["mode"]))
        return sinks.start_stream(encoded, "foreachBatch", checkpoint=checkpoint, foreach_batch=lambda b, i: b.write.format("noop").mode("overwrite").save(), **kw)

    monkeypatch.setattr(sinks, "kafka_counts_sink", kafka)
    cli.main(["word-count", "--files", root, "--servers", "k:1", "--checkpoint", scratch("ck"), "--available-now", "--out-topic", "counts"])
    assert sent == [("k:1", "counts", ["key", "value"], "complete")]
    for bad in (["--out", "x", "--jdbc-url", "jdbc:x", "--jdbc-table", "t"], ["--out", "x", "--out-topic", "t", "--servers", "k"]):
        with pytest.raises(SystemExit):
            cli.main(["word-count", "--files", root, "--checkpoint", "c", *bad])


def test_jdbc_complete_replaces_the_table(spark):
    from postlens.streaming import sinks
    calls = []
    write = sinks.jdbc_complete_writer({"dbtable": "t"}, lambda df, o, mode: calls.append((df.count(), o, mode)))
    df = spark.createDataFrame([("a", 1)], "word string, n int")
    write(df, 0)
    write(df, 0)
    assert calls == [(1, {"dbtable": "t", "truncate": "true"}, "overwrite")] * 2
