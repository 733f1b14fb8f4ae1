"""spark-submit entry points.

  spark-submit --py-files postlens.zip postlens/cli.py marts --envelopes hdfs:///out/ --format avro \
      --out hdfs:///marts/            (or --jdbc-url ... --jdbc-user u --jdbc-password-file f)
  spark-submit --py-files postlens.zip postlens/cli.py posts --servers kafka:9092 --checkpoint hdfs:///ck/p \
      --jdbc-url jdbc:postgresql://host/db --jdbc-table posts --jdbc-user u --jdbc-password-file f
      (likewise users, media, join-users, join-users-media, full-outer, media-counts, right-outer;
      --out DIR or --out-topic T instead of --jdbc-url)
  spark-submit --py-files postlens.zip postlens/cli.py word-count --servers kafka:9092 --topic posts \
      --checkpoint hdfs:///ck/wc
  spark-submit --py-files postlens.zip postlens/cli.py join-users-media --servers kafka:9092 \
      --checkpoint hdfs:///ck/j --out hdfs:///j/

(Or ``python -m postlens.cli ...`` with pyspark installed.)  The Avro and
Kafka connectors come from ``--packages`` matching the Spark version.
Checkpoints and outputs must be on storage every executor and a restarted
driver can reach.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from postlens.session import build_session


def _marts(spark: SparkSession, a: argparse.Namespace) -> None:
    from postlens.plans.marts import build_marts, flatten_once, write_marts
    from postlens.sources.envelopes import read_envelopes
    from postlens.streaming.sinks import jdbc_options, jdbc_write, write_table

    env = read_envelopes(spark, a.envelopes, a.format)
    profile: dict[str, dict] = {}
    flat = flatten_once(spark, env, dedupe_media=a.dedupe_media, latest_user=a.latest_user, profile=profile)
    marts = build_marts(flat["posts"], flat["users"], flat["media"])
    if a.jdbc_url:
        write_marts(marts, lambda n, df: jdbc_write(df, jdbc_options(a.jdbc_url, n, a.jdbc_user, _password(a),
                                                                    a.jdbc_driver)), profile)
    else:
        write_marts(marts, lambda n, df: write_table(df, f"{a.out.rstrip('/')}/{n}", a.out_format), profile)
    for name, seen in profile.items():
        print(f"{name}: {seen['rows']} rows")


def _source(spark: SparkSession, a: argparse.Namespace, topic: str):
    """Kafka topic, or ``--files DIR/<topic>`` holding files with the Kafka record schema."""
    from postlens.operators.messages import decode_records
    from postlens.sources.streams import read_stream
    if a.files:
        return decode_records(read_stream(spark, "files", path=f"{a.files.rstrip('/')}/{topic}"))
    return decode_records(read_stream(spark, "kafka", topic=topic, servers=a.servers,
                                      starting_offsets=a.starting_offsets,
                                      fail_on_data_loss=not a.tolerate_data_loss,
                                      max_offsets_per_trigger=a.max_offsets_per_trigger))


def _start(a: argparse.Namespace, df, mode: str = "append", key: str | None = None, write=None):
    """The job's sink: JDBC table, Kafka topic, files or console."""
    from postlens.streaming import sinks
    common = {"mode": mode, "trigger_seconds": a.trigger_seconds, "available_now": a.available_now}
    if a.jdbc_url:
        writer = sinks.batch_jdbc_writer(_jdbc(a))
        return sinks.start_stream(df, "foreachBatch", checkpoint=a.checkpoint, foreach_batch=writer, **common)
    if a.out_topic:
        return sinks.kafka_sink(df, a.servers, a.out_topic, a.checkpoint, key_col=key, **common)
    if write is not None:
        return sinks.start_stream(df, "foreachBatch", checkpoint=a.checkpoint, foreach_batch=write, **common)
    if a.out:
        return sinks.start_stream(df, a.out_format, path=a.out, checkpoint=a.checkpoint, **common)
    return sinks.start_stream(df, "console", checkpoint=a.checkpoint, options={"truncate": "false"}, **common)


def _jdbc(a: argparse.Namespace) -> dict:
    from postlens.streaming.sinks import jdbc_options
    return jdbc_options(a.jdbc_url, a.jdbc_table, a.jdbc_user, _password(a), a.jdbc_driver)


def _password(a: argparse.Namespace) -> str | None:
    if not a.jdbc_password_file:
        return None
    with open(a.jdbc_password_file) as f:
        return f.read().strip()


def _posts(spark: SparkSession, a: argparse.Namespace) -> None:
    from postlens.streaming import jobs
    df = jobs.posts_stream(_source(spark, a, a.posts_topic)).drop("data_media_keys")
    _start(a, df, key="tweet_id").awaitTermination()


def _users(spark: SparkSession, a: argparse.Namespace) -> None:
    from postlens.streaming import jobs
    _start(a, jobs.users_stream(_source(spark, a, a.users_topic)), key="users_id").awaitTermination()


def _media(spark: SparkSession, a: argparse.Namespace) -> None:
    from postlens.streaming import jobs
    _start(a, jobs.media_stream(_source(spark, a, a.media_topic)), key="media_key").awaitTermination()


def _join_users(spark: SparkSession, a: argparse.Namespace) -> None:
    from postlens.streaming import jobs
    job = jobs.join_users_job(_source(spark, a, a.posts_topic), _source(spark, a, a.users_topic),
                              user_bound=a.user_bound, watermark=a.watermark if a.user_bound else None)
    _start(a, job).awaitTermination()


def _join_users_media(spark: SparkSession, a: argparse.Namespace) -> None:
    from postlens.streaming import jobs
    job = jobs.join_users_media_job(_source(spark, a, a.posts_topic), _source(spark, a, a.users_topic),
                                    _source(spark, a, a.media_topic), watermark=a.watermark, user_bound=a.user_bound)
    _start(a, job).awaitTermination()


def _three(spark: SparkSession, a: argparse.Namespace):
    return [_source(spark, a, t) for t in (a.posts_topic, a.users_topic, a.media_topic)]


def _full_outer(spark: SparkSession, a: argparse.Namespace) -> None:
    from postlens.streaming import jobs
    job = jobs.full_outer_job(*_three(spark, a), watermark=a.watermark, bound=a.media_bound, user_bound=a.user_bound or a.media_bound)
    _start(a, job, key="tweet_id").awaitTermination()


def _media_counts(spark: SparkSession, a: argparse.Namespace) -> None:
    from postlens.operators.windows import flatten_window
    from postlens.streaming import jobs
    job = jobs.media_counts_full_outer_job(*_three(spark, a), watermark=a.watermark, bound=a.media_bound,
                                           user_bound=a.user_bound or a.media_bound, length=a.length, slide=a.slide)
    _start(a, flatten_window(job), key="username").awaitTermination()


def _right_outer(spark: SparkSession, a: argparse.Namespace) -> None:
    from postlens.streaming import jobs
    job = jobs.right_outer_job(*_three(spark, a), watermark=a.watermark, bound=a.media_bound, user_bound=a.user_bound or a.media_bound)
    _start(a, job, key="tweet_id").awaitTermination()


def _word_count(spark: SparkSession, a: argparse.Namespace) -> None:
    """Sliding word counts.

    To files, complete mode keeps its result in a maintained table (read it
    with ``word-count-result``), update mode the newest row per key, append
    mode closed windows.  To JDBC, complete mode replaces the table's rows,
    the other modes add each trigger's.  To Kafka, key and count as text.
    """
    from postlens.operators.windows import flatten_window
    from postlens.streaming import jobs, sinks
    posts = _source(spark, a, a.topic)
    more = {"clean": a.clean, "per_media_rows": a.per_media}
    if a.mode == "complete" and a.out:
        partials, writer, _ = jobs.word_count_updates(posts, length=a.length, slide=a.slide, **more)
        _start(a, partials, "update", write=writer(jobs.word_count_table(spark, a.out))).awaitTermination()
        return
    counts = flatten_window(jobs.word_count_job(posts, a.watermark, a.length, a.slide, **more))
    common = {"mode": a.mode, "trigger_seconds": a.trigger_seconds, "available_now": a.available_now}
    if a.out_topic:
        sinks.kafka_counts_sink(counts, a.servers, a.out_topic, a.checkpoint, **common).awaitTermination()
        return
    if a.jdbc_url and a.mode == "complete":
        write = sinks.jdbc_complete_writer(_jdbc(a))
        sinks.start_stream(counts, "foreachBatch", checkpoint=a.checkpoint, foreach_batch=write, **common).awaitTermination()
        return
    keys = ("word", "window_start", "window_end")
    write = sinks.batch_upsert_writer(a.out, keys) if a.mode == "update" and a.out else None
    _start(a, counts, a.mode, key="word", write=write).awaitTermination()


def _word_count_result(spark: SparkSession, a: argparse.Namespace) -> None:
    """The sliding counts of a table that ``word-count --mode complete --out`` maintains, as of its last batch."""
    from postlens.operators.windows import expand_bucket_rows, flatten_window
    from postlens.streaming import jobs
    from postlens.streaming.sinks import write_table
    rows = jobs.word_count_table(spark, a.table).read()
    write_table(flatten_window(expand_bucket_rows(rows, ("word",), a.length, a.slide)), a.out, a.out_format)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="postlens")
    sub = p.add_subparsers(dest="cmd", required=True)

    m = sub.add_parser("marts", help="flatten envelopes once and write the nine marts")
    m.add_argument("--envelopes", required=True)
    m.add_argument("--format", default="avro")
    m.add_argument("--out")
    m.add_argument("--out-format", default="parquet")
    m.add_argument("--jdbc-url")
    m.add_argument("--jdbc-user")
    m.add_argument("--jdbc-password-file")
    m.add_argument("--jdbc-driver")
    m.add_argument("--dedupe-media", action="store_true")
    m.add_argument("--latest-user", action="store_true")

    streams = {"posts": _posts, "users": _users, "media": _media, "join-users": _join_users,
               "join-users-media": _join_users_media, "full-outer": _full_outer, "media-counts": _media_counts,
               "right-outer": _right_outer, "word-count": _word_count}
    for name in streams:
        s = sub.add_parser(name)
        s.add_argument("--servers")
        s.add_argument("--files", help="folder with one sub-folder of record files per topic")
        s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
        s.add_argument("--checkpoint", required=True)
        s.add_argument("--out")
        s.add_argument("--out-format", default="parquet")
        s.add_argument("--out-topic", help="Kafka topic for the result")
        s.add_argument("--jdbc-url")
        s.add_argument("--jdbc-table")
        s.add_argument("--jdbc-user")
        s.add_argument("--jdbc-password-file")
        s.add_argument("--jdbc-driver")
        s.add_argument("--starting-offsets", default="latest")
        s.add_argument("--tolerate-data-loss", action="store_true")
        s.add_argument("--max-offsets-per-trigger", type=int)
        s.add_argument("--trigger-seconds", type=float)
        s.add_argument("--watermark", default="30 seconds")
        s.add_argument("--posts-topic", default="posts")
        s.add_argument("--users-topic", default="users")
        s.add_argument("--media-topic", default="media")
        if name in ("full-outer", "media-counts", "right-outer"):
            s.add_argument("--media-bound", type=int, default=60, help="seconds a media message may be older than the post")
        if name == "media-counts":
            s.add_argument("--length", default="5 minutes")
            s.add_argument("--slide", default="2 minutes")
        if name.startswith("join") or name in ("full-outer", "media-counts", "right-outer"):
            s.add_argument("--user-bound", type=int, help="seconds a user message may be older than the post")
        if name == "word-count":
            s.add_argument("--topic", default="posts")
            s.add_argument("--length", default="25 seconds")
            s.add_argument("--slide", default="5 seconds")
            s.add_argument("--mode", default="complete", choices=("append", "update", "complete"))
            s.add_argument("--clean", action="store_true", help="count cleaned words")
            s.add_argument("--per-media", action="store_true", help="count a post's words once per media key")

    r = sub.add_parser("word-count-result", help="the counts of a table that word-count --mode complete --out maintains")
    r.add_argument("--table", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--out-format", default="parquet")
    r.add_argument("--length", default="25 seconds")
    r.add_argument("--slide", default="5 seconds")

    a = p.parse_args(argv)
    if a.cmd == "marts" and not (a.out or a.jdbc_url):
        p.error("marts needs --out or --jdbc-url")
    if a.cmd == "join-users-media" and not (a.out or a.jdbc_url or a.out_topic):
        p.error("join-users-media needs --out, --out-topic or --jdbc-url")
    if a.cmd in streams and not (a.servers or a.files):
        p.error("streams need --servers (Kafka) or --files")
    if a.cmd in streams and sum(bool(x) for x in (a.out, a.jdbc_url, a.out_topic)) > 1:
        p.error("give one of --out, --jdbc-url and --out-topic")
    if a.cmd in streams and (a.jdbc_url and not a.jdbc_table or a.out_topic and not a.servers):
        p.error("--jdbc-url needs --jdbc-table, --out-topic needs --servers")
    spark = build_session(master=None, app=f"postlens-{a.cmd}")
    ({"marts": _marts, "word-count-result": _word_count_result} | streams)[a.cmd](spark, a)


if __name__ == "__main__":
    main()
