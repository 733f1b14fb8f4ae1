"""Joins whose state is kept for good: on disk, with digests in place of the texts."""

import glob

import pytest
from pyspark.sql import functions as F

from conftest import rows
from postlens.operators import messages as msg
from postlens.sources.streams import read_stream
from postlens.streaming import jobs
from postlens.streaming.runner import KEPT_STATE, append_records, run_available_now
from test_outer_streams import media, posts, users

TEXTS = ["whole text " * 50, "", None, "whole text " * 50, "other"]


def sources(spark, scratch):
    p = posts(spark, [(f"p{i}", 10 + 20 * i, f"u{i % 3}", [["m1"], None, ["m1", "m2"]][i % 3]) for i in range(12)])
    text = F.element_at(F.array(*[F.lit(t) for t in TEXTS]), (F.substring("tweet_id", 2, 9).cast("int") % len(TEXTS)) + 1)
    made = {"posts": msg.post_records(p.withColumn("text", text)),
            "users": msg.user_records(users(spark, [("u0", "n0", 1), ("u1", "n1", 1), ("u1", "second", 200)])),
            "media": msg.media_records(media(spark, [("m1", "photo", 20 * i) for i in range(12)]))}
    src = {}
    for name, records in made.items():
        path = scratch(name)
        for half in (0, 1):
            append_records(records.where(F.pmod(F.xxhash64("value", "timestamp"), F.lit(2)) == half).coalesce(1), path)
        src[name] = msg.decode_records(read_stream(spark, "files", path=path, max_files_per_trigger=1))
    return src


@pytest.mark.parametrize("job,cols", [
    (lambda s, **k: jobs.join_users_job(s["posts"], s["users"], hot=["u0"], salts=3, **k), ("username", "text", "created_at")),
    (lambda s, **k: jobs.join_users_media_job(s["posts"], s["users"], s["media"], watermark="1 hour", **k), ("text", "username", "media_key"))])
def test_late_texts_give_the_same_rows_from_state_on_disk(spark, scratch, job, cols):
    src = sources(spark, scratch)
    plain, late, found, ck = scratch("plain"), scratch("late"), scratch("texts"), scratch("ck")
    run_available_now(job(src), plain, scratch("ck0"), partitions=2)
    run_available_now(job(src, late_text=True), late, ck, partitions=2, conf=KEPT_STATE)
    run_available_now(jobs.texts_stream(src["posts"]), found, scratch("ck1"))
    digests = spark.read.parquet(late)
    assert digests.where(F.length("text") != 64).count() == 0               # no text was in the join's state
    out = jobs.with_texts(digests, spark.read.parquet(found))
    assert out.columns == digests.columns and rows(out, *cols) == rows(spark.read.parquet(plain), *cols) != []
    assert glob.glob(f"{ck}/state/*/*/*.zip") and not glob.glob(f"{ck}/state/**/*.delta", recursive=True)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != KEPT_STATE["spark.sql.streaming.stateStore.providerClass"]


def test_rows_without_a_text_stay(spark):
    texts = spark.createDataFrame([("a", "A"), ("a", "A"), ("b", "")], "digest string, text string")
    given = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "i int, text string")
    assert rows(jobs.with_texts(given, texts), "i", "text") == [(1, "A"), (2, "A"), (3, None), (4, "")]
