"""Distinct kept in files, hot authors on salts, profiles in passing."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from postlens.operators import messages as msg
from postlens.plans.marts import build_marts, flatten_once, write_marts
from postlens.sources.envelopes import build_envelopes
from postlens.sources.streams import read_stream
from postlens.sources.tables import Tables
from postlens.streaming import jobs
from postlens.streaming.runner import append_records, run_available_now
from postlens.streaming.seen import DistinctTable
from test_outer_streams import posts, users

SCHEMA = "a string, b int"


def batches(spark):
    import random
    r = random.Random(4)
    return [spark.createDataFrame([(r.choice(["x", "y", "z", "nv", None, ""]), r.choice([1, 2, 3, None])) for _ in range(12)], SCHEMA)
            for _ in range(10)]


@pytest.mark.parametrize("compact_every", [0, 3])
def test_distinct_over_ten_batches_and_replays(spark, scratch, compact_every):
    t = DistinctTable(spark, scratch("seen"), ["a", "b"], compact_every)
    whole = None
    for i, batch in enumerate(batches(spark)):
        whole = batch if whole is None else whole.unionByName(batch)
        t.write_batch(batch, i)
        if i in (0, 4, 9):
            t.write_batch(batch, i)                       # the batch is run again
        assert rows(t.read(), "a", "b") == rows(whole.distinct(), "a", "b")


def test_files_are_filtered_by_the_batch(spark, scratch):
    """Once the files count as large, their scan is cut by a Bloom filter of the batch's keys."""
    t = DistinctTable(spark, scratch("seen"), ["a"])
    t.write_batch(spark.range(5000).select(F.col("id").cast("string").alias("a")), 0)
    conf = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        small = spark.createDataFrame([(str(i),) for i in range(4990, 5010)], "a string")
        path = scratch("small")
        small.write.parquet(path)
        fresh = t.fresh(spark.read.parquet(path).where("a > '0'"), 1)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fresh.explain("extended")
        assert "LeftSemi" in buf.getvalue() and "LeftAnti" in buf.getvalue()
        assert rows(fresh, "a") == [(str(i),) for i in range(5000, 5010)]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_author_is_spread_over_salts(spark, scratch):
    """A third of the posts on one author: no state partition of the posts' side holds three times the median."""
    n = 6000
    rows_in = [(f"p{i}", 10 + i % 50, "hot" if i % 3 == 0 else f"u{i % 997}", None) for i in range(n)]
    p = posts(spark, rows_in)
    u = users(spark, [("hot", "hot", 1), *[(f"u{i}", f"n{i}", 1) for i in range(997)]])
    assert jobs.heavy_authors(p, 0.1) == ["hot"] and jobs.heavy_authors(p.limit(0)) == []
    pp, pu = scratch("hp"), scratch("hu")
    append_records(msg.post_records(p).coalesce(1), pp)
    append_records(msg.user_records(u).coalesce(1), pu)

    def run(hot):
        src = [msg.decode_records(read_stream(spark, "files", path=x)) for x in (pp, pu)]
        out, ck = scratch("ho"), scratch("hc")
        run_available_now(jobs.join_users_job(*src, hot=hot, salts=32), out, ck)
        state = spark.read.format("statestore").option("joinSide", "left").option("operatorId", 1).load(ck)
        try:
            sizes = sorted(r["count"] for r in state.groupBy("partition_id").count().collect())
        except Exception:  # noqa: BLE001  (the join is operator 0 if the users' distinct is planned after it)
            state = spark.read.format("statestore").option("joinSide", "left").option("operatorId", 0).load(ck)
            sizes = sorted(r["count"] for r in state.groupBy("partition_id").count().collect())
        return spark.read.parquet(out), sizes

    plain, skewed = run(None)
    salted, even = run(["hot"])
    cols = ("username", "text", "created_at")
    assert rows(salted, *cols) == rows(plain, *cols)
    assert sum(even) == sum(skewed) == n
    assert skewed[-1] > 3 * skewed[len(skewed) // 2] and even[-1] < 3 * even[len(even) // 2]


def test_profile_in_passing(spark, scratch):
    t = Tables(spark, SF_SMALL)
    env = build_envelopes(t.posts, t.users, t.media)
    profile = {}
    flat = flatten_once(spark, env, scratch("flat"), profile=profile)
    written = {}
    write_marts(dict(list(build_marts(**flat).items())[:2]), lambda n, df: written.update({n: df.count()}), profile)
    assert profile["posts"]["rows"] == t.posts.count() and profile["posts"]["null_text"] == t.posts.where("text is null").count()
    assert all(profile[x]["rows"] == flat[x].count() > 0 for x in ("users", "media"))
    assert {n: profile[n]["rows"] for n in written} == written
