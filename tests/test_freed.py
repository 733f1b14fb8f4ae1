"""What a replay leaves on disk: one copy of its records while it runs, the last state, nothing of either afterwards."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from postlens.operators import messages as msg
from postlens.session import settings
from postlens.sources.streams import read_stream
from postlens.streaming import jobs
from postlens.streaming.runner import append_records, run_available_now, stage_records, time_cuts
from test_outer_streams import media, posts, users


@pytest.fixture()
def folders(monkeypatch):
    """The work folders that are named while the test runs."""
    from postlens.streaming import jobs as j
    from postlens.streaming import runner

    named = []
    real = runner.work_dir

    def work_dir(spark, purpose):
        named.append(real(spark, purpose))
        return named[-1]
    monkeypatch.setattr(runner, "work_dir", work_dir)
    monkeypatch.setattr(j, "work_dir", work_dir)
    return named


def test_staged_records_are_kept_once(spark, folders):
    p = posts(spark, [(f"p{i}", 10 + i, "u1", None) for i in range(200)])
    records = msg.post_records(p)
    staged = stage_records(spark, records, "once", time_cuts(p, "created_at", 4))
    assert spark.read.parquet(staged.path).count() == 200
    assert [f for f in folders if os.path.exists(f)] == [staged.path]


@pytest.mark.parametrize("query", ["stream_full_outer", "stream_word_count_sliding"])
def test_a_replay_leaves_its_result_only(spark, folders, query):
    from postlens.plans.catalog import REGISTRY
    assert REGISTRY[query](spark, SF_SMALL).count() > 0
    assert all("stream-out" in f for f in folders if os.path.exists(f))


def test_old_versions_of_the_state_go(spark, scratch):
    """Twelve micro-batches over a state that the watermark empties: its files are those of the last few."""
    src = {}
    made = {"posts": (posts, msg.post_records, lambda i: (f"p{i}", 200 * (i + 1), "u1", ["m1"])),
            "users": (users, msg.user_records, lambda i: ("u1", "n1", 200 * (i + 1) - 10)),
            "media": (media, msg.media_records, lambda i: ("m1", "photo", 200 * (i + 1) - 10))}
    for name, (make, records, row) in made.items():
        path = scratch(name)
        for i in range(12):
            append_records(records(make(spark, [row(i)])).coalesce(1), path)
        src[name] = msg.decode_records(read_stream(spark, "files", path=path, max_files_per_trigger=1))
    out, ck = scratch("out"), scratch("ck")
    with settings(spark, {"spark.sql.shuffle.partitions": "1"}):
        run_available_now(jobs.full_outer_job(src["posts"], src["users"], src["media"]), out, ck,
                          conf={"spark.sql.streaming.stateStore.maintenanceInterval": "500ms"})
    versions = {int(os.path.basename(f).split(".")[0]) for f in glob.glob(f"{ck}/state/0/0/left-keyWithIndexToValue/[0-9]*.delta")}
    assert max(versions) >= 11 and min(versions) > 1
    met = spark.read.parquet(out).where(F.col("tweet_id").isNotNull())
    assert rows(met.select("tweet_id", "username", "media_key"))[:2] == [("p0", "n1", "m1"), ("p1", "n1", "m1")]
