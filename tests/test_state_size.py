"""State partitions and micro-batches of the replays follow the posts."""

from postlens.operators import messages as msg
from postlens.sources.streams import read_stream
from postlens.streaming import jobs
from postlens.streaming.runner import run_available_now
from test_streams import _one_file_each

SF_SMALL = "/root/testdata/sf0.001"


def test_state_is_sized_by_the_posts_it_holds(spark, monkeypatch, scratch):
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    monkeypatch.setattr(jobs, "LEAST_PARTITIONS", 1)
    monkeypatch.setattr(jobs, "BATCH_POSTS", n // 10)
    monkeypatch.setattr(jobs, "PARTITION_POSTS", n // 20)
    monkeypatch.setattr(jobs, "PARTITION_KEPT_POSTS", n // 3)
    bounded, kept = jobs.Replay(spark, SF_SMALL, bounded=True), jobs.Replay(spark, SF_SMALL)
    assert bounded.batches() >= 10 and len(bounded.cuts()) == bounded.batches() - 1    # more posts: more batches
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bounded.partitions() == min(2, most) and len(kept.cuts()) == jobs.REPLAY_BATCHES - 1
    assert kept.partitions() == min(4, most)


def test_a_stream_can_be_started_with_fewer_state_partitions(spark, scratch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    path = _one_file_each(spark, scratch, [("p1", "x y", 3), ("p2", "x", 50)])
    src = msg.decode_records(read_stream(spark, "files", path=path, max_files_per_trigger=1))
    ck = scratch("few")
    run_available_now(jobs.word_count_job(src), scratch("out"), ck, "complete", partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    parts = spark.sparkContext.wholeTextFiles(f"{ck}/offsets").values().collect()
    assert all('"spark.sql.shuffle.partitions":"3"' in p for p in parts)
