"""Late rows: Spark's own count, the side table and a plain replay agree."""

import time
from datetime import timedelta

from pyspark.sql import functions as F

from conftest import rows
from postlens.operators import messages as msg
from postlens.sources.streams import read_stream
from postlens.streaming import jobs
from postlens.streaming.late import DroppedRows, LateRows
from postlens.streaming.runner import run_available_now
from test_streams import T0, _one_file_each

ITEMS = [("a", "a", 100), ("b", "b", 5000), ("late1", "late1", 4000), ("c", "c", 5100), ("late2", "late2", 20), ("d", "d", 9000),
         ("edge", "edge", 5070), ("n", "n", None), ("late3", "late3", 5069), ("e", "e", 9001),
         ("late4", "late4", 8969), ("in time", "in", 8971)]


def plain_late(items, delay=30):
    """Batch n drops what is behind the greatest time of the batches before n - 1, less the delay."""
    out, tops = [], []
    for name, _, s in items:
        before = [t for t in tops[:-1] if t is not None]
        if s is not None and before and s < max(before) - delay:
            out.append(name)
        tops.append(s)
    return sorted(out)


def test_counts_and_side_table_equal_a_plain_replay(spark, scratch):
    path = _one_file_each(spark, scratch, ITEMS)
    src = lambda: msg.decode_records(read_stream(spark, "files", path=path, max_files_per_trigger=1))
    listener = DroppedRows()
    spark.streams.addListener(listener)
    try:
        kept = jobs.posts_stream(src(), explode_media=False).withColumn("at", F.col("created_at").cast("timestamp")) \
            .withWatermark("at", "30 seconds").groupBy("tweet_id", F.window("at", "1 second")).count()
        run_available_now(kept, scratch("lo"), scratch("lc"), "append", query_name="late-test")
        for _ in range(50):
            if listener.dropped.get("late-test", 0) >= len(plain_late(ITEMS)):
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)

    late = LateRows(spark, scratch("late"), "created_at", 30)
    def twice(batch, batch_id):
        late.write(batch, batch_id)
        late.write(batch, batch_id)                       # a batch that is run again files its rows once

    run_available_now(jobs.posts_stream(src(), explode_media=False).select("tweet_id", "created_at"), scratch("x"), scratch("xc"), "append", write=twice)
    side = [r[0] for r in rows(late.read(), "tweet_id")]
    assert side == plain_late(ITEMS) and len(side) >= 3
    assert listener.dropped["late-test"] == len(side)
    assert T0 + timedelta(seconds=0) < late.read().agg(F.max("created_at")).first()[0]
