"""A key holding a third of all rows: the decomposed full outer join lets
adaptive execution split it; a native full outer sort-merge join cannot."""

import contextlib
import io

from pyspark.sql import functions as F

from conftest import rows
from postlens.operators import joins as J

SKEW_CONF = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_key_is_split_in_full_outer_join(spark):
    prev = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        left = spark.range(0, 30000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot"))
            .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k"),
            F.col("id").alias("v"))
        right = spark.range(0, 600).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("rk"),
                                           F.col("id").alias("w"))
        right = right.unionByName(spark.createDataFrame([("hot", 1)], "rk string, w long"))
        ours = J.full_outer_join(left, right, "k", "rk")
        plan = _final_plan(ours)
        assert "isFinalPlan=true" in plan and "skew=true" in plan
        native = left.join(right, left.k == right.rk, "full_outer")
        assert rows(ours, "v", "w") == rows(native, "v", "w")
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
