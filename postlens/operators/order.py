"""A global order that later steps can use: positions of sorted rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_dir

#: Row numbers inside a partition are the low bits of monotonically_increasing_id().
ROW_BITS = 33


def with_positions(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """``df`` with its 1-based place in the global ``order`` (give a total order; equal rows are numbered at will).

    The sort deals the rows into ranges.  They are written once, each with its
    range and its number inside it, to the shared folder; the rows are counted
    per range, and the sums of the ranges before each one (a table with one
    row per range) turn the numbers into positions.  No task sees more than
    its range, and the ranges of the files read back are those of the sort.
    """
    spark = df.sparkSession
    path = work_dir(spark, "ordered")
    placed = df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id())
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    part = F.shiftright("__id", ROW_BITS).alias("__part")
    counts = rows.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.col("__id").bitwiseAND((1 << ROW_BITS) - 1)
    return (rows.withColumn("__part", part).join(F.broadcast(offsets), "__part")   # one row per range
            .withColumn(name, F.col("__before") + inside + 1).drop("__part", "__before", "__id"))
