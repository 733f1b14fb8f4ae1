"""Late rows accounted for: what the watermark dropped, and which rows they were."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .results import ResultTable


class DroppedRows(StreamingQueryListener):
    """Rows that stateful operators dropped as late, by query name (or id), as Spark reports them.

    Register with ``spark.streams.addListener``.  The numbers count operator
    inputs: after a partial aggregation these are its groups, not raw rows.
    """

    def __init__(self):
        self.dropped: dict[str, int] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        n = sum(max(0, s.numRowsDroppedByWatermark) for s in p.stateOperators)
        with self._lock:
            key = p.name or str(p.id)
            self.dropped[key] = self.dropped.get(key, 0) + n

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


class LateRows:
    """``foreachBatch`` writer that files the rows behind the watermark, next to a job with the same source and delay.

    Spark drops in micro-batch n what is older than the greatest event time of
    the batches before n - 1, less the delay (a batch's watermark comes from
    the batches before it and filters from the next one on).  The greatest
    time of each batch is kept in a small table of its own, so the rule holds
    through restarts, and a batch that is run again gives the same rows.
    """

    def __init__(self, spark: SparkSession, path: str, time_col: str, delay_seconds: float):
        self.rows = ResultTable(spark, f"{path.rstrip('/')}/rows", None)
        self.times = ResultTable(spark, f"{path.rstrip('/')}/times", ("batch",), growing=True)
        self.time_col, self.delay = time_col, delay_seconds

    def watermark(self, batch_id: int) -> float | None:
        """Seconds since 1970 below which batch ``batch_id`` is late; None: nothing is late yet."""
        if not self.times.folders():
            return None
        top = self.times.read().where(F.col("batch") < batch_id - 1).agg(F.max("top")).first()[0]
        return None if top is None else top - self.delay

    def write(self, batch: DataFrame, batch_id: int) -> None:
        low = self.watermark(batch_id)
        t = F.col(self.time_col).cast("timestamp").cast("double")
        late = batch.where(t < F.lit(low)) if low is not None else batch.limit(0)
        self.rows.write_batch(late, batch_id)
        top = batch.agg(F.max(t).alias("top")).select(F.lit(batch_id).cast("long").alias("batch"), F.coalesce("top", F.lit(0.0)).alias("top"))
        self.times.write_batch(top, batch_id)

    def read(self) -> DataFrame:
        return self.rows.read()
