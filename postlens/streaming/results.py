"""A maintained result table for streams: committed batches, merged on read, compacted.

    <path>/data/<batch>-<random>/    the rows of one micro-batch, or of a compaction
    <path>/commits/batch=<n>/        one row: the folder that batch ``n`` wrote
    <path>/compactions/upto=<n>/     one row: the folder that stands for the batches up to ``n``

A batch counts once its commit row exists, which one rename brings about
after all its files are written: a reader during a batch, or after one that
failed half-way, sees the batches before it, whole.  A batch that is run again
writes a new folder and replaces its own commit.  Each batch writes only the
rows it was given; with an update-mode stream these are the changed ones.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH = "__batch"


class ResultTable:
    """``keys``: the columns that name a result row, its last written version counts; None: all rows of all batches.

    ``growing``: the other columns only ever grow (running counts), so the
    greatest is the last and the merge is a plain hash aggregation.
    ``adding``: the other columns are what a batch adds, and are summed.
    ``compact_every``: after so many batches they are merged into one folder,
    so a reader opens the files of one compaction and of fewer batches than
    that.  Folders that a compaction or a repeated batch has replaced stay
    for readers that have them open; :meth:`folders` names the ones in use.
    """

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] | None = None, compact_every: int = 10,
                 growing: bool = False, adding: bool = False):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.compact_every, self.growing, self.adding = compact_every, growing, adding

    # -- log --------------------------------------------------------------

    def _log(self, kind: str, part: str) -> dict[int, str]:
        """Number -> folder; bounded by the number of batches since the table began."""
        try:
            rows = self.spark.read.schema(f"folder string, {part} long").json(f"{self.path}/{kind}").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        return {r[part]: r["folder"] for r in rows if r["folder"] is not None}

    def _commit(self, kind: str, part: str, n: int, folder: str) -> None:
        row = self.spark.range(1).select(F.lit(folder).alias("folder")).coalesce(1)
        row.write.mode("overwrite").json(f"{self.path}/{kind}/{part}={n}")

    def folders(self) -> list[tuple[int, str]]:
        """(batch, folder) of what a reader has to open, oldest first."""
        done = self._log("compactions", "upto")
        base = [max(done.items())] if done else []
        after = base[0][0] if base else -1
        return base + sorted((n, f) for n, f in self._log("commits", "batch").items() if n > after)

    # -- write -------------------------------------------------------------

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``: the rows, then the commit; compacts when due."""
        folder = f"{batch_id}-{uuid.uuid4().hex[:12]}"
        df.write.option("compression", "zstd").parquet(f"{self.path}/data/{folder}")
        self._commit("commits", "batch", batch_id, folder)
        if self.compact_every and len(self.folders()) > self.compact_every:
            self.compact()

    def compact(self) -> None:
        """One folder for all batches committed so far."""
        use = self.folders()
        if len(use) < 2:
            return
        upto = use[-1][0]
        folder = f"upto-{upto}-{uuid.uuid4().hex[:12]}"
        self._merged(use).write.option("compression", "zstd").parquet(f"{self.path}/data/{folder}")
        self._commit("compactions", "upto", upto, folder)

    # -- read --------------------------------------------------------------

    def _merged(self, use: list[tuple[int, str]]) -> DataFrame:
        paths = [f"{self.path}/data/{f}" for _, f in use]
        if not self.keys:
            return self.spark.read.parquet(*paths)
        rows = self.spark.read.parquet(*paths)
        if self.adding:
            return rows.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in rows.columns if c not in self.keys])
        if self.growing:
            return rows.groupBy(*self.keys).agg(*[F.max(c).alias(c) for c in rows.columns if c not in self.keys])
        # which batch a row is from: the folder in its file's name
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/data/(?:upto-)?([0-9]+)-[^/]*/[^/]*$", 1).cast("long")
        rows = rows.select("*", number.alias(BATCH))
        others = [c for c in rows.columns if c not in (*self.keys, BATCH)]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*others), BATCH).alias("__last"))
        return last.select(*self.keys, *[F.col("__last")[c].alias(c) for c in others])

    def read(self, schema: StructType | str | None = None, merged: bool = True) -> DataFrame:
        """The result as of the last committed batch (``schema``: of a table that has none yet).

        ``merged=False``: the rows as they were written, for a reader that merges them itself.
        """
        use = self.folders()
        if not use:
            if schema is None:
                raise ValueError(f"nothing is committed under {self.path}")
            return self.spark.createDataFrame([], schema)
        return self._merged(use) if merged else self.spark.read.parquet(*[f"{self.path}/data/{f}" for _, f in use])

