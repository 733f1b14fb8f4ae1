"""Distinct rows for good, without memory state: the rows kept so far are the files of a maintained table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .results import ResultTable

KEY = "__key"


def row_key(df: DataFrame, columns: list[str]) -> Column:
    """A digest that is equal exactly for equal values (nulls are equal), barring a SHA-256 collision."""
    parts = [F.coalesce(F.concat(F.lit("v"), F.sha2(F.col(c).cast("string"), 256)), F.lit("n")) for c in columns]
    return F.sha2(F.concat(*parts), 256)


class DistinctTable(ResultTable):
    """``distinct()`` over all batches of a stream, on ``columns`` (of equal rows the first batch's stays).

    A batch keeps the rows whose key no batch before it has.  The keys on
    file are first reduced to those of the batch by a semi-join -- the batch is
    the small side, so Spark filters the files by a Bloom filter of its keys
    before they are shuffled, once the files are large enough -- and what is
    left goes into an anti-join.  No state store holds the keys; a batch that
    is run again does not see its own rows, and replaces them.
    """

    def __init__(self, spark: SparkSession, path: str, columns: list[str], compact_every: int = 20):
        super().__init__(spark, path, None, compact_every)
        self.columns = list(columns)

    def fresh(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The batch's distinct rows that are not on file, with their key."""
        rows = batch.withColumn(KEY, row_key(batch, self.columns)).dropDuplicates([KEY])
        before = [(n, f) for n, f in self.folders() if n < batch_id]
        if not before:
            return rows
        keys = rows.select(KEY)
        known = self._merged(before).select(KEY).join(keys, KEY, "left_semi")
        return rows.join(known, KEY, "left_anti")

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        done = self._log("compactions", "upto")
        if done and max(done) >= batch_id:
            return                                   # compacted already: its rows are in, whole
        super().write_batch(self.fresh(df, batch_id), batch_id)

    def read(self, schema=None) -> DataFrame:
        out = super().read(schema)
        return out.drop(KEY)
