"""Time helpers used by interval joins and windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType


def seconds(n) -> Column:
    """A day-time interval of ``n`` seconds (``n`` may be a column).

    A number gives an interval *literal*, which stream-stream joins need to
    recognise a time-range condition.
    """
    if isinstance(n, Column):
        return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))
    return F.expr(f"INTERVAL '{float(n):.6f}' SECOND")


def epoch_seconds(ts: Column, dtype: DataType) -> Column:
    """Whole seconds since 1970-01-01, without a time-zone trip.

    A TIMESTAMP is an instant already; a TIMESTAMP_NTZ is read as wall-clock
    fields so that a daylight-saving gap in the session zone cannot move it.
    """
    if isinstance(dtype, TimestampNTZType):
        days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
        return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.floor(F.unix_micros(ts) / 1_000_000)
