"""Time arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch, as long."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us.cast("long")).cast("timestamp_ntz")


def seconds_between(a: Column | str, b: Column | str) -> Column:
    """Seconds from a to b."""
    return (micros(b) - micros(a)) / F.lit(1e6)


def shift_seconds(ts: Column | str, seconds: float) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts + F.make_dt_interval(secs=F.lit(float(seconds)))
