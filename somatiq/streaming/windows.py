"""Event streams: windowed features with late data bounded by a watermark, and stateful pairing of markers.

These extend the batch operators to unbounded input; the batch ones define the results.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed_features(stream: DataFrame, column: str, length: str = "5 minutes", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """file_id, begin, end, n, mean, sd, least, greatest per event-time window (ts is a timestamp)."""
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    agg = stream.withWatermark("ts", late).groupBy("file_id", window.alias("w")).agg(F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("sd"), F.min(column).alias("least"), F.max(column).alias("greatest"))
    return agg.select("file_id", F.col("w.start").alias("begin"), F.col("w.end").alias("end"), "n", "mean", "sd", "least", "greatest")


def pair_markers_stream(stream: DataFrame, begins: str, ends: str, late: str = "10 minutes", expire: str = "1 day") -> DataFrame:
    """file_id, begin, end of begin markers followed by an end marker, as time passes.

    Markers wait in a file's state until the watermark has passed them, so that late ones, also of
    later batches, take their place in the order of time. An open begin that another begin follows
    is dropped, as in the batch operator, and so is one that is older than ``expire``.
    """
    longest = int(pd.Timedelta(expire).total_seconds() * 1e6)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        opened, waiting = (state.get[0], list(zip(state.get[1], state.get[2], strict=True))) if state.exists else (None, [])
        for frame in frames:
            waiting += [(int(us), label == begins) for us, label in zip(frame["us"], frame["label"], strict=True)]
        waiting.sort(key=lambda m: m[0])
        passed = state.getCurrentWatermarkMs() * 1000
        out, ready = [], bisect.bisect_right(waiting, passed, key=lambda m: m[0])
        for us, is_begin in waiting[:ready]:
            if not is_begin and opened is not None:
                out.append((key[0], opened, us))
            opened = us if is_begin else None
        waiting = waiting[ready:]
        if opened is not None and opened + longest < passed:
            opened = None
        if opened is None and not waiting:
            if state.exists:
                state.remove()
        else:
            state.update((opened, [us for us, _ in waiting], [b for _, b in waiting]))
            wake = waiting[0][0] if waiting else opened + longest
            state.setTimeoutTimestamp(max(wake, passed) // 1000 + 1)
        yield pd.DataFrame(out, columns=["file_id", "begin_us", "end_us"])

    kind = stream.schema["file_id"].dataType.simpleString()
    marks = stream.where(F.col("label").isin(begins, ends)).withWatermark("ts", late).select("file_id", "label", "ts", F.unix_micros("ts").alias("us"))
    pairs = marks.groupBy("file_id").applyInPandasWithState(step, f"file_id {kind}, begin_us long, end_us long", "opened long, waiting array<long>, is_begin array<boolean>", "append", GroupStateTimeout.EventTimeTimeout)
    return pairs.select("file_id", F.timestamp_micros("begin_us").alias("begin"), F.timestamp_micros("end_us").alias("end"))
