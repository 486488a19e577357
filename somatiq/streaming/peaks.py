"""The moving threshold of :func:`somatiq.operators.signal.adaptive_peaks` over an unbounded stream of candidates.

Candidates wait in a recording's state until the watermark has passed them, so late ones take their
place in the order of time; the batch operator defines the result. State is three small lists and a
value for each recording, in RocksDB; a timer wakes a recording when the watermark reaches what it waits
for, and another clears one that has been silent for long.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

#: The state store that processors with timers need.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Set the session's state store to one that can hold this state; streams that are started later use it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


class _MovingThreshold(StatefulProcessor):
    def __init__(self, ratio: float, baseline_us: int, memory: int, expire_us: int) -> None:
        self.ratio, self.baseline, self.memory, self.expire = ratio, baseline_us, memory, expire_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Candidates that the watermark has not passed, and the last ones that were kept.
        self.waiting = handle.getListState("waiting", "us long, value double")
        self.last = handle.getListState("last", "value double")
        # Where the baseline ends (NULL threshold: not passed yet), the threshold, and the last kept moment.
        self.phase = handle.getValueState("phase", "until long, threshold double, latest long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 (Spark's names)
        fresh = [(int(us), float(value)) for frame in rows for us, value in zip(frame["us"], frame["value"], strict=True)]
        yield self._step(key, fresh, timerValues)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self._step(key, [], timerValues)

    def close(self) -> None:
        pass

    def _step(self, key: tuple, fresh: list[tuple[int, float]], timers: TimerValues) -> pd.DataFrame:
        passed = timers.getCurrentWatermarkInMs() * 1000
        waiting = sorted([*((int(us), float(v)) for us, v in self.waiting.get()), *fresh]) if self.waiting.exists() else sorted(fresh)
        phase = self.phase.get() if self.phase.exists() else None
        until, threshold, latest = phase if phase is not None else (None, None, None)
        last = [float(v) for (v,) in self.last.get()] if self.last.exists() else []
        out: list[tuple] = []
        if until is None and waiting and waiting[0][0] <= passed:
            until = waiting[0][0] + self.baseline
        if threshold is None and until is not None and until <= passed:
            base = [m for m in waiting if m[0] <= until]
            threshold = self.ratio * max(v for _, v in base)
            for us, v in base:
                if v > threshold:
                    out.append((us, v, threshold))
                    last.append(v)
                    latest = us
            # A candidate at the end of the baseline is looked at again, as the batch operator does.
            waiting = [m for m in waiting if m[0] >= until]
        if threshold is not None:
            ready = [m for m in waiting if m[0] <= passed]
            waiting = waiting[len(ready) :]
            for us, v in ready:
                if v > threshold:
                    if latest == us:
                        out = [o for o in out if o[0] != us]
                    else:
                        last.append(v)
                    few = sorted(last[-self.memory :])
                    threshold = self.ratio * (few[len(few) // 2] + few[(len(few) - 1) // 2]) / 2
                    out.append((us, v, threshold))
                    latest = us
        newest = max([us for us, _ in waiting] + [x for x in (latest, until) if x is not None], default=None)
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if newest is None or (not waiting and newest + self.expire < passed):
            for state in (self.waiting, self.last, self.phase):
                state.clear()
        else:
            self.waiting.put(waiting) if waiting else self.waiting.clear()
            self.last.put([(v,) for v in last[-self.memory :]]) if last else self.last.clear()
            if until is not None:
                self.phase.update((until, threshold, latest))
            wake = until if threshold is None and until is not None else waiting[0][0] if waiting else newest + self.expire
            self.handle.registerTimer(max(wake, passed) // 1000 + 1)
        return pd.DataFrame([(key[0], *o) for o in out], columns=["file_id", "us", "value", "threshold"])


def adaptive_peaks_stream(candidates: DataFrame, ratio: float = 0.7, baseline_seconds: float = 3.0, memory: int = 5, late: str = "10 minutes", expire: str = "1 day") -> DataFrame:
    """file_id, ts, value, threshold of candidates (file_id, ts timestamp, value) above the moving threshold, as time passes.

    A recording without candidates for ``expire`` after its last one is forgotten; what comes later
    begins anew with a baseline. Call :func:`use_state_store` before the stream starts.
    """
    kind = candidates.schema["file_id"].dataType.simpleString()
    processor = _MovingThreshold(ratio, int(baseline_seconds * 1e6), memory, int(pd.Timedelta(expire).total_seconds() * 1e6))
    told = candidates.withWatermark("ts", late).select("file_id", "ts", F.unix_micros("ts").alias("us"), F.col("value").cast("double").alias("value"))
    kept = told.groupBy("file_id").transformWithStateInPandas(statefulProcessor=processor, outputStructType=f"file_id {kind}, us long, value double, threshold double", outputMode="Append", timeMode="EventTime")
    return kept.select("file_id", F.timestamp_micros("us").alias("ts"), "value", "threshold")
