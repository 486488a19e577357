"""Respiration: cleaning, extrema, cycles, features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.timing import micros
from .intervals import slice_join
from .signal import fir_filter, run_starts


def _order() -> WindowSpec:
    return Window.partitionBy("file_id").orderBy("ts")


def clean(signals: DataFrame, events: DataFrame, fs: float, column: str = "PZT", low: float = 0.1, high: float = 0.35, block_rows: int | None = None) -> DataFrame:
    """The signal between the first and last event, band-passed."""
    bounds = events.groupBy("file_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    inside = signals.join(bounds, "file_id").where(F.col("ts").between(F.col("a"), F.col("b"))).drop("a", "b")
    return fir_filter(inside, column, fs, max(2, int(3 * fs / low) // 2 * 2), [low, high], "bandpass", f"{column}_filtered", block_rows)


def extrema(signals: DataFrame, column: str) -> DataFrame:
    """file_id, ts, v, is_peak: local maxima and minima, in alternation by nature.

    Equal samples in a row are one extremum, at the first of them, if those before and after are
    lower (or higher); missing samples are passed over.
    """
    runs = run_starts(signals.where(F.col(column).isNotNull()), column)
    seen = runs.select("file_id", "ts", F.col(column).alias("v"), F.col("before"), F.lead(column).over(_order()).alias("after"))
    peak = (F.col("v") > F.col("before")) & (F.col("v") > F.col("after"))
    trough = (F.col("v") < F.col("before")) & (F.col("v") < F.col("after"))
    return seen.where(peak | trough).select("file_id", "ts", "v", peak.alias("is_peak"))


def cycles(points: DataFrame) -> DataFrame:
    """file_id, ts, i_duration, e_duration, ie_duration, amplitude, ie_ratio of each peak between two troughs."""
    prev, after = (lambda c: F.lag(c).over(_order())), (lambda c: F.lead(c).over(_order()))
    seen = points.withColumns({"t": micros("ts"), "pp": prev("is_peak"), "np": after("is_peak"), "pt": prev(micros("ts")), "nt": after(micros("ts")), "pv": prev("v")})
    own = seen.where("is_peak and not pp and not np")
    i, e = (F.col("t") - F.col("pt")) / 1e6, (F.col("nt") - F.col("t")) / 1e6
    return own.select("file_id", "ts", i.alias("i_duration"), e.alias("e_duration"), ((F.col("nt") - F.col("pt")) / 1e6).alias("ie_duration"), (F.col("v") - F.col("pv")).alias("amplitude"), F.try_divide(i, e).alias("ie_ratio"))


def features(cycle_table: DataFrame, sequences: DataFrame) -> DataFrame:
    """The nine respiration features of each sequence; NULLs are skipped column by column."""
    joined = slice_join(sequences, cycle_table)
    return joined.groupBy("file_id", "reference").agg(
        F.avg("amplitude").alias("AMPmean"), F.max("amplitude").alias("AMPmax"), F.min("amplitude").alias("AMPmin"), F.stddev_samp("amplitude").alias("AMPsd"),
        F.avg("ie_duration").alias("PERIODmean"), F.stddev_samp("ie_duration").alias("PERIODsd"), F.avg("i_duration").alias("INSPImean"), F.avg("e_duration").alias("EXPImean"), F.avg("ie_ratio").alias("IEmean"),
    )
