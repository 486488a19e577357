"""Electrodermal activity: cleaning, tonic/phasic split, peaks, features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import OUTLIER, OUTSIDE, gsr_from_raw, gsr_saturation, missing_annotation
from ..functions.timing import from_micros, micros, shift_seconds
from ..kernels import filters, spectral
from .byfile import by_file, groups_of, tasks_for, whole_groups
from .intervals import slice_join
from .signal import _kind, fill_gaps, fir_filter, scaled, zscore_outlier

#: Samples of equally long epochs that are solved at once.
POOL = 400_000


def convert_gsr(raw: DataFrame, column: str, slope: float = 1.0, offset: float = 0.0) -> DataFrame:
    """file_id, ts, gsr, annotation: device units to conductance, saturated samples blanked."""
    x = F.col(column)
    note = gsr_saturation(x)
    return raw.select("file_id", "ts", F.when(note == "", gsr_from_raw(x, slope, offset)).alias("gsr"), note.alias("annotation"))


def standardize_channel(raw: DataFrame, device: str, name: str) -> DataFrame:
    """file_id, ts, name, annotation: a device channel under its standard name, missing samples annotated."""
    return raw.select("file_id", "ts", F.col(device).alias(name), missing_annotation(F.col(device)).alias("annotation"))


def missing_ratios(signals: DataFrame, column: str) -> DataFrame:
    """file_id, samples, missing, missing_ratio of a column."""
    gone = F.count_if(F.col(column).isNull())
    return signals.groupBy("file_id").agg(F.count(F.lit(1)).alias("samples"), gone.alias("missing"), (gone / F.count(F.lit(1))).alias("missing_ratio"))


def with_annotations(signals: DataFrame, annotations: DataFrame, note: str = "note") -> DataFrame:
    """Adds annotated, and the note of each sample that annotations (file_id, ts, note) mark ('' for others).

    A sample that is marked more than once has the first of its notes by text.
    """
    marks = annotations.groupBy("file_id", "ts").agg(F.min(note).alias("__note"))
    return signals.join(marks, ["file_id", "ts"], "left").withColumns({"annotated": F.col("__note").isNotNull(), note: F.coalesce("__note", F.lit(""))}).drop("__note")


def session_bounds(events: DataFrame, warmup_seconds: float = 30) -> DataFrame:
    """file_id, opens, closes: first event minus, last event plus the warm-up."""
    return events.groupBy("file_id").agg(shift_seconds(F.min("ts"), -warmup_seconds).alias("opens"), shift_seconds(F.max("ts"), warmup_seconds).alias("closes"))


def mask_outside(signals: DataFrame, events: DataFrame, column: str, annotation: str = "annotation", warmup_seconds: float = 30) -> DataFrame:
    """Samples up to the opening and from the closing on are blanked and annotated."""
    bounds = session_bounds(events, warmup_seconds)
    out = F.col("opens").isNotNull() & ((F.col("ts") <= F.col("opens")) | (F.col("ts") >= F.col("closes")))
    return signals.join(bounds, "file_id", "left").withColumns({column: F.when(~out, F.col(column)), annotation: F.when(out, F.lit(OUTSIDE)).otherwise(F.col(annotation))}).drop("opens", "closes")


def corrupted_ratio(signals: DataFrame, annotation: str = "annotation") -> DataFrame:
    """file_id, ratio: share of annotated samples among those inside the session."""
    return signals.where(F.col(annotation) != OUTSIDE).groupBy("file_id").agg(F.avg((F.col(annotation) != "").cast("double")).alias("ratio"))


def clean(signals: DataFrame, events: DataFrame, fs: float, column: str = "gsr", warmup_seconds: float = 30, most_corrupted: float = 0.6, order: int = 100, cutoff: float = 30.0, block_rows: int | None = None) -> DataFrame:
    """file_id, ts, gsr, gsr_filtered, gsr_filtered_clean, gsr_filtered_clean_zscored, annotation, status.

    Files with more corruption than allowed keep their rows with status ``corrupted`` and no clean
    values: one bad file does not stop the others. With ``block_rows`` filters and gaps go in blocks.
    """
    masked = mask_outside(signals, events, column, warmup_seconds=warmup_seconds)
    outlier = zscore_outlier(column)
    noted = masked.withColumn("__o", outlier).withColumns({"annotation": F.when(F.col("__o"), F.lit(OUTLIER)).otherwise(F.col("annotation")), column: F.when(~F.col("__o"), F.col(column))}).drop("__o")
    ratio = corrupted_ratio(masked)
    status = noted.join(ratio, "file_id", "left").withColumn("status", F.when(F.col("ratio") > most_corrupted, F.lit("corrupted")).otherwise(F.lit("ok"))).drop("ratio")
    filtered = fir_filter(noted, column, fs, order, [min(cutoff, 0.45 * fs)], out=f"{column}_filtered", block_rows=block_rows)
    filled = fill_gaps(filtered.select("file_id", "ts", f"{column}_filtered"), f"{column}_filtered", f"{column}_filtered_clean", block_rows)
    z = filled.withColumn(f"{column}_filtered_clean_zscored", scaled(f"{column}_filtered_clean"))
    whole = status.join(z, ["file_id", "ts"], "left")
    good = F.col("status") == "ok"
    return whole.withColumns({c: F.when(good, F.col(c)) for c in (f"{column}_filtered", f"{column}_filtered_clean", f"{column}_filtered_clean_zscored")})


def tonic_phasic(signals: DataFrame, column: str, fs: float, epoch_s: float = 300, step_s: float = 60, warmup_s: float = 15, outlier: float = 4.0, tolerance: float = 1e-6) -> DataFrame:
    """file_id, ts, scr, scl, gap, annotation: a convex split in overlapping epochs, then the mean per sample.

    An epoch is ``epoch_s`` plus the warm-up long and begins ``step_s`` after the one before; its
    warm-up is cut off at both ends before the mean, so no sample takes part near an edge. A file
    that does not hold an epoch and a step is split at once, uncut. The first and last seconds of
    what is split are annotated, as are samples before and after it, which have no values. ``gap``
    is the largest duality gap among a sample's epochs; beyond the tolerance it is annotated.
    Each (file, epoch) is solved for itself, so long recordings spread over the cluster.
    """
    kind = _kind(signals)
    span = Window.partitionBy("file_id")
    margin, step = int(warmup_s * fs), max(1, int(step_s * fs))
    size = int(epoch_s * fs) + margin
    t = signals.select("file_id", "ts", F.col(column).cast("double").alias("x"), micros("ts").alias("t")).where("x is not null")
    placed = t.withColumns({"i": F.row_number().over(span.orderBy("t")).cast("long") - 1, "n": F.count(F.lit(1)).over(span)})
    whole = F.col("n") < size + step
    last = F.floor((F.col("n") - size) / step).cast("long")
    lo = F.greatest(F.floor((F.col("i") - size) / step).cast("long") + 1, F.lit(0))
    hi = F.least(F.floor(F.col("i") / step).cast("long"), last)
    none = F.array().cast("array<bigint>")
    within = F.when(whole, F.array(F.lit(0).cast("long"))).when(lo <= hi, F.sequence(lo, hi)).otherwise(none)
    epochs = placed.select("file_id", "t", "x", "i", whole.alias("whole"), F.explode(within).alias("epoch"))
    at = F.col("i") - F.col("epoch") * step
    epochs = epochs.withColumn("inner", F.col("whole") | ((at >= margin) & (at < size - margin)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool: dict[int, list[pa.Table]] = {}

        def split(n: int) -> pa.RecordBatch:
            rows = pa.concat_tables(pool.pop(n)).combine_chunks()
            phasic, tonic, gap = filters.tonic_phasic(np.array(rows.column("x"), float).reshape(-1, n), fs, tolerance=tolerance)
            out = {"file_id": rows.column("file_id").combine_chunks(), "t": rows.column("t").combine_chunks(), "scr": pa.array(phasic.ravel()), "scl": pa.array(tonic.ravel()), "gap": pa.array(np.repeat(gap, n))}
            return pa.record_batch(out).filter(rows.column("inner").combine_chunks())

        for group in groups_of(batches, ["file_id", "epoch"]):
            n = group.num_rows
            pool.setdefault(n, []).append(group)
            if n * len(pool[n]) >= POOL:
                yield split(n)
            elif sum(k * len(v) for k, v in pool.items()) >= 4 * POOL:
                yield split(max(pool, key=lambda k: k * len(pool[k])))
        for n in list(pool):
            yield split(n)

    # Epochs of equal length are solved together: their number in a task is bounded, not their files.
    tasks = epochs.select("file_id", "epoch", "t", "x", "inner").repartition(tasks_for(signals), "file_id", "epoch").sortWithinPartitions("file_id", "epoch", "t")
    parts = tasks.mapInArrow(run, f"file_id {kind}, t long, scr double, scl double, gap double")
    mean = parts.groupBy("file_id", "t").agg(F.avg("scr").alias("scr"), F.avg("scl").alias("scl"), F.max("gap").alias("gap"))
    outside = placed.where(~whole & ((F.col("i") < margin) | (F.col("i") >= last * step + size - margin)))
    mean = mean.unionByName(outside.select("file_id", "t"), allowMissingColumns=True)
    split_at = F.when(F.col("scr").isNotNull(), F.col("t"))
    edged = mean.withColumns({"t0": F.min(split_at).over(span), "t1": F.max(split_at).over(span)})
    warm = (F.col("t") <= F.col("t0") + int(warmup_s * 1e6)) | (F.col("t") >= F.col("t1") - int(warmup_s * 1e6))
    note = F.when(warm, F.lit("CVX warm up")).when(F.col("gap") > tolerance, F.lit("CVX not settled")).when(F.col("scr") >= outlier, F.lit("CVX SCR outlier")).otherwise(F.lit(""))
    return edged.select("file_id", from_micros(F.col("t")).alias("ts"), F.when(note == "", F.col("scr")).alias("scr"), F.when(~warm, F.col("scl")).alias("scl"), "gap", note.alias("annotation"))


def epoch_mean(samples: DataFrame, column: str, epoch_s: float, step_s: float) -> DataFrame:
    """file_id, epoch, n, mean of a column over overlapping epochs from the file's first sample."""
    span = Window.partitionBy("file_id")
    t = samples.select("file_id", F.col(column).alias("x"), micros("ts").alias("t")).withColumn("t0", F.min("t").over(span))
    at = (F.col("t") - F.col("t0")) / 1e6
    lo = F.greatest(F.floor((at - epoch_s) / step_s) + 1, F.lit(0)).cast("long")
    return t.withColumn("epoch", F.explode(F.sequence(lo, F.floor(at / step_s).cast("long")))).groupBy("file_id", "epoch").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"))


def scr_peaks(signals: DataFrame, fs: float, column: str = "scr", width: float = 0.5, prominence: float = 0.1, window: float = 15, rel_height: float = 0.5, longest_rise: float = 7) -> DataFrame:
    """file_id, ts, value, increase_duration, increase_amplitude, recovery_duration, annotation; long rises are false peaks."""
    kind = _kind(signals)

    def run(c: dict[str, np.ndarray]) -> dict:
        x = np.nan_to_num(c[column])
        spread = np.subtract(*np.percentile(x, [95, 5])) or 1.0
        p = filters.find_peaks(x / spread, prominence=prominence, width=width * fs, rel_height=rel_height, window=max(3, int(window * fs)))
        i = p["index"]
        return {"ts": c["ts"][i], "value": x[i], "increase_duration": (i - p["left_base"]) / fs, "increase_amplitude": x[i] - x[p["left_base"]], "recovery_duration": (p["right"] - i) / fs}

    told = signals.select("file_id", "ts", F.col(column).cast("double").alias(column))
    got = by_file(told, run, f"file_id {kind}, ts timestamp_ntz, value double, increase_duration double, increase_amplitude double, recovery_duration double")
    false = F.col("increase_duration") >= longest_rise
    return got.withColumn("annotation", F.when(false, F.lit("false_peak_detection")).otherwise(F.lit(""))).withColumns({c: F.when(F.col("annotation") == "", F.col(c)) for c in ("value", "increase_duration", "increase_amplitude", "recovery_duration")})


def scl_features(scl: DataFrame, sequences: DataFrame, column: str = "scl") -> DataFrame:
    """file_id, reference, SCLmean, SCLmedian, SCLsd (population), SCLauc (trapezoid seconds per minute)."""
    joined = slice_join(sequences, scl.where(F.col(column).isNotNull()).select("file_id", "ts", F.col(column).alias("y")))
    w = Window.partitionBy("file_id", "reference").orderBy("ts")
    stepped = joined.withColumn("area", (micros("ts") - micros(F.lag("ts").over(w))) / 1e6 * (F.col("y") + F.lag("y").over(w)) / 2)
    minutes = (F.max(micros("ts")) - F.min(micros("ts"))) / 60e6
    return stepped.groupBy("file_id", "reference").agg(F.avg("y").alias("SCLmean"), F.percentile("y", 0.5).alias("SCLmedian"), F.stddev_pop("y").alias("SCLsd"), F.try_divide(F.sum("area"), minutes).alias("SCLauc"))


def trend_ols(samples: DataFrame, sequences: DataFrame, column: str) -> DataFrame:
    """file_id, reference, slope, intercept, r of a least-squares line over seconds since the first sample."""
    joined = slice_join(sequences, samples.where(F.col(column).isNotNull()).select("file_id", "ts", F.col(column).alias("y")), "inner")
    per = Window.partitionBy("file_id", "reference")
    x = joined.withColumn("x", (micros("ts") - F.min(micros("ts")).over(per)) / 1e6)
    return x.groupBy("file_id", "reference").agg(F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"), F.when(F.count("y") > 1, F.try_divide(F.covar_pop("y", "x"), F.stddev_pop("y") * F.stddev_pop("x"))).alias("r"))


def trend_robust(samples: DataFrame, sequences: DataFrame, column: str) -> DataFrame:
    """As :func:`trend_ols`, by a Huber M-estimate; NULL where values are not finite.

    Sequences of equal length are solved together: there are many short ones.
    """
    joined = slice_join(sequences, samples.where(F.col(column).isNotNull()).select("file_id", "ts", F.col(column).cast("double").alias("y")), "inner")
    keys = ["file_id", "reference"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, keys, POOL):
            t, y = (rows.column(c).to_numpy() for c in ("t", "y"))
            sizes = np.diff(starts, append=rows.num_rows)
            lines = np.empty((3, len(starts)))
            for n in np.unique(sizes):
                which = np.flatnonzero(sizes == n)
                own = starts[which, None] + np.arange(n)
                lines[:, which] = spectral.huber_lines((t[own] - t[starts[which], None]) / 1e6, y[own])
            told = {c: rows.column(c).take(pa.array(starts)).combine_chunks() for c in keys}
            yield pa.record_batch(told | {c: pa.array(v, from_pandas=True) for c, v in zip(("slope", "intercept", "r"), lines, strict=True)})

    dealt = joined.select(*keys, micros("ts").alias("t"), "y").repartition(tasks_for(samples), *keys).sortWithinPartitions(*keys, "t")
    return dealt.mapInArrow(run, f"file_id {_kind(samples)}, reference string, slope double, intercept double, r double")


def scr_features(scr: DataFrame, peaks: DataFrame, sequences: DataFrame, column: str = "scr") -> DataFrame:
    """file_id, reference, SCRamplitude, SCRincrease, SCRdecrease, SCRrate (peaks a minute).

    NULL without samples, 0 without peaks. Samples and peaks are aggregated apart and then joined,
    one row per sequence each.
    """
    s = slice_join(sequences, scr.where(F.col(column).isNotNull()).select("file_id", "ts", F.col(column).alias("y")))
    spans = s.groupBy("file_id", "reference").agg(F.count("y").alias("n"), ((F.max(micros("ts")) - F.min(micros("ts"))) / 60e6).alias("minutes"))
    p = slice_join(sequences, peaks.where("value is not null").select("file_id", "ts", "increase_amplitude", "increase_duration", "recovery_duration"), "inner")
    means = p.groupBy("file_id", "reference").agg(F.avg("increase_amplitude").alias("a"), F.avg("increase_duration").alias("i"), F.avg("recovery_duration").alias("d"), F.count(F.lit(1)).alias("k"))
    whole = spans.join(means, ["file_id", "reference"], "left")
    pick = lambda value: F.when(F.col("n") == 0, F.lit(None).cast("double")).when(F.col("k").isNull(), F.lit(0.0)).otherwise(value)
    return whole.select("file_id", "reference", pick(F.col("a")).alias("SCRamplitude"), pick(F.col("i")).alias("SCRincrease"), pick(F.col("d")).alias("SCRdecrease"), pick(F.try_divide(F.col("k").cast("double"), F.col("minutes"))).alias("SCRrate"))
