"""Operators on uniformly sampled signals: rate, resampling, scaling, peaks, filters, spectra."""

from __future__ import annotations

import collections
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.timing import from_micros, micros
from ..kernels import filters, spectral
from .blocks import in_blocks, known_points, with_neighbours, with_positions
from .byfile import by_file
from .quantiles import exact_quantiles


def _file() -> WindowSpec:
    return Window.partitionBy("file_id")


def _order() -> WindowSpec:
    return _file().orderBy("ts")


def _kind(df: DataFrame) -> str:
    return df.schema["file_id"].dataType.simpleString()


def estimate_rate(signals: DataFrame) -> DataFrame:
    """file_id, rate (1 / median step), uniform (no step exceeds twice the median), samples."""
    steps = signals.select("file_id", ((micros("ts") - micros(F.lag("ts").over(_order()))) / 1e6).alias("dt"))
    per = steps.groupBy("file_id").agg(F.percentile("dt", 0.5).alias("step"), F.max("dt").alias("most"), F.min("dt").alias("least"), F.count(F.lit(1)).alias("samples"))
    uniform = F.coalesce((F.col("most") - F.col("step") <= F.col("step")) & (F.col("step") - F.col("least") <= F.col("step")), F.lit(True))
    return per.select("file_id", F.try_divide(F.lit(1.0), F.col("step")).alias("rate"), uniform.alias("uniform"), F.col("samples").cast("long").alias("samples"))


def resample(signals: DataFrame, column: str, fs: float, kind: str = "linear", output: str | None = None, block_rows: int | None = None) -> DataFrame:
    """file_id, ts, column on the grid t0 + k / fs, by linear interpolation or sample-and-hold.

    Each sample spans the grid points up to the next one, so no grid is joined with the samples:
    one window, then an explosion of each gap. With ``block_rows`` a block of a recording and one
    more sample is all that a task orders.
    """
    known = signals.where(F.col(column).isNotNull()).select("file_id", "ts", micros("ts").alias("t"), F.col(column).cast("double").alias("v"))
    if block_rows is None:
        w = Window.partitionBy("file_id").orderBy("t")
        span = known.withColumns({"t0": F.min("t").over(Window.partitionBy("file_id")), "t1": F.lead("t").over(w), "v1": F.lead("v").over(w)})
    else:
        begins = known.groupBy(F.col("file_id").alias("__f")).agg(F.min("t").alias("t0"))
        w = Window.partitionBy("file_id", "block").orderBy("t")
        halo = in_blocks(with_positions(known), block_rows, after=1)
        span = halo.withColumns({"t1": F.lead("t").over(w), "v1": F.lead("v").over(w)}).where("core").join(begins, F.col("file_id").eqNullSafe(F.col("__f")))
    at = lambda k: F.col("t0") + F.round(k * 1e6 / fs).cast("long")
    first = F.ceil((F.col("t") - F.col("t0")) * fs / 1e6 - 1e-6).cast("long")
    last = F.when(F.col("t1").isNull(), first).otherwise(F.ceil((F.col("t1") - F.col("t0")) * fs / 1e6 - 1e-6).cast("long") - 1)
    grid = span.withColumns({"k0": first, "k1": last}).where((F.col("k1") >= F.col("k0")) & (F.col("t1").isNotNull() | (F.abs(at(F.col("k0")) - F.col("t")) <= 1)))
    points = grid.withColumn("k", F.explode(F.sequence("k0", "k1"))).withColumn("g", at(F.col("k")))
    share = F.try_divide((F.col("g") - F.col("t")).cast("double"), (F.col("t1") - F.col("t")).cast("double"))
    value = F.col("v") if kind == "zero" else F.coalesce(F.col("v") + (F.col("v1") - F.col("v")) * share, F.col("v"))
    return points.select("file_id", from_micros(F.col("g")).alias("ts"), value.alias(output or column))


def downsample(signals: DataFrame, fs_in: float, fs_out: float) -> DataFrame:
    """Every round(fs_in / fs_out)-th row of each file."""
    step = max(1, round(fs_in / fs_out))
    return signals.withColumn("__n", F.row_number().over(_order()) - 1).where(F.col("__n") % step == 0).drop("__n")


def number_samples(signals: DataFrame) -> DataFrame:
    return signals.withColumn("sample_number", (F.row_number().over(_order()) - 1).cast("long"))


def scaled(column: str, method: str = "standard") -> Column:
    """A scaled column over the whole file: standard, robust, minmax, or range90 (5-95 % range, not centred)."""
    x = F.col(column)
    # One percentile expression for all shares: Spark computes it once a file.
    shares = (0.05, 0.25, 0.5, 0.75, 0.95)
    quantiles = F.percentile(x, F.array(*map(F.lit, shares))).over(_file())
    q = lambda p: quantiles[shares.index(p)]
    if method == "standard":
        return F.try_divide(x - F.avg(x).over(_file()), F.stddev_pop(x).over(_file()))
    if method == "robust":
        return F.try_divide(x - q(0.5), q(0.75) - q(0.25))
    if method == "minmax":
        return F.try_divide(x - F.min(x).over(_file()), F.max(x).over(_file()) - F.min(x).over(_file()))
    if method == "range90":
        return F.try_divide(x, q(0.95) - q(0.05))
    raise ValueError(f"unknown scaling {method!r}")


def scale_selected(signals: DataFrame, column: str, method: str = "robust", out: str | None = None) -> DataFrame:
    """Adds what :func:`scaled` gives for robust and range90, for recordings of any length.

    The quantiles of a recording are selected by counting (:func:`.quantiles.exact_quantiles`), so
    neither a window nor a buffer holds a recording.
    """
    shares = {"robust": [0.5, 0.25, 0.75], "range90": [0.05, 0.95]}
    if method not in shares:
        raise ValueError(f"no quantiles in scaling {method!r}")
    told = exact_quantiles(signals, ["file_id"], column, shares[method]).select(F.col("file_id").alias("__file"), F.col("quantiles").alias("__q"))
    x, q = F.col(column), F.col("__q")
    value = F.try_divide(x - q[0], q[2] - q[1]) if method == "robust" else F.try_divide(x, q[1] - q[0])
    return signals.join(told, F.col("file_id").eqNullSafe(F.col("__file")), "left").withColumn(out or f"{column}_scaled", value).drop("__file", "__q")


def zscore_outlier(column: str, limit: float = 5.0) -> Column:
    """Whether a sample lies more than ``limit`` standard deviations from the file's mean."""
    x = F.col(column)
    return F.coalesce(F.abs(F.try_divide(x - F.avg(x).over(_file()), F.stddev_samp(x).over(_file()))) > limit, F.lit(False))


def slope_sum(signals: DataFrame, column: str, win: int, out: str = "ssf", block_rows: int | None = None) -> DataFrame:
    """Adds the sum of the positive increments of the last ``win`` samples; NULL before there are so many.

    With ``block_rows`` a block of a recording and ``win`` samples before it are all that a task orders.
    """
    if block_rows is not None:
        w = Window.partitionBy("file_id", "block").orderBy("position")
        rise = F.greatest(F.col(column) - F.coalesce(F.lag(column).over(w), F.lit(0.0)), F.lit(0.0))
        halo = in_blocks(with_positions(signals), block_rows, before=win).withColumn("__d", rise)
        summed = halo.withColumn(out, F.when(F.col("position") >= win - 1, F.sum("__d").over(w.rowsBetween(1 - win, 0))))
        return summed.where("core").drop("__d", "position", "total", "block", "core")
    rise = F.greatest(F.col(column) - F.coalesce(F.lag(column).over(_order()), F.lit(0.0)), F.lit(0.0))
    numbered = signals.withColumns({"__d": rise, "__n": F.row_number().over(_order())})
    total = F.sum("__d").over(_order().rowsBetween(1 - win, 0))
    return numbered.withColumn(out, F.when(F.col("__n") >= win, total)).drop("__d", "__n")


def run_starts(signals: DataFrame, column: str) -> DataFrame:
    """The first row of each run of equal values, with ``before``: the value of the run before it."""
    return signals.withColumn("before", F.lag(column).over(_order())).where(F.col("before").isNull() | (F.col(column) != F.col("before")))


def _with_runs(signals: DataFrame, column: str) -> DataFrame:
    """Adds __x (missing: 0), __n (row number from 1) and __a (the sample before)."""
    seen = signals.withColumns({"__x": F.coalesce(F.col(column).cast("double"), F.lit(0.0)), "__n": F.row_number().over(_order())})
    return seen.withColumn("__a", F.lag("__x").over(_order()))


def local_maxima(signals: DataFrame, column: str) -> DataFrame:
    """The first row of each local maximum, with its position (from 1) and plateau_size.

    Missing samples count as 0, and equal samples in a row are one plateau, which is a maximum if
    the samples before and after it are lower. Rows that begin a run of equal values are all that
    the neighbours need to be sought among: one order serves for everything.
    """
    begins = _with_runs(signals, column).where("__a is null or __x <> __a")
    seen = begins.withColumns({"__b": F.lead("__x").over(_order()), "__m": F.lead("__n").over(_order())})
    top = seen.where((F.col("__x") > F.col("__a")) & (F.col("__x") > F.col("__b")))
    return top.withColumn("plateau_size", (F.col("__m") - F.col("__n")).cast("long")).drop("__x", "__a", "__b", "__m").withColumnRenamed("__n", "position")


def peak_windows(signals: DataFrame, column: str, size: int) -> DataFrame:
    """file_id, ts, position, window: the samples around the middle of each local maximum.

    size // 2 samples before the peak and as many as make the size from it on; peaks without
    size // 2 samples on both sides are left out.
    """
    half = size // 2
    runs = _with_runs(signals, column)
    begins = F.col("__a").isNull() | (F.col("__x") != F.col("__a"))
    before = _order().rowsBetween(Window.unboundedPreceding, 0)
    # What comes after the run is sought in the reversed order, since frames grow cheaply in one direction only.
    back = _file().orderBy(F.desc("ts")).rowsBetween(Window.unboundedPreceding, -1)
    last = lambda c, frame: F.last(F.when(F.col("__begins"), F.col(c)), ignorenulls=True).over(frame)
    seen = runs.withColumn("__begins", begins).withColumns({"__m": last("__n", back), "__b": last("__x", back), "__left": last("__n", before), "__low": last("__a", before), "window": F.collect_list("__x").over(_order().rowsBetween(-half, size - half - 1)), "__end": F.lead("__x", half).over(_order())})
    middle = F.floor((F.col("__left") + F.col("__m") - 1) / 2) == F.col("__n")
    top = seen.where(middle & (F.col("__x") > F.col("__low")) & (F.col("__x") > F.col("__b")) & (F.col("__n") > half) & F.col("__end").isNotNull())
    return top.select("file_id", "ts", F.col("__n").alias("position"), "window")


def peak_properties(signals: DataFrame, column: str) -> DataFrame:
    """file_id, ts, peak_sample (from 0) and all properties of every peak, without any condition; missing samples count as 0."""
    indices = [k for k in filters.PEAK_INDICES if k != "index"]

    def run(c: dict[str, np.ndarray]) -> dict:
        p = filters.find_peaks(np.nan_to_num(c[column]))
        return {"ts": c["ts"][p["index"]], "peak_sample": p["index"], "plateau_size": p["right_edge"] - p["left_edge"] + 1} | {k: p[k] for k in (*indices, *filters.PEAK_VALUES)}

    told = signals.select("file_id", "ts", F.col(column).cast("double").alias(column))
    fields = ", ".join([*(f"`{k}` long" for k in ("peak_sample", "plateau_size", *indices)), *(f"`{k}` double" for k in filters.PEAK_VALUES)])
    return by_file(told, run, f"file_id {_kind(signals)}, ts timestamp_ntz, {fields}")


def slope_sum_peaks(signals: DataFrame, column: str, fs: float, most_bpm: float = 180, prominence: float = 1e-2) -> DataFrame:
    """file_id, ts, value, start: peaks of a slope sum at the left edges of their plateaus, and the first sample's time.

    Peaks nearer than int(most_bpm * 60 / fs) samples to a higher one and those of little
    prominence are left out.
    """
    distance = max(1, int(most_bpm * 60 / fs))

    def run(c: dict[str, np.ndarray]) -> dict:
        x, ts = np.nan_to_num(c[column]), c["ts"]
        at = filters.find_peaks(x, distance=distance, prominence=prominence)["left_edge"]
        return {"ts": ts[at], "value": x[at], "start": ts[0]}

    told = signals.select("file_id", "ts", F.col(column).cast("double").alias(column))
    return by_file(told, run, f"file_id {_kind(signals)}, ts timestamp_ntz, value double, start timestamp_ntz")


def adaptive_peaks(candidates: DataFrame, column: str, ratio: float = 0.7, baseline_seconds: float = 3.0, memory: int = 5, start: Column | None = None) -> DataFrame:
    """file_id, ts, value, threshold of the candidates above a moving threshold.

    The threshold starts at ratio times the greatest candidate of the baseline, which keeps those
    above it; each later candidate above the threshold is kept and makes it ratio times the median
    of the last ``memory`` kept ones. A sequential state per recording: one pass over its
    candidates in time order, Arrow batches per file.
    """
    if ratio < 0:
        raise ValueError("the ratio must not be negative")

    def run(c: dict[str, np.ndarray]) -> dict:
        t, v = c["ts"], c["value"]
        until = c.get("start", t)[0] + np.timedelta64(int(baseline_seconds * 1e6), "us")
        base = v[t <= until]
        threshold = ratio * base.max() if len(base) else 0.0
        first = (t <= until) & (v > threshold)
        out = [(a, b, threshold) for a, b in zip(t[first], v[first], strict=True)]
        last = collections.deque((o[1] for o in out), memory)
        for a, b in zip(t[t >= until], v[t >= until].tolist(), strict=True):
            if b > threshold:
                if out and out[-1][0] == a:  # the baseline's last sample, kept already
                    out.pop()
                else:
                    last.append(b)
                few = sorted(last)
                threshold = ratio * (few[len(few) // 2] + few[(len(few) - 1) // 2]) / 2
                out.append((a, b, threshold))
        kept = zip(*out, strict=True) if out else ([], [], [])
        return dict(zip(("ts", "value", "threshold"), (np.array(k, dtype) for k, dtype in zip(kept, (t.dtype, float, float), strict=True)), strict=True))

    told = candidates.select("file_id", "ts", F.col(column).cast("double").alias("value"), *([start.alias("start")] if start is not None else []))
    return by_file(told, run, f"file_id {_kind(candidates)}, ts timestamp_ntz, value double, threshold double")


def prominent_peaks(signals: DataFrame, column: str, prominence: float = 0.4, width: float = 10) -> DataFrame:
    """file_id, ts, value, prominence of peaks of the min-max scaled signal; widths in samples."""

    def run(c: dict[str, np.ndarray]) -> dict:
        x = np.nan_to_num(c[column])
        p = filters.find_peaks((x - x.min()) / ((x.max() - x.min()) or 1.0), prominence=prominence, width=width)
        return {"ts": c["ts"][p["index"]], "value": x[p["index"]], "prominence": p["prominence"]}

    told = signals.select("file_id", "ts", F.col(column).cast("double").alias(column))
    return by_file(told, run, f"file_id {_kind(signals)}, ts timestamp_ntz, value double, prominence double")


def per_file(signals: DataFrame, column: str, kernel: Callable[[np.ndarray], np.ndarray], out: str) -> DataFrame:
    """file_id, ts, column, out: a numpy kernel over each file's samples in time order."""

    def run(c: dict[str, np.ndarray]) -> dict:
        return {"ts": c["ts"], column: c[column], out: kernel(c[column])}

    told = signals.select("file_id", "ts", F.col(column).cast("double").alias(column))
    return by_file(told, run, f"file_id {_kind(signals)}, ts timestamp_ntz, {column} double, {out} double")


def fir_filter(signals: DataFrame, column: str, fs: float, order: int, frequencies: list[float], kind: str = "lowpass", out: str | None = None, block_rows: int | None = None) -> DataFrame:
    """Zero-phase windowed-sinc filter; missing samples are bridged for filtering and blanked again.

    With ``block_rows`` a recording is filtered in blocks: bridges reach to the nearest known samples
    in any other block, and the filter to as many samples as it has taps on either side.
    """
    taps = filters.fir_taps(order, fs, frequencies, kind)
    if block_rows is not None:
        return _fir_in_blocks(signals, column, taps, out or f"{column}_filtered", block_rows)

    def kernel(x: np.ndarray) -> np.ndarray:
        y = filters.zero_phase(filters.fill_linear(x), taps)
        y[np.isnan(x)] = np.nan
        return y

    return per_file(signals, column, kernel, out or f"{column}_filtered")


def _fir_in_blocks(signals: DataFrame, column: str, taps: np.ndarray, out: str, rows: int) -> DataFrame:
    def bridge(c: dict[str, np.ndarray]) -> dict:
        at, x = known_points(c, column)
        filled = np.interp(c["position"], at, x) if len(at) else c[column]
        return {"ts": c["ts"], "position": c["position"], "total": c["total"], column: c[column], out: filled}

    def smooth(c: dict[str, np.ndarray]) -> dict:
        y = filters.zero_phase(c[out], taps)
        y[np.isnan(c[column])] = np.nan
        own = c["core"].astype(bool)
        return {"ts": c["ts"][own], column: c[column][own], out: y[own]}

    told = signals.select("file_id", "ts", F.col(column).cast("double").alias(column))
    near = with_neighbours(in_blocks(with_positions(told), rows), column).drop("core")
    schema = f"file_id {_kind(signals)}, ts timestamp_ntz, {column} double, {out} double"
    filled = by_file(near, bridge, f"{schema}, position long, total long", "position", ("file_id", "block"))
    halo = in_blocks(filled, rows, len(taps), len(taps))
    return by_file(halo, smooth, schema, "position", ("file_id", "block"))


def fill_gaps(signals: DataFrame, column: str, out: str | None = None, block_rows: int | None = None) -> DataFrame:
    """Monotone cubic interpolation of missing samples inside the known range.

    With ``block_rows`` a recording is filled in blocks, each with the two nearest known samples on
    either side, which is as far as the cubics reach.
    """
    if block_rows is not None:
        name = out or f"{column}_clean"

        def fill(c: dict[str, np.ndarray]) -> dict:
            gaps, y = np.isnan(c[column]), c[column].copy()
            y[gaps] = filters.pchip(*known_points(c, column), c["position"][gaps].astype(float))
            return {"ts": c["ts"], column: c[column], name: y}

        told = signals.select("file_id", "ts", F.col(column).cast("double").alias(column))
        near = with_neighbours(in_blocks(with_positions(told), block_rows), column).drop("core", "total")
        return by_file(near, fill, f"file_id {_kind(signals)}, ts timestamp_ntz, {column} double, {name} double", "position", ("file_id", "block"))
    return per_file(signals, column, filters.fill_pchip, out or f"{column}_clean")


def band_power(signals: DataFrame, column: str, fs: float, bands: dict[str, tuple[float | None, float | None]], epoch_size: float, epoch_overlap: float, scaling: str = "density", relative: bool = False) -> DataFrame:
    """file_id, epoch, and a column ``<column>_<band>_abs`` or ``_rel`` for each band; short files give no rows."""
    names = [f"{column}_{b}_{'rel' if relative else 'abs'}" for b in bands]

    def run(c: dict[str, np.ndarray]) -> dict:
        if len(c[column]) < int(epoch_size * fs):
            return {}
        got = dict(zip(names, spectral.band_powers(np.nan_to_num(c[column]), fs, bands, epoch_size, epoch_overlap, scaling, relative).values(), strict=True))
        return {"epoch": np.arange(len(got[names[0]]))} | got

    told = signals.select("file_id", "ts", F.col(column).cast("double").alias(column))
    return by_file(told, run, f"file_id {_kind(signals)}, epoch long, " + ", ".join(f"`{n}` double" for n in names))


def interpolate_nn(nn: DataFrame, fs: float, column: str = "nn") -> DataFrame:
    """file_id, ts, <column>i: good intervals on a uniform grid by monotone cubics; files with fewer than two give none. Intervals of unknown length are not bridged."""

    def run(c: dict[str, np.ndarray]) -> dict:
        t = c["ts"].astype("datetime64[us]").astype(np.int64)
        if len(t) < 2:
            return {}
        grid = t[0] + np.round(np.arange(int((t[-1] - t[0]) * fs / 1e6 + 1e-9) + 1) * 1e6 / fs).astype(np.int64)
        return {"ts": grid.astype("datetime64[us]"), f"{column}i": filters.pchip_runs(t.astype(float), c[column].astype(float), grid.astype(float))}

    good = nn.where("not bad") if "bad" in nn.columns else nn
    return by_file(good.select("file_id", "ts", column), run, f"file_id {_kind(nn)}, ts timestamp_ntz, {column}i double")
