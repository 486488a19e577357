"""Numpy kernels on one series: band power, detrended fluctuation, robust regression."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


def power_density(x: np.ndarray, fs: float, scaling: str = "density") -> tuple[np.ndarray, np.ndarray]:
    """One-sided Hann periodogram of each row after removing its mean: (frequencies, rows of power)."""
    n = x.shape[-1]
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)
    spectrum = np.abs(np.fft.rfft((x - x.mean(-1, keepdims=True)) * window, axis=-1)) ** 2
    spectrum /= fs * (window**2).sum() if scaling == "density" else window.sum() ** 2
    spectrum[..., 1 : -1 if n % 2 == 0 else None] *= 2
    return np.fft.rfftfreq(n, 1 / fs), spectrum


def simpson(y: np.ndarray, dx: float) -> np.ndarray:
    """Composite Simpson rule over the last axis; an even number of points ends with a corrected interval."""
    n = y.shape[-1]
    if n == 1:
        return np.zeros(y.shape[:-1])
    if n == 2:
        return dx * (y[..., 0] + y[..., 1]) / 2
    odd = n if n % 2 else n - 1
    total = dx / 3 * (y[..., 0:odd:2].sum(-1) * 2 - y[..., 0] - y[..., odd - 1] + 4 * y[..., 1 : odd - 1 : 2].sum(-1))
    if n % 2 == 0:
        total = total + dx * (5 * y[..., -1] + 8 * y[..., -2] - y[..., -3]) / 12
    return total


def epochs(x: np.ndarray, size: int, overlap: int) -> np.ndarray:
    """Rows of ``size`` samples that share ``overlap`` with the row before."""
    if size > len(x):
        raise ValueError("an epoch is longer than the data")
    return np.lib.stride_tricks.sliding_window_view(x, size)[:: max(size - overlap, 1)]


def band_powers(x: np.ndarray, fs: float, bands: dict[str, tuple[float | None, float | None]], size_s: float, overlap_s: float, scaling: str = "density", relative: bool = False) -> dict[str, np.ndarray]:
    """Power of each band in each epoch, integrated over [start, stop); empty bands are NaN."""
    rows = epochs(x, int(size_s * fs), int(overlap_s * fs))
    freq, power = power_density(rows, fs, scaling)
    step = freq[1] - freq[0]
    total = simpson(power, step)
    out = {}
    for name, (lo, hi) in bands.items():
        inside = (freq >= (lo or 0)) & (freq < (fs / 2 if hi is None else hi))
        value = simpson(power[:, inside], step) if inside.any() else np.full(len(rows), np.nan)
        out[f"{name}_{'rel' if relative else 'abs'}"] = value / total if relative else value
    return out


def sliding_mean_power(x: np.ndarray, fs: float, size: int, hop: int, bins: np.ndarray) -> np.ndarray:
    """Mean over epochs of what :func:`power_density` gives at some bins, at a cost that does not grow with the overlap.

    A bin of an epoch is a difference of two running sums of samples times the bin's oscillation,
    turned back by the epoch's start. The Hann window mixes each bin with its neighbours, and
    removing an epoch's mean clears its bin 0, so no epoch is ever transformed by itself.
    """
    starts = np.arange(0, len(x) - size + 1, hop)
    centred = x - x.mean()
    places = np.arange(len(x))
    made: dict[int, np.ndarray] = {}

    def plain(k: int) -> np.ndarray:
        """Bin k of each epoch without a window."""
        k = k % size
        if k == 0:
            return np.zeros(len(starts), complex)
        if k > size - k:
            return np.conj(plain(size - k))
        if k not in made:
            turn = np.exp(-2j * np.pi * (k * np.arange(size) % size) / size)
            sums = np.concatenate([[0], np.cumsum(centred * turn[places % size])])
            made[k] = np.conj(turn[starts % size]) * (sums[starts + size] - sums[starts])
        return made[k]

    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(size) / size)
    out = np.empty(len(bins))
    for i, k in enumerate(bins.tolist()):
        out[i] = np.mean(np.abs(plain(k) / 2 - (plain(k - 1) + plain(k + 1)) / 4) ** 2) * (1 if k == 0 or 2 * k == size else 2)
        made.pop(k - 1, None)
    return out / (fs * (window**2).sum())


def mean_band_power(x: np.ndarray, fs: float, lo: float, hi: float, size_s: float, overlap_s: float) -> float | None:
    """Mean over epochs; None if the series is too short or the band empty.

    Where epochs overlap much, by running sums for the band's bins alone.
    """
    size = int(size_s * fs)
    if len(x) < size or size < 2:
        return None
    hop, freq = max(size - int(overlap_s * fs), 1), np.fft.rfftfreq(size, 1 / fs)
    bins = np.flatnonzero((freq >= lo) & (freq < hi))
    if len(bins) and len(bins) * hop < size:
        return float(simpson(sliding_mean_power(x, fs, size, hop, bins), freq[1] - freq[0]))
    value = float(np.mean(band_powers(x, fs, {"b": (lo, hi)}, size_s, overlap_s)["b_abs"]))
    return None if np.isnan(value) else value


def dfa(x: np.ndarray, windows: Iterable[int]) -> float | None:
    """Exponent of the fluctuation of the integrated series around linear trends."""
    profile = np.cumsum(x - x.mean())
    sizes, fluctuation = [], []
    for n in windows:
        count = len(profile) // n
        if count < 1 or n < 3:
            continue
        parts = profile[: count * n].reshape(count, n)
        t = np.arange(n) - (n - 1) / 2
        slope = parts @ t / (t @ t)
        rest = parts - parts.mean(1, keepdims=True) - slope[:, None] * t
        f = np.sqrt((rest**2).mean())
        if f > 0:
            sizes.append(n)
            fluctuation.append(f)
    return float(np.polyfit(np.log(sizes), np.log(fluctuation), 1)[0]) if len(sizes) > 1 else None


def huber_line(x: np.ndarray, y: np.ndarray, bound: float = 1.345, tolerance: float = 1e-3, rounds: int = 50) -> tuple[float, float, float]:
    """(slope, intercept, Pearson r) of a Huber M-estimate by reweighting, scale from the MAD."""
    slope, intercept, r = huber_lines(np.asarray(x, float)[None], np.asarray(y, float)[None], bound, tolerance, rounds)
    return float(slope[0]), float(intercept[0]), float(r[0])


def huber_lines(x: np.ndarray, y: np.ndarray, bound: float = 1.345, tolerance: float = 1e-3, rounds: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`huber_line`, for many equally long sequences at once, one in each row; NaN where x does not vary or values are not finite."""

    def centred(v: np.ndarray, weight: np.ndarray | float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        mean = (weight * v).sum(1, keepdims=True) / np.broadcast_to(weight, v.shape).sum(1, keepdims=True)
        return mean[:, 0], v - mean

    def line(x: np.ndarray, y: np.ndarray, weight: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
        (mx, dx), (my, dy) = centred(x, weight), centred(y, weight)
        b = (weight * dx * dy).sum(1) / (weight * dx * dx).sum(1)
        return b, my - b * mx

    with np.errstate(all="ignore"):
        sound = np.isfinite(x).all(1) & np.isfinite(y).all(1) & (np.ptp(x, axis=1) > 0)
        slope, intercept, r = (np.full(len(x), np.nan) for _ in range(3))
        dx, dy = centred(x)[1], centred(y)[1]
        varied = sound & (np.ptp(y, axis=1) > 0)
        r[varied] = ((dx * dy).sum(1) / np.sqrt((dx * dx).sum(1) * (dy * dy).sum(1)))[varied]
        at = np.flatnonzero(sound)
        x, y = x[at], y[at]
        slope[at], intercept[at] = line(x, y, 1.0)
        for _ in range(rounds):
            if not len(at):
                break
            rest = y - slope[at, None] * x - intercept[at, None]
            scale = np.median(np.abs(rest - np.median(rest, axis=1, keepdims=True)), axis=1) / 0.6744897501960817
            going = scale > 1e-12 * np.max(np.abs(y), axis=1)  # otherwise most samples lie on the line
            at, x, y, rest, scale = at[going], x[going], y[going], np.abs(rest[going]), scale[going, None]
            b, a = line(x, y, np.where(rest <= bound * scale, 1.0, bound * scale / np.maximum(rest, 1e-300)))
            going = np.maximum(np.abs(b - slope[at]), np.abs(a - intercept[at])) >= tolerance * 1e-3
            slope[at], intercept[at] = b, a
            at, x, y = at[going], x[going], y[going]
    return slope, intercept, r
