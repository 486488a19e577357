import numpy as np
import pytest

from somatiq.kernels import filters, spectral


def test_sine_has_its_power_in_its_band():
    fs, n = 100.0, 1000
    x = 3 * np.sin(2 * np.pi * 10 * np.arange(n) / fs)
    got = spectral.band_powers(x, fs, {"in": (8, 12), "out": (20, 40)}, 10, 0)
    assert got["in_abs"][0] > 1e6 * got["out_abs"][0]
    rel = spectral.band_powers(x, fs, {"in": (8, 12)}, 10, 0, relative=True)
    assert rel["in_rel"][0] == pytest.approx(1, rel=0.02)


def test_noise_has_a_flat_density():
    x = np.random.default_rng(0).normal(size=40_000)
    got = spectral.band_powers(x, 100.0, {"b": (10, 30)}, 10, 0)
    assert got["b_abs"].mean() == pytest.approx(0.4, rel=0.05)


def test_long_epoch_and_empty_band():
    with pytest.raises(ValueError):
        spectral.band_powers(np.zeros(10), 1.0, {"b": (0, 1)}, 20, 0)
    assert np.isnan(spectral.band_powers(np.random.default_rng(0).normal(size=20), 1.0, {"b": (5, 6)}, 10, 0)["b_abs"]).all()


@pytest.mark.parametrize("n", [2, 3, 4, 5, 8, 9])
def test_simpson_is_exact_for_lines(n):
    assert spectral.simpson(np.arange(n, dtype=float), 1.0) == pytest.approx((n - 1) ** 2 / 2)


def test_dfa_of_noise_and_of_its_sum():
    x = np.random.default_rng(1).normal(size=4000)
    assert spectral.dfa(x, range(16, 64)) == pytest.approx(0.5, abs=0.1)
    assert spectral.dfa(np.cumsum(x), range(16, 64)) == pytest.approx(1.5, abs=0.1)


def test_huber_line_ignores_outliers():
    x = np.arange(100.0)
    y = 2 * x + 1 + np.random.default_rng(0).normal(0, 0.1, 100)
    y[::17] += 500
    slope, intercept, _ = spectral.huber_line(x, y)
    assert slope == pytest.approx(2, abs=0.02)
    assert intercept == pytest.approx(1, abs=1)


def test_lowpass_keeps_slow_and_drops_fast():
    t = np.arange(2000) / 100
    slow, fast = np.sin(2 * np.pi * 1 * t), np.sin(2 * np.pi * 30 * t)
    y = filters.zero_phase(slow + fast, filters.fir_taps(100, 100, [5], "lowpass"))
    assert np.abs(y - slow)[200:-200].max() < 0.05


def test_bandpass_drops_the_mean():
    y = filters.zero_phase(np.full(1000, 7.0), filters.fir_taps(100, 100, [5, 20], "bandpass"))
    assert np.abs(y).max() < 0.1


def test_pchip_keeps_points_and_order():
    x, y = np.array([0.0, 1, 2, 4]), np.array([0.0, 1, 1, 5])
    at = np.linspace(0, 4, 81)
    got = filters.pchip(x, y, at)
    assert got[[0, 20, 40, 80]] == pytest.approx(y)
    assert (np.diff(got) >= -1e-12).all()
    assert np.isnan(filters.pchip(x, y, np.array([-1.0, 5.0]))).all()


def test_fill_pchip_leaves_the_ends():
    got = filters.fill_pchip(np.array([np.nan, 1, np.nan, 3, np.nan]))
    assert np.isnan(got[[0, 4]]).all() and got[2] == pytest.approx(2)


def test_find_peaks():
    x = np.array([0, 1, 0, 3, 3, 3, 0, 2, 0.0])
    got = filters.find_peaks(x)
    assert got["index"].tolist() == [1, 4, 7] and got["left_edge"].tolist() == [1, 3, 7] and got["right_edge"].tolist() == [1, 5, 7]
    assert got["prominence"].tolist() == [1, 3, 2] and got["height"].tolist() == [1, 3, 2]
    assert filters.find_peaks(x, distance=4)["index"].tolist() == [4]
    assert filters.find_peaks(x, prominence=2.5)["index"].tolist() == [4]


def plain_peaks(x, distance, prominence, width, window):
    """Peaks by walking from sample to sample."""
    n, tops, i = len(x), [], 1
    while i < n - 1:
        j = i
        while j < n - 1 and x[j] == x[i]:
            j += 1
        if x[i - 1] < x[i] > x[j]:
            tops.append(((i + j - 1) // 2, i, j - 1))
        i = j if j > i else i + 1
    keep = [True] * len(tops)
    for k in sorted(range(len(tops)), key=lambda k: (x[tops[k][0]], k), reverse=True):
        if keep[k]:
            keep = [ok and (m == k or abs(tops[m][0] - tops[k][0]) >= distance) for m, ok in enumerate(keep)]
    out = []
    for (p, left, right), ok in zip(tops, keep, strict=True):
        ends = (0, n - 1) if window is None else (max(0, p - window // 2), min(n - 1, p + window // 2))
        bases = []
        for step, end in ((-1, ends[0]), (1, ends[1])):
            i = best = p
            while i != end + step and x[i] <= x[p]:
                best = i if x[i] < x[best] else best
                i += step
            bases.append(best)
        prom = x[p] - max(x[b] for b in bases)
        level, at = x[p] - prom / 2, []
        for step, base in ((-1, bases[0]), (1, bases[1])):
            i = p
            while i != base and x[i] > level:
                i += step
            at.append(i - step * (level - x[i]) / (x[i - step] - x[i]) if x[i] < level else float(i))
        if ok and prom >= prominence and at[1] - at[0] >= width:
            out.append((p, left, right, *bases, prom, *at))
    return out


@pytest.mark.parametrize("seed", range(8))
def test_find_peaks_matches_walking(seed):
    rng = np.random.default_rng(seed)
    for k in range(60):
        x = rng.integers(0, 6, rng.integers(3, 60)).astype(float) if k % 2 else np.cumsum(rng.normal(size=rng.integers(3, 80)))
        how = {"distance": int(rng.integers(1, 6)), "prominence": float(rng.choice([0, 0.5, 2])), "width": float(rng.choice([0, 1.5])), "window": None if k % 3 else int(rng.integers(3, 20))}
        got = filters.find_peaks(x, **how)
        rows = list(zip(*(got[c].tolist() for c in ("index", "left_edge", "right_edge", "left_base", "right_base", "prominence", "left", "right")), strict=True))
        want = plain_peaks(x, **how)
        assert len(rows) == len(want) and np.ravel(rows) == pytest.approx(np.ravel(want))


@pytest.mark.parametrize("size", [2, 7, 60, 61])
def test_sliding_spectra_are_those_of_epochs(size):
    rng = np.random.default_rng(size)
    x = 900 + rng.normal(scale=40, size=500).cumsum()
    for hop in (1, 3, size):
        rows = spectral.epochs(x, size, size - hop)
        want = spectral.power_density(rows, 4.0)[1].mean(0)
        got = spectral.sliding_mean_power(x, 4.0, size, hop, np.arange(len(want)))
        assert got == pytest.approx(want, rel=1e-8, abs=1e-9 * want.max())
    for lo, hi in ((0.04, 0.4), (0.0, 2.0)):
        band = spectral.band_powers(x, 4.0, {"b": (lo, hi)}, size / 4, size / 4 - 0.25)["b_abs"]
        told = spectral.mean_band_power(x, 4.0, lo, hi, size / 4, size / 4 - 0.25)
        assert told is None if np.isnan(band).all() else told == pytest.approx(band.mean(), rel=1e-6)


def test_cubic_splines_sum_to_one():
    assert filters.cubic_splines(np.arange(300) / 4.0, 10.0).sum(1) == pytest.approx(np.ones(300))


def dense_split(y, fs, sparsity=8e-4, smooth=1e-2):
    """The same convex problem by an active set over dense matrices: (phasic, tonic)."""
    n = len(y)
    t = np.arange(n) / fs
    kernel = np.exp(-t / 2.0) - np.exp(-t / 0.7)
    kernel /= max(kernel.max(), 1e-12)
    response = np.array([[kernel[i - j] if i >= j else 0.0 for j in range(n)] for i in range(n)])
    knots = max(1, int(np.ceil(t[-1] / 10.0))) + 3
    hat = lambda u: 2 / 3 - u * u + u**3 / 2 if u < 1 else (2 - u) ** 3 / 6 if u < 2 else 0.0
    basis = np.array([[hat(abs(x / 10.0 - k)) for k in range(-1, knots - 1)] for x in t])
    left = np.linalg.inv(np.eye(n) + basis @ basis.T / smooth)
    q, c = response.T @ left @ response, response.T @ left @ y - sparsity
    d, active = np.zeros(n), np.zeros(n, bool)
    for _ in range(50 * n):
        slope = c - q @ d
        slope[active] = -np.inf
        if slope.max() <= 1e-10 * max(1, np.abs(c).max()):
            break
        active[int(slope.argmax())] = True
        while True:
            z = np.zeros(n)
            z[active] = np.linalg.lstsq(q[np.ix_(active, active)], c[active], rcond=None)[0]
            if (z[active] > 0).all():
                d = z
                break
            down = active & (z <= 0)
            share = (d[down] / np.maximum(d[down] - z[down], 1e-300)).min()
            d = d + share * (z - d)
            active &= d > 1e-14 * max(1, d.max())
            d[~active] = 0
    phasic = response @ d
    return phasic, basis @ np.linalg.solve(basis.T @ basis + smooth * np.eye(basis.shape[1]), basis.T @ (y - phasic))


@pytest.mark.parametrize("seed", range(4))
def test_splits_match_a_dense_solver(seed):
    rng = np.random.default_rng(seed)
    y = 5 + rng.normal(scale=0.3, size=60).cumsum() if seed % 2 else rng.uniform(0, 400, 42)
    phasic, tonic, gap = filters.tonic_phasic(y, 1.0 if seed < 2 else 4.0, tolerance=1e-11, most_rounds=200_000)
    want = dense_split(y, 1.0 if seed < 2 else 4.0)
    assert gap <= 1e-11 and phasic == pytest.approx(want[0], abs=1e-3 * np.ptp(y)) and tonic == pytest.approx(want[1], abs=1e-3 * np.ptp(y))


def test_splits_of_a_batch_are_those_of_its_rows():
    rng = np.random.default_rng(2)
    rows = 5 + rng.normal(scale=0.1, size=(4, 120)).cumsum(1)
    phasic, tonic, gaps = filters.tonic_phasic(rows, 4.0)
    assert (gaps <= 1e-6).all()
    for k in range(4):
        one = filters.tonic_phasic(rows[k], 4.0)
        assert phasic[k] == pytest.approx(one[0], abs=1e-9) and tonic[k] == pytest.approx(one[1], abs=1e-9) and gaps[k] == pytest.approx(one[2])
    exact = filters.tonic_phasic(rows, 4.0, tolerance=1e-10, most_rounds=100_000)
    assert np.abs(phasic - exact[0]).max() < 0.02 * np.ptp(rows)
    # Too few rounds are told, and constant rows need none.
    assert (filters.tonic_phasic(rows, 4.0, most_rounds=3)[2] > 1e-6).all()
    assert (filters.tonic_phasic(np.array([np.zeros(50), np.full(50, 7.0)]), 1.0)[2] <= 1e-6).all()


def test_tonic_phasic_adds_up():
    fs = 4.0
    t = np.arange(400) / fs
    driver = np.zeros(400)
    driver[[80, 200]] = 1
    kernel = np.exp(-t / 2) - np.exp(-t / 0.7)
    y = 5 + 0.01 * t + np.convolve(driver, kernel / kernel.max())[:400]
    phasic, tonic, _ = filters.tonic_phasic(y, fs)
    assert np.abs(phasic + tonic - y).mean() < 0.1
    assert phasic.min() >= -1e-9


def test_huber_lines_solve_equally_long_sequences_together():
    """Each row as it would be alone: outliers, exact lines, constants, a single time and values that are not finite."""
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 8, 40):
        x = np.sort(rng.uniform(0, 1e5, (60, n)), axis=1)
        y = 3e-3 * x + rng.normal(0, 5, x.shape) + (rng.random(x.shape) < 0.1) * 500
        x[0], y[1], y[2] = 7.0, 0.1, 2 * x[2] + 1
        y[3, 0] = np.nan
        slope, intercept, r = spectral.huber_lines(x, y)
        for i in range(60):
            if i in (0, 3) or n == 1:
                assert np.isnan(slope[i]) and np.isnan(intercept[i]) and np.isnan(r[i])
                continue
            weight, line = np.ones(n), np.polyfit(x[i], y[i], 1)
            for _ in range(50):
                rest = np.abs(y[i] - np.polyval(line, x[i]))
                scale = np.median(np.abs(y[i] - np.polyval(line, x[i]) - np.median(y[i] - np.polyval(line, x[i])))) / 0.6744897501960817
                if scale <= 1e-9:
                    break
                weight = np.where(rest <= 1.345 * scale, 1.0, 1.345 * scale / np.maximum(rest, 1e-300))
                new = np.polyfit(x[i], y[i], 1, w=np.sqrt(weight))
                done, line = np.max(np.abs(new - line)) < 1e-6, new
                if done:
                    break
            assert (slope[i], intercept[i]) == pytest.approx(tuple(line), rel=1e-6, abs=1e-6)
            assert np.isnan(r[i]) if i == 1 else r[i] == pytest.approx(np.corrcoef(x[i], y[i])[0, 1], abs=1e-9)


def test_whole_groups_split_no_run():
    import pyarrow as pa

    from somatiq.operators.byfile import whole_groups

    key = [None] * 3 + [1] * 4 + [2] * 25 + [3] + [4] * 7
    for size in (1, 3, 4, 10, 100):
        batches = [pa.record_batch({"k": pa.array(key[i : i + size], "int64"), "v": pa.array(range(i, min(i + size, len(key))))}) for i in range(0, len(key), size)]
        got = list(whole_groups(iter(batches), ["k"], 5))
        assert pa.concat_tables(t for t, _ in got).column("v").to_pylist() == list(range(len(key)))
        runs = [(t.column("k")[int(a)].as_py(), int(n)) for t, s in got for a, n in zip(s, np.diff(s, append=t.num_rows), strict=True)]
        assert runs == [(None, 3), (1, 4), (2, 25), (3, 1), (4, 7)] and all(t.num_rows >= 5 for t, _ in got[:-1])
