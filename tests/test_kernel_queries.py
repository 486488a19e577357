"""Queries that SQL does not express, against plain versions over whole tables."""

import numpy as np
import pandas as pd
import pytest

from somatiq.kernels import filters
from somatiq.plans.catalogue import QUERIES

from .test_kernels import dense_split, plain_peaks


@pytest.fixture(scope="module")
def events(sf):
    e = pd.read_parquet(f"{sf}/events.parquet").sort_values(["user_id", "ts"])
    e["us"] = e.ts.to_numpy().astype("datetime64[us]").astype(np.int64)
    e["k"] = e.props.str.extract(r'"k"\s*:\s*"?(\d+)')[0].astype(int)
    return e


def test_ssf_peaks(spark, sf, events):
    want = []
    for file, e in events.groupby("user_id"):
        x, t = e.value.to_numpy(float), e.us.to_numpy()
        rise = np.maximum(np.diff(x, prepend=0.0), 0)
        ssf = np.array([rise[i - 3 : i + 1].sum() if i >= 3 else 0.0 for i in range(len(x))])
        peaks = [p[1] for p in plain_peaks(ssf, 3, 1e-2, 0, None)]
        until = t[0] + 86_400_000_000
        early = [i for i in peaks if t[i] <= until]
        threshold = 0.5 * max(ssf[i] for i in early) if early else 0.0
        kept = [i for i in early if ssf[i] > threshold]
        want += [(file, t[i], ssf[i], threshold) for i in kept]
        for i in peaks:
            if t[i] > until and ssf[i] > threshold:
                kept.append(i)
                threshold = 0.5 * float(np.median([ssf[j] for j in kept[-5:]]))
                want.append((file, t[i], ssf[i], threshold))
    got = sorted(map(tuple, QUERIES["ssf_peaks"](spark, sf).collect()))
    assert len(want) > 20 and np.array(got) == pytest.approx(np.array(sorted(want)), abs=1e-6)


def test_linear_trend_robust(spark, sf, events):
    got = {(r.file_id, r.reference): r for r in QUERIES["linear_trend_robust"](spark, sf).collect()}
    assert len({file for file, reference in got if reference == "session_0"}) == events.user_id.nunique()
    for file, e in events.groupby("user_id"):
        x, y = (e.us.to_numpy() - e.us.min()) / 1e6, e.value.to_numpy(float)
        weight, line = np.ones(len(x)), (0.0, 0.0)
        for _ in range(400):
            mx, my = np.average(x, weights=weight), np.average(y, weights=weight)
            slope = (weight * (x - mx) * (y - my)).sum() / (weight * (x - mx) ** 2).sum()
            rest = y - slope * x - (my - slope * mx)
            scale = np.median(np.abs(rest - np.median(rest))) / 0.6744897501960817
            weight, line = np.minimum(1, 1.345 * scale / np.maximum(np.abs(rest), 1e-12)), (slope, my - slope * mx)
        told = got[file, "session_0"]
        assert told.slope * x.max() == pytest.approx(line[0] * x.max(), abs=0.05) and told.intercept == pytest.approx(line[1], abs=0.05)
        assert told.r == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-6)


def test_cvx_split(spark, sf, events):
    got = {(r.file_id, r.ts): r for r in QUERIES["cvx_split"](spark, sf).collect()}
    assert len(got) == len(events) and all(r.gap is None or r.gap <= 1e-6 for r in got.values())
    for file, e in events.groupby("user_id"):
        x = e.value.to_numpy(float)
        n = len(x)
        # Seconds are samples: epochs of 40 and a margin of 2, each 20 on; margins are cut at both ends.
        starts = range(0, n - 42 + 1, 20) if n >= 62 else [0]
        total, count = np.zeros((2, n)), np.zeros(n)
        for k in starts:
            own, inner = (np.arange(k, k + 42), slice(2, -2)) if n >= 62 else (np.arange(n), slice(None))
            total[:, own[inner]] += np.array(dense_split(x[own], 1.0))[:, inner]
            count[own[inner]] += 1
        split = np.flatnonzero(count)
        for i in range(n):
            told = got[file, (i + 1) * 1_000_000]
            warm = i <= split[0] + 2 or i >= split[-1] - 2
            assert told.annotation == ("CVX warm up" if warm else "") and (told.gap is None) == (count[i] == 0)
            if warm:
                assert told.scr is None and told.scl is None
            else:
                assert (told.scr, told.scl) == pytest.approx(tuple(total[:, i] / count[i]), abs=0.02 * np.ptp(x))


def test_two_starts_of_a_long_split(spark):
    """Epochs are cut by counts of samples, and a recording just too short for a step is split at once."""
    from pyspark.sql import functions as F

    from somatiq.operators import eda

    clock = lambda name, n: spark.range(n).select(F.lit(name).alias("file_id"), F.timestamp_micros(F.col("id") * 500_000).cast("timestamp_ntz").alias("ts"), F.sin("id").alias("x"))
    got = eda.tonic_phasic(clock("short", 139).unionByName(clock("long", 140)), "x", 2.0, 50, 10, 10).toPandas()
    told = got.groupby("file_id").agg(rows=("ts", "size"), split=("gap", "count"), kept=("scl", "count"))
    # 100 + 20 samples an epoch, 20 a step: two epochs in 140 samples, samples 20 to 119; 20 more at either end are warm.
    assert told.loc["long"].tolist() == [140, 100, 58] and told.loc["short"].tolist() == [139, 139, 97]


def test_gsr_clean(spark, sf, events):
    got = {(r.file_id, r.ts): r for r in QUERIES["gsr_clean"](spark, sf).collect()}
    assert len(got) == len(events) and {r.status for r in got.values()} == {"ok", "corrupted"}
    taps = filters.fir_taps(10, 1.0, [0.3], "lowpass")
    for file, e in events.groupby("user_id"):
        raw = np.where(e.k % 10 == 0, np.nan, np.where(e.k % 10 == 1, 0.0, e.value * 5 - 100))
        if file % 7 == 0:
            raw = np.where(raw > -100, np.nan, raw)
        x, note = 1000 / (2 * raw + 1), np.where(np.isnan(raw), "unknown", "")
        t, clicks = e.us.to_numpy(), e.us[e.event_type == "click"]
        if len(clicks):
            out = (t <= clicks.min() - 30_000_000) | (t >= clicks.max() + 30_000_000)
            x, note = np.where(out, np.nan, x), np.where(out, "outside_session", note)
        inside = note != "outside_session"
        bad = (note[inside] != "").mean() > 0.6
        z = np.abs((x - np.nanmean(x)) / np.nanstd(x, ddof=1)) > 5
        x, note = np.where(z, np.nan, x), np.where(z, "outlier", note)
        y = filters.zero_phase(filters.fill_linear(x), taps)
        y[np.isnan(x)] = np.nan
        clean = filters.fill_pchip(y)
        scaled = (clean - np.nanmean(clean)) / np.nanstd(clean)
        for i in range(len(e)):
            told = got[file, int(t[i])]
            assert told.status == ("corrupted" if bad else "ok") and (told.annotation == note[i] or z[i])
            for have, want in ((told.gsr_filtered, y[i]), (told.gsr_filtered_clean, clean[i]), (told.gsr_filtered_clean_zscored, scaled[i])):
                if bad or np.isnan(want):
                    assert have is None or np.isnan(have)
                else:
                    assert have == pytest.approx(want, abs=1e-5)
