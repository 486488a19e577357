"""Queries over signals, intervals and their features."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import gsr_from_raw, missing_annotation
from ..kernels import filters, spectral
from ..operators import eda, hrv, nn, respiration, signal, summarize
from ..operators.intervals import filter_sequences, slice_join
from .catalogue import ORACLES, query
from .inputs import BEATS, SEQ, SIG, beat_sequences, beats, nn_sql, r6, rounded, samples, sequences, us
from .inputs import nn as nn_table

HRV = ("RMSSD", "meanNN", "SDNN", "medianNN", "pNN50", "pNN20")
_GOOD = f"WITH {SIG}, {SEQ}, {nn_sql()}, good AS (SELECT file_id, ts, nn FROM nn WHERE details = 'OK')"
_TIME = f"""{_GOOD}, j AS (SELECT q.file_id, q.id AS reference, n.nn, n.nn - lag(n.nn) OVER (PARTITION BY q.file_id, q.id ORDER BY n.ts) AS d FROM seq q LEFT JOIN good n ON n.file_id = q.file_id AND n.ts BETWEEN q.b AND q.e),
wide AS (SELECT file_id, reference, sqrt(avg(d * d)) AS "RMSSD", avg(nn) AS "meanNN", stddev_samp(nn) AS "SDNN", quantile_cont(nn, 0.5) AS "medianNN",
  100.0 * count(*) FILTER (d > 50) / nullif(count(nn), 0) AS "pNN50", 100.0 * count(*) FILTER (d > 20) / nullif(count(nn), 0) AS "pNN20" FROM j GROUP BY file_id, reference)"""


@query(f"WITH {SIG}, {nn_sql(25, 20, 200)} SELECT file_id, epoch_us(ts) AS ts, nn, details <> 'OK' AS bad, details FROM nn")
def nn_intervals_reject(spark: SparkSession, sf: str) -> DataFrame:
    raw = samples(spark, sf).select("file_id", "ts", F.col("value").alias("nn"))
    return nn.reject_artifacts(raw, 25, 20, 200).select("file_id", us("ts"), "nn", "bad", "details")


@query(f"WITH {SIG}, p AS (SELECT file_id, ts, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY file_id ORDER BY ts))) / 1e6 * 1000 AS nn FROM sig WHERE label = 'click') SELECT file_id, epoch_us(ts) AS ts, round(nn, 3) AS nn FROM p WHERE nn IS NOT NULL")
def nn_from_peaks(spark: SparkSession, sf: str) -> DataFrame:
    got = nn.intervals_from_peaks(samples(spark, sf).where("label = 'click'"))
    return got.select("file_id", us("ts"), rounded("nn", 3).alias("nn"))


@query(f"WITH {SIG}, {nn_sql(25, 20, 200)} SELECT file_id, details, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY file_id), 6) AS percentage FROM nn GROUP BY file_id, details")
def nn_rejection_summary(spark: SparkSession, sf: str) -> DataFrame:
    raw = samples(spark, sf).select("file_id", "ts", F.col("value").alias("nn"))
    return r6(nn.rejection_summary(nn.reject_artifacts(raw, 25, 20, 200)), "percentage")


@query(_TIME + " SELECT file_id, reference, " + ", ".join(f'round("{c}", 6) AS "{c}"' for c in HRV) + " FROM wide")
def hrv_time_features(spark: SparkSession, sf: str) -> DataFrame:
    return r6(hrv.time_features(nn_table(spark, sf), sequences(spark, sf)), *HRV)


@query(f"""{_GOOD}, j AS (SELECT q.file_id, q.id AS reference, n.nn, min(n.nn) OVER w AS lo, max(n.nn) OVER w AS hi FROM seq q JOIN good n ON n.file_id = q.file_id AND n.ts BETWEEN q.b AND q.e WINDOW w AS (PARTITION BY q.file_id, q.id)),
    b AS (SELECT file_id, reference, least(floor((nn - lo) / 7.8125) + 1, ceil((hi - lo) / 7.8125)) AS bin, count(*) AS c FROM j GROUP BY ALL), p AS (SELECT *, c / sum(c) OVER (PARTITION BY file_id, reference) AS p FROM b)
    SELECT file_id, reference, round(sum(c) / nullif(max(bin), 0), 6) AS "HTI", round(-sum(p * log2(p)), 6) + 0.0 AS "Shannon_h" FROM p GROUP BY file_id, reference""")
def hrv_geometric_features(spark: SparkSession, sf: str) -> DataFrame:
    return r6(hrv.geometric_features(nn_table(spark, sf), sequences(spark, sf)), "HTI", "Shannon_h")


def _beat_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return nn.reject_artifacts(beats(spark, sf))


#: Monotone cubics through pts(file_id, x, y): slopes m at the points, then values by the two ends of an interval.
_END = "CASE WHEN {s} * {d} <= 0 THEN 0 WHEN {d} * {d1} < 0 AND abs({s}) > 3 * abs({d}) THEN 3 * {d} ELSE {s} END"
_FIRST = _END.format(s="(((2 * h + h1) * d - h * d1) / (h + h1))", d="d", d1="d1")
_LAST = _END.format(s="(((2 * hp + hpp) * dp - hp * dpp) / (hp + hpp))", d="dp", d1="dpp")
_CUBIC = f"""st AS (SELECT *, lead(x) OVER w - x AS h, (lead(y) OVER w - y) / (lead(x) OVER w - x) AS d, count(*) OVER (PARTITION BY file_id) AS n FROM pts WINDOW w AS (PARTITION BY file_id ORDER BY x)),
    sl AS (SELECT *, lag(h) OVER w AS hp, lag(d) OVER w AS dp, lag(h, 2) OVER w AS hpp, lag(d, 2) OVER w AS dpp, lead(h) OVER w AS h1, lead(d) OVER w AS d1 FROM st WINDOW w AS (PARTITION BY file_id ORDER BY x)),
    sm AS (SELECT *, CASE WHEN n = 2 THEN coalesce(d, dp) WHEN dp IS NULL THEN {_FIRST} WHEN d IS NULL THEN {_LAST} WHEN dp * d > 0 THEN (3 * h + 3 * hp) / ((2 * h + hp) / dp + (h + 2 * hp) / d) ELSE 0 END AS m FROM sl),
    sp AS (SELECT file_id, x, y, h, m, lead(y) OVER w AS y1, lead(m) OVER w AS m1, lead(x) OVER w AS x1, lead(x, 2) OVER w IS NULL AS ends FROM sm WINDOW w AS (PARTITION BY file_id ORDER BY x))"""
_VALUE = "(1 + 2 * t) * (1 - t) ** 2 * y + t * (1 - t) ** 2 * h * m + t ** 2 * (3 - 2 * t) * y1 + t ** 2 * (t - 1) * h * m1"
_HOUR = 3_600_000_000
_GOOD_BEATS = f"{BEATS}, jumps AS (SELECT *, ln(nn) - ln(lag(nn) OVER (PARTITION BY file_id ORDER BY t)) AS jump FROM beats), good AS (SELECT file_id, t, nn FROM jumps WHERE NOT coalesce(jump < ln(0.75) OR jump > ln(1.25), FALSE) AND nn BETWEEN 600 AND 1300)"


def _band_sql(name: str, lo: float, hi: float, seconds: int, fs: int = 4) -> str:
    """band(file_id, reference, value): mean over epochs (one each second) of a Hann periodogram's power in a band, by inner products."""
    n = seconds * fs
    freq = np.fft.rfftfreq(n, 1 / fs)
    inside = np.flatnonzero((freq >= lo) & (freq < hi))
    weights = spectral.simpson(np.eye(len(inside)), freq[1] - freq[0]) * 2 / (fs * 3 * n / 8)
    bins = ", ".join(f"({k}, {w!r}::DOUBLE)" for k, w in zip(inside.tolist(), weights.tolist(), strict=True))
    hann = f"(0.5 - 0.5 * cos(2 * pi() * j / {n}))"
    wave = lambda f: f"list_transform(range(0, {n}), lambda j: {hann} * {f}(2 * pi() * k * j / {n}))"
    part = lambda c: f"(list_inner_product(x, {c}) - mean * list_sum({c})) ** 2"
    return f"""t_{name} AS (SELECT k, w, {wave("cos")} AS c, {wave("sin")} AS s FROM (VALUES {bins}) AS v(k, w)),
    e_{name} AS (SELECT file_id, reference, e, l[{fs} * e + 1:{fs} * e + {n}] AS x, list_avg(l[{fs} * e + 1:{fs} * e + {n}]) AS mean FROM lists, unnest(generate_series(0, (n - {n}) // {fs})) AS u(e) WHERE n >= {n}),
    {name} AS (SELECT file_id, reference, sum(w * ({part("c")} + {part("s")})) / count(DISTINCT e) AS value FROM e_{name}, t_{name} GROUP BY file_id, reference)"""


@query(f"""WITH {_GOOD_BEATS}, pts AS (SELECT file_id, t AS x, nn AS y FROM good), {_CUBIC}, o AS (SELECT file_id, min(x) AS t0 FROM pts GROUP BY file_id),
    g AS (SELECT sp.*, t0 + k * 250000 AS ts, (t0 + k * 250000 - x)::DOUBLE / h AS t FROM sp JOIN o USING (file_id), unnest(generate_series(CAST((x - t0 + 249999) // 250000 AS BIGINT), CAST(CASE WHEN ends THEN (x1 - t0) // 250000 ELSE (x1 - t0 + 249999) // 250000 - 1 END AS BIGINT))) AS u(k) WHERE x1 IS NOT NULL),
    nni AS (SELECT file_id, ts, {_VALUE} AS v FROM g), lists AS (SELECT q.file_id, q.id AS reference, list(v ORDER BY ts) AS l, count(*) AS n FROM bseq q JOIN nni ON nni.file_id = q.file_id AND ts BETWEEN q.b AND q.e GROUP BY ALL),
    {", ".join(_band_sql(name, *limits) for name, limits in hrv.HRV_BANDS.items())}
    SELECT q.file_id, q.id AS reference, {", ".join(f'round("{b}".value, 4) AS "{b}"' for b in hrv.HRV_BANDS)}, round("LF".value / "HF".value, 6) AS "LFHF" FROM bseq q {" ".join(f'LEFT JOIN "{b}" ON "{b}".file_id = q.file_id AND "{b}".reference = q.id' for b in hrv.HRV_BANDS)}""")
def hrv_frequency_features(spark: SparkSession, sf: str) -> DataFrame:
    """The good intervals on a grid of 4 Hz; recordings last long enough for the longest epochs."""
    nni = signal.interpolate_nn(_beat_intervals(spark, sf), 4.0)
    got = hrv.frequency_features(nni, beat_sequences(spark, sf), 4.0)
    return r6(got.withColumns({b: rounded(b, 4) for b in hrv.HRV_BANDS}), "LFHF")


_DFA = [f"""SELECT q.file_id, q.reference, '{name}' AS feature, regr_slope(ln(f), ln(n)) AS value FROM (SELECT file_id, reference, n, sqrt(sum(ss) / (count(*) * n)) AS f FROM
    (SELECT file_id, reference, w.n AS n, i // w.n AS seg, greatest(regr_syy(y, i % w.n) - regr_sxy(y, i % w.n) ** 2 / regr_sxx(y, i % w.n), 0) AS ss FROM prof, (SELECT unnest(range({lo}, {hi})) AS n) w WHERE total >= {least} AND i < total // w.n * w.n GROUP BY file_id, reference, w.n, i // w.n) GROUP BY file_id, reference, n) q WHERE f > 0 GROUP BY file_id, reference HAVING count(*) > 1""" for name, lo, hi, least in (("DFA1", 3, 16, 16), ("DFA2", 16, 64, 64))]


@query(f"""WITH {_GOOD_BEATS},
    inside AS (SELECT q.file_id, q.id AS reference, g.t, g.nn, avg(g.nn) OVER (PARTITION BY q.file_id, q.id) AS mean, count(*) OVER (PARTITION BY q.file_id, q.id) AS total FROM bseq q JOIN good g ON g.file_id = q.file_id AND g.t BETWEEN q.b AND q.e),
    prof AS (SELECT file_id, reference, total, row_number() OVER w - 1 AS i, sum(nn - mean) OVER w AS y FROM inside WINDOW w AS (PARTITION BY file_id, reference ORDER BY t)),
    f AS ({_DFA[0]} UNION ALL {_DFA[1]})
    SELECT q.file_id, q.id AS reference, round(max(value) FILTER (feature = 'DFA1'), 6) AS "DFA1", round(max(value) FILTER (feature = 'DFA2'), 6) AS "DFA2" FROM bseq q LEFT JOIN f ON f.file_id = q.file_id AND f.reference = q.id GROUP BY ALL""")
def hrv_nonlinear_features(spark: SparkSession, sf: str) -> DataFrame:
    return r6(hrv.nonlinear_features(_beat_intervals(spark, sf), beat_sequences(spark, sf)), "DFA1", "DFA2")


@query(f"""WITH {SIG}, {nn_sql()}, pts AS (SELECT file_id, epoch_us(ts) AS x, nn AS y, min(epoch_us(ts)) OVER (PARTITION BY file_id) AS t0 FROM nn WHERE details = 'OK'), {_CUBIC},
    o AS (SELECT file_id, min(x) AS t0 FROM pts GROUP BY file_id),
    g AS (SELECT sp.*, t0 + k * {_HOUR} AS ts, (t0 + k * {_HOUR} - x)::DOUBLE / h AS t FROM sp JOIN o USING (file_id), unnest(generate_series(CAST((x - t0 + {_HOUR - 1}) // {_HOUR} AS BIGINT), CAST(CASE WHEN ends THEN (x1 - t0) // {_HOUR} ELSE (x1 - t0 + {_HOUR - 1}) // {_HOUR} - 1 END AS BIGINT))) AS u(k) WHERE x1 IS NOT NULL)
    SELECT file_id, ts, round({_VALUE}, 4) + 0.0 AS nni FROM g""")
def nn_interpolation(spark: SparkSession, sf: str) -> DataFrame:
    got = signal.interpolate_nn(nn_table(spark, sf), 1 / 3600)
    return got.select("file_id", us("ts"), rounded("nni", 4).alias("nni"))


@query(f"""WITH {SIG}, d AS (SELECT file_id, ts, greatest(value - coalesce(lag(value) OVER w, 0), 0) AS d, row_number() OVER w AS n FROM sig WINDOW w AS (PARTITION BY file_id ORDER BY ts))
    SELECT file_id, epoch_us(ts) AS ts, round(CASE WHEN n >= 4 THEN sum(d) OVER (PARTITION BY file_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) END, 6) AS ssf FROM d""")
def ssf_transform(spark: SparkSession, sf: str) -> DataFrame:
    return r6(signal.slope_sum(samples(spark, sf).select("file_id", "ts", "value"), "value", 4).select("file_id", us("ts"), "ssf"), "ssf")


#: Samples in steps of 40, so that many extrema are plateaus: islands of equal values, each at its first row.
_NEAR = """steps AS (SELECT file_id, ts, floor(value / 40) * 40 AS value FROM sig), flags AS (SELECT *, CASE WHEN value = lag(value) OVER w THEN 0 ELSE 1 END AS starts FROM steps WINDOW w AS (PARTITION BY file_id ORDER BY ts)),
    islands AS (SELECT file_id, ts, value, sum(starts) OVER (PARTITION BY file_id ORDER BY ts) AS island FROM flags), firsts AS (SELECT file_id, island, min(ts) AS ts, any_value(value) AS value FROM islands GROUP BY file_id, island),
    near AS (SELECT file_id, ts, value, lag(value) OVER w AS a, lead(value) OVER w AS b FROM firsts WINDOW w AS (PARTITION BY file_id ORDER BY ts))"""
#: Local maxima of a table x(file_id, ts, v): equal samples in a row are one plateau, from position p to q of n.
_TOPS = """nx AS (SELECT *, row_number() OVER w AS p, lag(v) OVER w AS a, count(*) OVER (PARTITION BY file_id) AS n FROM x WINDOW w AS (PARTITION BY file_id ORDER BY ts)),
    runs AS (SELECT *, lead(p) OVER w - 1 AS q, lead(v) OVER w AS b FROM nx WHERE a IS NULL OR v <> a WINDOW w AS (PARTITION BY file_id ORDER BY ts)), tops AS (SELECT * FROM runs WHERE v > a AND v > b)"""
#: Values in steps of 50, so that plateaus occur.
_STEPPED = f"WITH {SIG}, x AS (SELECT file_id, ts, floor(value / 50) * 50 AS v FROM sig), {_TOPS}"


def _stepped(spark: SparkSession, sf: str) -> DataFrame:
    return samples(spark, sf).select("file_id", "ts", (F.floor(F.col("value") / 50) * 50).cast("double").alias("value"))


@query(_STEPPED + " SELECT file_id, epoch_us(ts) AS ts, v AS value, p AS position, q - p + 1 AS plateau_size FROM tops")
def local_peaks(spark: SparkSession, sf: str) -> DataFrame:
    return signal.local_maxima(_stepped(spark, sf), "value").select("file_id", us("ts"), "value", F.col("position").cast("long").alias("position"), "plateau_size")


@query(_STEPPED + """, mid AS (SELECT file_id, (p + q) // 2 AS position, n FROM tops), e AS (SELECT m.file_id, m.position, sum(s.v) AS total, arg_min(s.v, s.p) AS opens, arg_max(s.v, s.p) AS closes, any_value(c.ts) AS ts
      FROM mid m JOIN nx c ON c.file_id = m.file_id AND c.p = m.position JOIN nx s ON s.file_id = m.file_id AND s.p BETWEEN m.position - 3 AND m.position + 2 WHERE m.position > 3 AND m.position + 3 <= m.n GROUP BY ALL)
    SELECT file_id, epoch_us(ts) AS ts, position, total, opens, closes FROM e""")
def peak_windows(spark: SparkSession, sf: str) -> DataFrame:
    w = signal.peak_windows(_stepped(spark, sf), "value", 6)
    return w.select("file_id", us("ts"), F.col("position").cast("long").alias("position"), F.aggregate("window", F.lit(0.0), lambda a, x: a + x).alias("total"), F.col("window")[0].alias("opens"), F.element_at("window", -1).alias("closes"))


def _bases(half: int | None = None) -> str:
    """All peaks: the lowest samples on both sides up to a higher one (or so many samples away), by a join of each peak with its file."""
    lo, hi = ("coalesce(lo, 0)", "coalesce(hi, 1e9)") if half is None else (f"greatest(coalesce(lo, 0), m - {half + 1})", f"least(coalesce(hi, 1e9), m + {half + 1})")
    return f"""side0 AS (SELECT t.file_id, (t.p + t.q) // 2 AS m, t.p, t.q, t.v, max(s.p) FILTER (s.p < t.p AND s.v > t.v) AS lo, min(s.p) FILTER (s.p > t.q AND s.v > t.v) AS hi FROM tops t JOIN nx s ON s.file_id = t.file_id GROUP BY ALL),
    side AS (SELECT file_id, m, p, q, v, {lo} AS lo, {hi} AS hi FROM side0),
    based AS (SELECT d.file_id, d.m, d.p, d.q, d.v, max(s.p) FILTER (s.p < d.p AND s.v = lo_v) AS left_base, min(s.p) FILTER (s.p > d.q AND s.v = hi_v) AS right_base, any_value(lo_v) AS lo_v, any_value(hi_v) AS hi_v
      FROM (SELECT d.*, min(s.v) FILTER (s.p < d.p AND s.p > lo) OVER k AS lo_v, min(s.v) FILTER (s.p > d.q AND s.p < hi) OVER k AS hi_v, s.p AS sp FROM side d JOIN nx s ON s.file_id = d.file_id WINDOW k AS (PARTITION BY d.file_id, d.m)) d
      JOIN nx s ON s.file_id = d.file_id AND s.p = d.sp AND s.p > lo AND s.p < hi GROUP BY ALL),
    lvl AS (SELECT *, v - greatest(lo_v, hi_v) AS prom, v - (v - greatest(lo_v, hi_v)) / 2 AS level FROM based),
    feet AS (SELECT l.*, max(s.p) FILTER (s.p < l.m AND s.p >= left_base AND s.v <= level) AS i, min(s.p) FILTER (s.p > l.m AND s.p <= right_base AND s.v <= level) AS j FROM lvl l JOIN nx s ON s.file_id = l.file_id GROUP BY ALL),
    ends AS (SELECT e.*, c.ts, e.i + (level - a.v) / (a1.v - a.v) AS x0, e.j - (level - b.v) / (b1.v - b.v) AS x1, base.v AS base_v FROM feet e JOIN nx c ON c.file_id = e.file_id AND c.p = e.m JOIN nx base ON base.file_id = e.file_id AND base.p = e.left_base
      JOIN nx a ON a.file_id = e.file_id AND a.p = e.i JOIN nx a1 ON a1.file_id = e.file_id AND a1.p = e.i + 1 JOIN nx b ON b.file_id = e.file_id AND b.p = e.j JOIN nx b1 ON b1.file_id = e.file_id AND b1.p = e.j - 1)"""


@query(_STEPPED + f", {_bases()} SELECT b.file_id, epoch_us(c.ts) AS ts, m - 1 AS peak_sample, b.v AS height, b.q - b.p + 1 AS plateau_size, left_base - 1 AS left_base, right_base - 1 AS right_base, b.v - greatest(lo_v, hi_v) AS prominence FROM based b JOIN nx c ON c.file_id = b.file_id AND c.p = b.m")
def peak_properties(spark: SparkSession, sf: str) -> DataFrame:
    return signal.peak_properties(_stepped(spark, sf), "value").select("file_id", us("ts"), "peak_sample", "height", "plateau_size", "left_base", "right_base", "prominence")


_SSF = """d AS (SELECT file_id, ts, greatest(value - coalesce(lag(value) OVER w, 0), 0) AS d, row_number() OVER w AS n FROM sig WINDOW w AS (PARTITION BY file_id ORDER BY ts)),
    x AS (SELECT file_id, ts, coalesce(CASE WHEN n >= 4 THEN sum(d) OVER (PARTITION BY file_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) END, 0) AS v FROM d)"""


@query(f"""WITH RECURSIVE {SIG}, {_SSF}, {_TOPS}, {_bases()},
    ranked AS (SELECT file_id, m, p, v, row_number() OVER (PARTITION BY file_id ORDER BY v DESC, m DESC) AS k FROM based),
    apart AS (
      SELECT DISTINCT file_id, 0::BIGINT AS k, []::BIGINT[] AS stay FROM ranked
      UNION ALL
      SELECT a.file_id, c.k, CASE WHEN len(list_filter(a.stay, lambda z: abs(z - c.m) < 3)) = 0 THEN list_append(a.stay, c.m) ELSE a.stay END FROM apart a JOIN ranked c ON c.file_id = a.file_id AND c.k = a.k + 1),
    stays AS (SELECT file_id, unnest(stay) AS m FROM (SELECT file_id, arg_max(stay, k) AS stay FROM apart GROUP BY file_id)),
    high AS (SELECT b.file_id, c.ts, b.v FROM based b JOIN stays USING (file_id, m) JOIN nx c ON c.file_id = b.file_id AND c.p = b.p WHERE b.v - greatest(lo_v, hi_v) >= 0.01),
    opens AS (SELECT file_id, min(ts) + INTERVAL 86400 SECOND AS until FROM sig GROUP BY file_id),
    cand AS (SELECT file_id, ts, v, row_number() OVER (PARTITION BY file_id ORDER BY ts) AS k, until FROM high JOIN opens USING (file_id)),
    base AS (SELECT file_id, coalesce(0.5 * max(v) FILTER (ts <= until), 0) AS thr, coalesce(max(k) FILTER (ts <= until), 0) AS k FROM cand GROUP BY file_id),
    early AS (SELECT c.file_id, c.k, c.ts, c.v, b.thr FROM cand c JOIN base b USING (file_id) WHERE ts <= until AND v > b.thr),
    mems AS (SELECT file_id, list(v ORDER BY k)[-5:] AS mem FROM early GROUP BY file_id),
    r AS (
      SELECT b.file_id, b.k, coalesce(mem, []::DOUBLE[]) AS mem, b.thr, FALSE AS kept, NULL::TIMESTAMP AS ts, NULL::DOUBLE AS v FROM base b LEFT JOIN mems USING (file_id)
      UNION ALL
      SELECT r.file_id, c.k, CASE WHEN c.v > r.thr THEN list_append(r.mem, c.v)[-5:] ELSE r.mem END, CASE WHEN c.v > r.thr THEN 0.5 * list_aggregate(list_append(r.mem, c.v)[-5:], 'median') ELSE r.thr END, c.v > r.thr, c.ts, c.v FROM r JOIN cand c ON c.file_id = r.file_id AND c.k = r.k + 1)
    SELECT file_id, epoch_us(ts) AS ts, round(v, 6) AS value, round(thr, 6) AS threshold FROM r WHERE kept UNION ALL SELECT file_id, epoch_us(ts), round(v, 6), round(thr, 6) FROM early""")
def ssf_peaks(spark: SparkSession, sf: str) -> DataFrame:
    """Peaks of the slope sum by distance and prominence, then by the moving threshold of the whole recording."""
    ssf = signal.slope_sum(samples(spark, sf).select("file_id", "ts", "value"), "value", 4)
    got = signal.adaptive_peaks(signal.slope_sum_peaks(ssf, "ssf", 3600.0), "value", 0.5, 86400.0, start=F.col("start"))
    return r6(got.select("file_id", us("ts"), "value", "threshold"), "value", "threshold")


@query(f"""WITH RECURSIVE {SIG}, {_SSF}, {_TOPS},
    cand AS (SELECT file_id, ts, v, row_number() OVER w AS k, min(ts) OVER (PARTITION BY file_id) + INTERVAL 86400 SECOND AS until FROM tops WINDOW w AS (PARTITION BY file_id ORDER BY ts)),
    base AS (SELECT file_id, 0.5 * max(v) AS thr, max(k) AS k FROM cand WHERE ts <= until GROUP BY file_id),
    early AS (SELECT c.file_id, c.k, c.ts, c.v, b.thr FROM cand c JOIN base b USING (file_id) WHERE ts <= until AND v > b.thr),
    r AS (
      SELECT b.file_id, b.k, (SELECT list(e.v ORDER BY e.k)[-5:] FROM early e WHERE e.file_id = b.file_id) AS mem, b.thr, FALSE AS kept, NULL::TIMESTAMP AS ts, NULL::DOUBLE AS v FROM base b
      UNION ALL
      SELECT r.file_id, c.k, CASE WHEN c.v > r.thr THEN list_append(r.mem, c.v)[-5:] ELSE r.mem END, CASE WHEN c.v > r.thr THEN 0.5 * list_aggregate(list_append(r.mem, c.v)[-5:], 'median') ELSE r.thr END, c.v > r.thr, c.ts, c.v FROM r JOIN cand c ON c.file_id = r.file_id AND c.k = r.k + 1)
    SELECT file_id, epoch_us(ts) AS ts, round(v, 6) AS value, round(thr, 6) AS threshold FROM r WHERE kept UNION ALL SELECT file_id, epoch_us(ts), round(v, 6), round(thr, 6) FROM early""")
def adaptive_peaks(spark: SparkSession, sf: str) -> DataFrame:
    ssf = signal.slope_sum(samples(spark, sf).select("file_id", "ts", "value"), "value", 4)
    return r6(signal.adaptive_peaks(signal.local_maxima(ssf, "ssf"), "ssf", 0.5, 86400.0).select("file_id", us("ts"), "value", "threshold"), "value", "threshold")


@query(f"WITH {SIG}, z AS (SELECT file_id, ts, abs((value - avg(value) OVER w) / stddev_samp(value) OVER w) AS z FROM sig WINDOW w AS (PARTITION BY file_id)) SELECT file_id, epoch_us(ts) AS ts, z > 1.5 AS outlier FROM z")
def zscore_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return samples(spark, sf).select("file_id", us("ts"), signal.zscore_outlier("value", 1.5).alias("outlier"))


_SCALED = {
    "standard": "(value - avg(value) OVER w) / stddev_pop(value) OVER w",
    "robust": "(value - quantile_cont(value, 0.5) OVER w) / (quantile_cont(value, 0.75) OVER w - quantile_cont(value, 0.25) OVER w)",
    "minmax": "(value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w)",
    "range90": "value / (quantile_cont(value, 0.95) OVER w - quantile_cont(value, 0.05) OVER w)",
}


def _scale(method: str) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return r6(samples(spark, sf).select("file_id", us("ts"), signal.scaled("value", method).alias("scaled")), "scaled")

    run.__name__ = f"scale_{method}"
    query(f"WITH {SIG} SELECT file_id, epoch_us(ts) AS ts, round({_SCALED[method]}, 6) + 0.0 AS scaled FROM sig WINDOW w AS (PARTITION BY file_id)")(run)


for _m in _SCALED:
    _scale(_m)


@query(f"WITH {SIG}, n AS (SELECT file_id, ts, value, row_number() OVER (PARTITION BY file_id ORDER BY ts) - 1 AS n FROM sig) SELECT file_id, epoch_us(ts) AS ts, value FROM n WHERE n % 2 = 0")
def downsample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return signal.downsample(samples(spark, sf).select("file_id", "ts", "value"), 512, 256).select("file_id", us("ts"), "value")


_STEP = 7_200_000_000
_RESAMPLE = f"""WITH {SIG}, s AS (SELECT file_id, epoch_us(ts) AS t, value AS v, lead(epoch_us(ts)) OVER w AS t1, lead(value) OVER w AS v1, min(epoch_us(ts)) OVER (PARTITION BY file_id) AS t0 FROM sig WINDOW w AS (PARTITION BY file_id ORDER BY ts)),
    g AS (SELECT file_id, t, v, t1, v1, t0 + k * {_STEP} AS ts FROM s, unnest(generate_series(CAST((t - t0 + {_STEP - 1}) // {_STEP} AS BIGINT), CAST(CASE WHEN t1 IS NULL THEN (t - t0) // {_STEP} ELSE (t1 - t0 + {_STEP - 1}) // {_STEP} - 1 END AS BIGINT))) AS u(k))"""


@query(_RESAMPLE + " SELECT file_id, ts, round(coalesce(v + (v1 - v) * ((ts - t)::DOUBLE / (t1 - t)::DOUBLE), v), 6) AS value FROM g")
def uniform_resample_linear(spark: SparkSession, sf: str) -> DataFrame:
    return r6(signal.resample(samples(spark, sf), "value", 1e6 / _STEP, "linear").select("file_id", us("ts"), "value"), "value")


@query(_RESAMPLE + " SELECT file_id, ts, v AS value FROM g")
def uniform_resample_hold(spark: SparkSession, sf: str) -> DataFrame:
    return signal.resample(samples(spark, sf), "value", 1e6 / _STEP, "zero").select("file_id", us("ts"), "value")


@query(f"""WITH {SIG}, d AS (SELECT file_id, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY file_id ORDER BY ts)) / 1e6 AS dt FROM sig), m AS (SELECT file_id, quantile_cont(dt, 0.5) AS m, max(dt) AS hi, min(dt) AS lo, count(*) AS samples FROM d GROUP BY file_id)
    SELECT file_id, round(1.0 / m, 9) AS rate, coalesce(hi - m <= m AND m - lo <= m, TRUE) AS uniform, samples FROM m""")
def rate_estimate(spark: SparkSession, sf: str) -> DataFrame:
    return signal.estimate_rate(samples(spark, sf)).withColumn("rate", rounded("rate", 9))


_RAW = "raw AS (SELECT file_id, ts, CASE WHEN CAST(json_extract_string(data, '$.k') AS INT) % 10 = 0 THEN NULL WHEN CAST(json_extract_string(data, '$.k') AS INT) % 10 = 1 THEN 0.0 ELSE value * 5 - 100 END AS x FROM sig)"


def _gsr_raw(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("data", "$.k").cast("int") % 10
    return samples(spark, sf).select("file_id", "ts", F.when(k == 0, F.lit(None).cast("double")).when(k == 1, F.lit(0.0)).otherwise(F.col("value") * 5 - 100).alias("x"))


@query(f"""WITH {SIG}, {_RAW}, n AS (SELECT *, CASE WHEN x IS NULL THEN 'unknown' WHEN x = 0 OR x >= 2000 THEN 'saturated high' WHEN x < 0 THEN 'saturated low' ELSE '' END AS annotation FROM raw)
    SELECT file_id, epoch_us(ts) AS ts, round(CASE WHEN annotation = '' THEN 1000.0 / (2.0 * x + 1.0) END, 6) AS gsr, annotation FROM n""")
def gsr_convert_saturation(spark: SparkSession, sf: str) -> DataFrame:
    return r6(eda.convert_gsr(_gsr_raw(spark, sf), "x", 2.0, 1.0).select("file_id", us("ts"), "gsr", "annotation"), "gsr")


@query(f"""WITH {SIG}, {_RAW} SELECT file_id, epoch_us(ts) AS ts, x AS "PPG", CASE WHEN x IS NULL THEN 'unknown' ELSE '' END AS annotation FROM raw""")
def standardize_signal(spark: SparkSession, sf: str) -> DataFrame:
    return eda.standardize_channel(_gsr_raw(spark, sf), "x", "PPG").select("file_id", us("ts"), "PPG", "annotation")


@query(f"WITH {SIG}, {_RAW} SELECT file_id, count(*) AS samples, count(*) FILTER (x IS NULL) AS missing, round(count(*) FILTER (x IS NULL) / count(*), 6) AS missing_ratio FROM raw GROUP BY file_id")
def missing_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return r6(eda.missing_ratios(_gsr_raw(spark, sf), "x"), "missing_ratio")


_MASK = f"""WITH {SIG}, bounds AS (SELECT file_id, min(ts) - INTERVAL 30 SECOND AS o, max(ts) + INTERVAL 30 SECOND AS c FROM sig WHERE label = 'click' GROUP BY file_id),
    m AS (SELECT s.file_id, s.ts, CASE WHEN o IS NOT NULL AND (s.ts <= o OR s.ts >= c) THEN NULL ELSE value END AS value, CASE WHEN o IS NOT NULL AND (s.ts <= o OR s.ts >= c) THEN 'outside_session' WHEN label = 'error' THEN 'unknown' ELSE '' END AS annotation FROM sig s LEFT JOIN bounds USING (file_id))"""


def _masked(spark: SparkSession, sf: str) -> DataFrame:
    s = samples(spark, sf)
    noted = s.select("file_id", "ts", "value", F.when(F.col("label") == "error", "unknown").otherwise("").alias("annotation"))
    return eda.mask_outside(noted, s.where("label = 'click'"), "value")


@query(_MASK + " SELECT file_id, epoch_us(ts) AS ts, value, annotation FROM m")
def session_mask_warmup(spark: SparkSession, sf: str) -> DataFrame:
    return _masked(spark, sf).select("file_id", us("ts"), "value", "annotation")


@query(_MASK + " SELECT file_id, round(avg(CASE WHEN annotation <> '' THEN 1.0 ELSE 0.0 END), 6) AS ratio FROM m WHERE annotation <> 'outside_session' GROUP BY file_id")
def corrupted_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return r6(eda.corrupted_ratio(_masked(spark, sf)), "ratio")


_SLICE = "FROM seq q LEFT JOIN sig s ON s.file_id = q.file_id AND s.ts BETWEEN q.b AND q.e"
_SCL = ("SCLmean", "SCLmedian", "SCLsd", "SCLauc")


@query(f"""WITH {SIG}, {SEQ}, j AS (SELECT q.file_id, q.id AS reference, s.value AS y, epoch_us(s.ts) AS t, (epoch_us(s.ts) - epoch_us(lag(s.ts) OVER w)) / 1e6 * (s.value + lag(s.value) OVER w) / 2 AS area {_SLICE} WINDOW w AS (PARTITION BY q.file_id, q.id ORDER BY s.ts))
    SELECT file_id, reference, round(avg(y), 6) AS "SCLmean", round(quantile_cont(y, 0.5), 6) AS "SCLmedian", round(stddev_pop(y), 6) + 0.0 AS "SCLsd", round(sum(area) / nullif((max(t) - min(t)) / 60e6, 0), 4) AS "SCLauc" FROM j GROUP BY file_id, reference""")
def scl_features(spark: SparkSession, sf: str) -> DataFrame:
    got = eda.scl_features(samples(spark, sf).select("file_id", "ts", "value"), sequences(spark, sf), "value")
    return r6(got, *_SCL[:3]).withColumn("SCLauc", rounded("SCLauc", 4))


@query(f"""WITH {SIG}, {SEQ}, j AS (SELECT q.file_id, q.id AS reference, s.value AS y, (epoch_us(s.ts) - min(epoch_us(s.ts)) OVER (PARTITION BY q.file_id, q.id)) / 1e6 AS x FROM seq q JOIN sig s ON s.file_id = q.file_id AND s.ts BETWEEN q.b AND q.e)
    SELECT file_id, reference, round(regr_slope(y, x), 6) + 0.0 AS slope, round(regr_intercept(y, x), 4) AS intercept, round(CASE WHEN count(y) > 1 THEN corr(y, x) END, 6) + 0.0 AS r FROM j GROUP BY file_id, reference""")
def linear_trend_ols(spark: SparkSession, sf: str) -> DataFrame:
    got = eda.trend_ols(samples(spark, sf).select("file_id", "ts", "value"), sequences(spark, sf), "value")
    return r6(got, "slope", "r").withColumn("intercept", rounded("intercept", 4))


#: Reweighted lines: each round weighs the samples by their residuals, until the line rests or the scale is nil.
_HUBER = f"""WITH RECURSIVE {SIG}, {SEQ}, j AS (SELECT q.file_id, q.id AS reference, s.value::DOUBLE AS y, (epoch_us(s.ts) - min(epoch_us(s.ts)) OVER (PARTITION BY q.file_id, q.id)) / 1e6 AS x FROM seq q JOIN sig s ON s.file_id = q.file_id AND s.ts BETWEEN q.b AND q.e),
    sound AS (SELECT file_id, reference, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, corr(y, x) AS r, max(abs(y)) AS top FROM j GROUP BY ALL),
    it AS (SELECT file_id, reference, x, y, top, slope, intercept, 0 AS k, FALSE AS done FROM j JOIN sound USING (file_id, reference) WHERE slope IS NOT NULL
      UNION ALL
      SELECT file_id, reference, x, y, top, CASE WHEN nil THEN slope ELSE b END, CASE WHEN nil THEN intercept ELSE my - b * mx END, k + 1, nil OR greatest(abs(b - slope), abs(my - b * mx - intercept)) < 1e-6
      FROM (SELECT *, sum(wt * (x - mx) * (y - my)) OVER g / sum(wt * (x - mx) ** 2) OVER g AS b
        FROM (SELECT *, sum(wt * x) OVER g / sum(wt) OVER g AS mx, sum(wt * y) OVER g / sum(wt) OVER g AS my
          FROM (SELECT *, scale <= 1e-12 * top AS nil, CASE WHEN scale <= 1e-12 * top OR abs(rest) <= 1.345 * scale THEN 1.0 ELSE 1.345 * scale / abs(rest) END AS wt
            FROM (SELECT *, quantile_cont(abs(rest - mid), 0.5) OVER g / 0.6744897501960817 AS scale
              FROM (SELECT *, quantile_cont(rest, 0.5) OVER g AS mid FROM (SELECT *, y - slope * x - intercept AS rest FROM it WHERE NOT done AND k < 50) WINDOW g AS (PARTITION BY file_id, reference))
              WINDOW g AS (PARTITION BY file_id, reference)))
          WINDOW g AS (PARTITION BY file_id, reference))
        WINDOW g AS (PARTITION BY file_id, reference))),
    line AS (SELECT file_id, reference, arg_max(slope, k) AS slope, arg_max(intercept, k) AS intercept FROM it GROUP BY ALL)
    SELECT file_id, reference, round(line.slope, 9) + 0.0 AS slope, round(line.intercept, 4) AS intercept, round(r, 6) + 0.0 AS r FROM sound LEFT JOIN line USING (file_id, reference)"""


@query(_HUBER)
def linear_trend_robust(spark: SparkSession, sf: str) -> DataFrame:
    got = eda.trend_robust(samples(spark, sf).select("file_id", "ts", "value"), sequences(spark, sf), "value")
    return r6(got, "r").withColumns({"slope": rounded("slope", 9), "intercept": rounded("intercept", 4)})


def _peaks(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks as peaks: the value as amplitude, the gaps to both neighbours as durations."""
    w = Window.partitionBy("file_id").orderBy("ts")
    t = F.unix_micros(F.col("ts").cast("timestamp"))
    s = samples(spark, sf).withColumns({"rise": (t - F.lag(t).over(w)) / 1e6, "fall": (F.lead(t).over(w) - t) / 1e6})
    return s.where("label = 'click' and rise is not null and fall is not null").select("file_id", "ts", "value", F.col("value").alias("increase_amplitude"), F.col("rise").alias("increase_duration"), F.col("fall").alias("recovery_duration"))


@query(f"""WITH {SIG}, {SEQ}, p0 AS (SELECT file_id, ts, label, value, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS rise, (epoch_us(lead(ts) OVER w) - epoch_us(ts)) / 1e6 AS fall FROM sig WINDOW w AS (PARTITION BY file_id ORDER BY ts)),
    p AS (SELECT * FROM p0 WHERE label = 'click' AND rise IS NOT NULL AND fall IS NOT NULL),
    spans AS (SELECT q.file_id, q.id AS reference, count(s.value) AS n, (max(epoch_us(s.ts)) - min(epoch_us(s.ts))) / 60e6 AS minutes {_SLICE} GROUP BY q.file_id, q.id),
    means AS (SELECT q.file_id, q.id AS reference, avg(p.value) AS a, avg(rise) AS i, avg(fall) AS d, count(*) AS k FROM seq q JOIN p ON p.file_id = q.file_id AND p.ts BETWEEN q.b AND q.e GROUP BY q.file_id, q.id)
    SELECT file_id, reference, round(CASE WHEN n = 0 THEN NULL WHEN k IS NULL THEN 0 ELSE a END, 6) AS "SCRamplitude", round(CASE WHEN n = 0 THEN NULL WHEN k IS NULL THEN 0 ELSE i END, 3) AS "SCRincrease",
      round(CASE WHEN n = 0 THEN NULL WHEN k IS NULL THEN 0 ELSE d END, 3) AS "SCRdecrease", round(CASE WHEN n = 0 THEN NULL WHEN k IS NULL THEN 0 ELSE k / nullif(minutes, 0) END, 6) AS "SCRrate" FROM spans LEFT JOIN means USING (file_id, reference)""")
def scr_features(spark: SparkSession, sf: str) -> DataFrame:
    got = eda.scr_features(samples(spark, sf).select("file_id", "ts", "value"), _peaks(spark, sf), sequences(spark, sf), "value")
    return r6(got, "SCRamplitude", "SCRrate").withColumns({c: rounded(c, 3) for c in ("SCRincrease", "SCRdecrease")})


_CYC = f"""WITH {SIG}, {_NEAR}, x AS (SELECT file_id, epoch_us(ts) AS t, ts, value AS v, value > a AND value > b AS is_peak FROM near WHERE value > a AND value > b OR value < a AND value < b),
    y AS (SELECT *, lag(is_peak) OVER w AS pp, lead(is_peak) OVER w AS np, lag(t) OVER w AS pt, lead(t) OVER w AS nt, lag(v) OVER w AS pv FROM x WINDOW w AS (PARTITION BY file_id ORDER BY t)),
    cyc AS (SELECT file_id, ts, (t - pt) / 1e6 AS i_duration, (nt - t) / 1e6 AS e_duration, (nt - pt) / 1e6 AS ie_duration, v - pv AS amplitude, ((t - pt) / 1e6) / ((nt - t) / 1e6) AS ie_ratio FROM y WHERE is_peak AND NOT pp AND NOT np)"""
_CYCLE = ("i_duration", "e_duration", "ie_duration", "amplitude", "ie_ratio")


def _steps(spark: SparkSession, sf: str) -> DataFrame:
    return samples(spark, sf).withColumn("value", F.floor(F.col("value") / 40) * 40.0)


@query(_CYC + " SELECT file_id, epoch_us(ts) AS ts, " + ", ".join(f"round({c}, 6) AS {c}" for c in _CYCLE) + " FROM cyc")
def respiration_cycles(spark: SparkSession, sf: str) -> DataFrame:
    return r6(respiration.cycles(respiration.extrema(_steps(spark, sf), "value")).select("file_id", us("ts"), *_CYCLE), *_CYCLE)


_RESP = {"AMPmean": "avg(amplitude)", "AMPmax": "max(amplitude)", "AMPmin": "min(amplitude)", "AMPsd": "stddev_samp(amplitude)", "PERIODmean": "avg(ie_duration)", "PERIODsd": "stddev_samp(ie_duration)", "INSPImean": "avg(i_duration)", "EXPImean": "avg(e_duration)", "IEmean": "avg(ie_ratio)"}


@query(_CYC + f", {SEQ} SELECT q.file_id, q.id AS reference, " + ", ".join(f'round({v} + 1e-9, 4) AS "{k}"' for k, v in _RESP.items()) + " FROM seq q LEFT JOIN cyc c ON c.file_id = q.file_id AND c.ts BETWEEN q.b AND q.e GROUP BY q.file_id, q.id")
def respiration_features(spark: SparkSession, sf: str) -> DataFrame:
    got = respiration.features(respiration.cycles(respiration.extrema(_steps(spark, sf), "value")), sequences(spark, sf))
    return got.withColumns({c: rounded(F.col(c) + 1e-9, 4) for c in _RESP})


def _fir_sql(order: int, frequencies: list[float], kind: str = "lowpass", table: str = "sig") -> str:
    """fir(file_id, ts, value, y): the filter forward and backward over lists, with odd reflection at both ends."""
    taps = filters.fir_taps(order, 1.0, frequencies, kind).tolist()
    n = len(taps)
    once = "list_reverse(list_transform(range(1, len({0}) + 1), lambda i: list_inner_product((list_concat({1}, {0}))[i:i + {2}], {3})))"
    zeros, back = str([0.0] * (n - 1)), str(taps[::-1])
    return f"""l0 AS (SELECT file_id, list(value::DOUBLE ORDER BY ts) AS l, list(ts ORDER BY ts) AS stamps, count(*) AS n, least({3 * n}, count(*) - 1) AS pad FROM {table} GROUP BY file_id),
    l1 AS (SELECT *, list_concat(list_concat(list_transform(range(pad, 0, -1), lambda i: 2 * l[1] - l[i + 1]), l), list_transform(range(1, pad + 1), lambda i: 2 * l[n] - l[n - i])) AS wide FROM l0),
    l2 AS (SELECT *, {once.format("wide", zeros, n - 1, back)} AS z FROM l1), l3 AS (SELECT *, {once.format("z", zeros, n - 1, back)} AS z2 FROM l2),
    fir AS (SELECT file_id, unnest(stamps) AS ts, unnest(l) AS value, unnest(CASE WHEN n < 2 THEN l ELSE z2[pad + 1:pad + n] END) AS y FROM l3)"""


@query(f"WITH {SIG}, {_fir_sql(30, [0.1, 0.35], 'bandpass')} SELECT file_id, epoch_us(ts) AS ts, value, round(y, 6) + 0.0 AS value_filtered FROM fir")
def respiration_clean(spark: SparkSession, sf: str) -> DataFrame:
    s = samples(spark, sf).select("file_id", "ts", "value")
    return r6(respiration.clean(s, s, 1.0, "value").select("file_id", us("ts"), "value", "value_filtered"), "value_filtered")


@query(f"WITH {SIG}, {_fir_sql(10, [0.2])} SELECT file_id, epoch_us(ts) AS ts, value, round(y, 6) + 0.0 AS value_filtered FROM fir")
def fir_lowpass(spark: SparkSession, sf: str) -> DataFrame:
    return r6(signal.fir_filter(samples(spark, sf), "value", 1.0, 10, [0.2]).select("file_id", us("ts"), "value", "value_filtered"), "value_filtered")


@query(f"WITH {SIG}, {_fir_sql(10, [0.05, 0.4], 'bandpass')} SELECT file_id, epoch_us(ts) AS ts, round((y - quantile_cont(y, 0.5) OVER w) / (quantile_cont(y, 0.75) OVER w - quantile_cont(y, 0.25) OVER w), 6) + 0.0 AS clean FROM fir WINDOW w AS (PARTITION BY file_id)")
def ppg_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Band-pass and robust scaling of a pulse signal."""
    banded = signal.fir_filter(samples(spark, sf), "value", 1.0, 10, [0.05, 0.4], "bandpass")
    return r6(banded.select("file_id", us("ts"), signal.scaled("value_filtered", "robust").alias("clean")), "clean")


_PEAKS = f"WITH {SIG}, x AS (SELECT file_id, ts, value::DOUBLE AS v FROM sig), {_TOPS}"


@query(f"""{_PEAKS}, {_bases()}, span AS (SELECT file_id, max(v) - min(v) AS r FROM x GROUP BY file_id)
    SELECT file_id, epoch_us(ts) AS ts, v AS value, round(prom / r, 6) AS prominence FROM ends JOIN span USING (file_id) WHERE prom / r >= 0.4 AND x1 - x0 >= 1""")
def ppg_peaks(spark: SparkSession, sf: str) -> DataFrame:
    return r6(signal.prominent_peaks(samples(spark, sf), "value", 0.4, 1).select("file_id", us("ts"), "value", "prominence"), "prominence")


@query(f"""WITH {SIG}, {_RAW}, num AS (SELECT file_id, ts, x AS raw, (row_number() OVER (PARTITION BY file_id ORDER BY ts))::DOUBLE AS x FROM raw), pts AS (SELECT file_id, x, raw AS y FROM num WHERE raw IS NOT NULL), {_CUBIC},
    near AS (SELECT n.file_id, n.ts, n.raw, n.x AS at, s.x AS x0, s.y, s.h, s.m, s.y1, s.m1, (n.x - s.x) / s.h AS t FROM num n ASOF LEFT JOIN sp s ON s.file_id = n.file_id AND s.x <= n.x)
    SELECT file_id, epoch_us(ts) AS ts, raw AS x, round(coalesce(raw, {_VALUE}), 6) + 0.0 AS x_clean FROM near""")
def pchip_fill(spark: SparkSession, sf: str) -> DataFrame:
    return r6(signal.fill_gaps(_gsr_raw(spark, sf), "x").select("file_id", us("ts"), "x", "x_clean"), "x_clean")


@query(f"""WITH {SIG}, s AS (SELECT file_id, value AS v, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY file_id) AS n FROM sig WINDOW w AS (PARTITION BY file_id ORDER BY ts)),
    e AS (SELECT file_id, u.k AS epoch, i - 8 * u.k AS j, v, avg(v) OVER (PARTITION BY file_id, u.k) AS mean FROM s, unnest(generate_series(greatest((i - 8) // 8, 0), i // 8)) AS u(k) WHERE i - 8 * u.k BETWEEN 0 AND 15 AND 8 * u.k + 16 <= n),
    w AS (SELECT file_id, epoch, j, (v - mean) * (0.5 - 0.5 * cos(2 * pi() * j / 16)) AS y FROM e),
    p AS (SELECT file_id, epoch, f, (sum(y * cos(2 * pi() * f * j / 16)) ** 2 + sum(y * sin(2 * pi() * f * j / 16)) ** 2) / 6.0 * CASE WHEN f IN (0, 8) THEN 1 ELSE 2 END AS power FROM w, (SELECT unnest(range(0, 9)) AS f) GROUP BY file_id, epoch, f)
    SELECT file_id, epoch, round(sum(power * CASE f WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 1 ELSE 0 END) / 48, 4) + 0.0 AS value_low_abs, round(sum(power * CASE f WHEN 3 THEN 1 WHEN 4 THEN 4 WHEN 5 THEN 2 WHEN 6 THEN 4 WHEN 7 THEN 1 ELSE 0 END) / 48, 4) + 0.0 AS value_high_abs FROM p GROUP BY file_id, epoch""")
def bandpower(spark: SparkSession, sf: str) -> DataFrame:
    got = signal.band_power(samples(spark, sf), "value", 1.0, {"low": (None, 0.15), "high": (0.15, None)}, 16, 8)
    return got.withColumns({c: rounded(c, 4) for c in ("value_low_abs", "value_high_abs")})


_KNOWN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@query(f"""{_MASK}, {_RAW}, lost AS (SELECT file_id, ts, CASE WHEN file_id % 7 = 0 AND x > -100 THEN NULL ELSE x END AS x FROM raw),
    inside AS (SELECT file_id, ts, o IS NOT NULL AND (ts <= o OR ts >= c) AS beyond, 1000.0 / nullif(2 * x + 1, 0) AS gsr, CASE WHEN x IS NULL THEN 'unknown' ELSE '' END AS note FROM lost LEFT JOIN bounds USING (file_id)),
    held AS (SELECT file_id, ts, CASE WHEN NOT beyond THEN gsr END AS gsr, CASE WHEN beyond THEN 'outside_session' ELSE note END AS note FROM inside),
    states AS (SELECT file_id, CASE WHEN avg(CASE WHEN note <> '' THEN 1.0 ELSE 0.0 END) FILTER (note <> 'outside_session') > 0.6 THEN 'corrupted' ELSE 'ok' END AS status FROM held GROUP BY file_id),
    far AS (SELECT *, coalesce(abs((gsr - avg(gsr) OVER w) / nullif(stddev_samp(gsr) OVER w, 0)) > 5, FALSE) AS off FROM held WINDOW w AS (PARTITION BY file_id)),
    noted AS (SELECT file_id, ts, CASE WHEN NOT off THEN gsr END AS gsr, CASE WHEN off THEN 'outliers' ELSE note END AS annotation, (row_number() OVER (PARTITION BY file_id ORDER BY ts))::DOUBLE AS i FROM far),
    ends AS (SELECT *, last_value(gsr IGNORE NULLS) OVER a AS ya, max(CASE WHEN gsr IS NOT NULL THEN i END) OVER a AS ia, last_value(gsr IGNORE NULLS) OVER b AS yb, min(CASE WHEN gsr IS NOT NULL THEN i END) OVER b AS ib
      FROM noted WINDOW a AS (PARTITION BY file_id ORDER BY i {_KNOWN}), b AS (PARTITION BY file_id ORDER BY i DESC {_KNOWN})),
    bridged AS (SELECT file_id, ts, coalesce(gsr, ya + (yb - ya) * (i - ia) / (ib - ia), ya, yb) AS value FROM ends WHERE ya IS NOT NULL OR yb IS NOT NULL), {_fir_sql(10, [0.3], table="bridged")},
    num AS (SELECT n.file_id, n.ts, n.i AS x, CASE WHEN n.gsr IS NOT NULL THEN y END AS raw FROM noted n LEFT JOIN fir f ON f.file_id = n.file_id AND f.ts = n.ts), pts AS (SELECT file_id, x, raw AS y FROM num WHERE raw IS NOT NULL), {_CUBIC},
    near AS (SELECT n.file_id, n.ts, n.raw, s.y, s.h, s.m, s.y1, s.m1, (n.x - s.x) / s.h AS t FROM num n ASOF LEFT JOIN sp s ON s.file_id = n.file_id AND s.x <= n.x),
    full_ AS (SELECT file_id, ts, raw, coalesce(raw, {_VALUE}) AS clean FROM near),
    z AS (SELECT *, (clean - avg(clean) OVER w) / nullif(stddev_pop(clean) OVER w, 0) AS z FROM full_ WINDOW w AS (PARTITION BY file_id))
    SELECT n.file_id, epoch_us(n.ts) AS ts, round(gsr, 6) + 0.0 AS gsr, annotation, status, round(CASE WHEN status = 'ok' THEN raw END, 5) + 0.0 AS gsr_filtered, round(CASE WHEN status = 'ok' THEN clean END, 5) + 0.0 AS gsr_filtered_clean, round(CASE WHEN status = 'ok' THEN z END, 5) + 0.0 AS gsr_filtered_clean_zscored
    FROM noted n JOIN states USING (file_id) JOIN z ON z.file_id = n.file_id AND z.ts = n.ts""")
def gsr_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Every seventh file has lost most of its samples, and is told to be corrupted."""
    x = F.when((F.col("file_id") % 7 == 0) & (F.col("x") > -100), F.lit(None)).otherwise(F.col("x"))
    noted = _gsr_raw(spark, sf).select("file_id", "ts", gsr_from_raw(x, 2.0, 1.0).alias("gsr"), missing_annotation(x).alias("annotation"))
    got = r6(eda.clean(noted, samples(spark, sf).where("label = 'click'"), 1.0, order=10, cutoff=0.3), "gsr")
    return got.withColumns({c: rounded(c, 5) for c in ("gsr_filtered", "gsr_filtered_clean", "gsr_filtered_clean_zscored")}).withColumn("ts", us("ts"))


@query()
def cvx_split(spark: SparkSession, sf: str) -> DataFrame:
    """Tonic/phasic split with the event order as a 1 Hz clock, in overlapping epochs."""
    w = Window.partitionBy("file_id").orderBy("ts")
    clock = samples(spark, sf).select("file_id", F.timestamp_micros(F.row_number().over(w).cast("long") * 1_000_000).cast("timestamp_ntz").alias("ts"), "value")
    return eda.tonic_phasic(clock, "value", 1.0, 40, 20, 2, outlier=1e9).withColumn("ts", us("ts"))


@query(f"""{_PEAKS}, {_bases(20)}, span AS (SELECT file_id, quantile_cont(v, 0.95) - quantile_cont(v, 0.05) AS r FROM x GROUP BY file_id), f AS (SELECT *, m - left_base < 7 AS good FROM ends JOIN span USING (file_id) WHERE prom / r >= 0.1 AND x1 - x0 >= 0.5)
    SELECT file_id, epoch_us(ts) AS ts, CASE WHEN good THEN v END AS value, CASE WHEN good THEN m - left_base END::DOUBLE AS increase_duration, round(CASE WHEN good THEN v - base_v END, 6) AS increase_amplitude, round(CASE WHEN good THEN x1 - m END, 6) AS recovery_duration, CASE WHEN good THEN '' ELSE 'false_peak_detection' END AS annotation FROM f""")
def scr_peak_detection(spark: SparkSession, sf: str) -> DataFrame:
    got = eda.scr_peaks(samples(spark, sf).select("file_id", "ts", "value"), 1.0, "value", window=40).withColumn("ts", us("ts"))
    return r6(got, "increase_amplitude", "recovery_duration")


@query(f"""WITH {SIG}, s AS (SELECT file_id, value AS x, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY file_id)) / 1e6 AS a FROM sig),
    e AS (SELECT file_id, x, u.k AS epoch FROM s, unnest(generate_series(CAST(greatest(floor((a - 172800) / 86400) + 1, 0) AS BIGINT), CAST(floor(a / 86400) AS BIGINT))) AS u(k)) SELECT file_id, epoch, count(*) AS n, round(avg(x), 6) AS mean FROM e GROUP BY file_id, epoch""")
def epoch_mean_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return r6(eda.epoch_mean(samples(spark, sf), "value", 172800, 86400), "mean")


@query(f"WITH {SIG}, {SEQ} SELECT q.file_id, q.id AS reference, epoch_us(s.ts) AS ts, s.value FROM seq q JOIN sig s ON s.file_id = q.file_id AND s.ts BETWEEN q.b AND q.e")
def interval_join_slice(spark: SparkSession, sf: str) -> DataFrame:
    return slice_join(sequences(spark, sf), samples(spark, sf).select("file_id", "ts", "value"), "inner").select("file_id", "reference", us("ts"), "value")


@query(f"WITH {SIG}, {SEQ} SELECT q.file_id, q.id AS reference, epoch_us(s.ts) AS ts, s.value FROM seq q LEFT JOIN sig s ON s.file_id = q.file_id AND s.ts BETWEEN q.b AND q.e AND s.label = 'click'")
def interval_join_empty_sequences(spark: SparkSession, sf: str) -> DataFrame:
    clicks = samples(spark, sf).where("label = 'click'").select("file_id", "ts", "value")
    return slice_join(sequences(spark, sf), clicks, "left", bucket_seconds=86400.0).select("file_id", "reference", us("ts"), "value")


@query(f"WITH {SIG}, {SEQ} SELECT q.file_id, q.id AS reference, epoch_us(s.ts) AS ts, s.value FROM seq q LEFT JOIN sig s ON s.file_id = q.file_id AND s.ts BETWEEN q.b AND q.e AND s.label = 'error'")
def interval_join_measured(spark: SparkSession, sf: str) -> DataFrame:
    """Sequences from seconds to weeks, each in time buckets of its own length."""
    errors = samples(spark, sf).where("label = 'error'").select("file_id", "ts", "value")
    return slice_join(sequences(spark, sf), errors, "left", buckets="measured").select("file_id", "reference", us("ts"), "value")


_SHARES = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q99": 0.99}


@query(f"WITH {SIG}, {SEQ} SELECT q.file_id, q.id AS reference, count(s.value) AS n, " + ", ".join(f"round(quantile_cont(s.value, {p}), 6) + 0.0 AS {c}" for c, p in _SHARES.items()) + f" {_SLICE} GROUP BY q.file_id, q.id")
def sequence_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return r6(summarize.sequence_quantiles(samples(spark, sf), sequences(spark, sf), "value", _SHARES), *_SHARES)


@query(f"WITH {SIG} SELECT file_id, epoch_us(ts) AS ts, round({_SCALED['robust']}, 6) + 0.0 AS scaled FROM sig WINDOW w AS (PARTITION BY file_id)")
def scale_selected(spark: SparkSession, sf: str) -> DataFrame:
    return r6(signal.scale_selected(samples(spark, sf).select("file_id", "ts", "value"), "value", "robust", "scaled").select("file_id", us("ts"), "scaled"), "scaled")


_DEFINITIONS = {
    "sum": summarize.FeatureDefinition("numpy.sum", ["value"], divide_by_duration=True, empty_policy=0.0),
    "median": summarize.FeatureDefinition("numpy.nanmedian", ["value"], drop_bad_samples=True, empty_policy="bad"),
    "std": summarize.FeatureDefinition("numpy.std", ["value"]),
    "auc": summarize.FeatureDefinition(custom="auc", columns=["value"]),
}


@query(f"""WITH {SIG}, {SEQ}, j AS (SELECT q.file_id, q.id AS reference, q.b, q.e, s.value AS x, s.label = 'error' AS bad, (epoch_us(s.ts) - epoch_us(lag(s.ts) OVER w)) / 1e6 * (s.value + lag(s.value) OVER w) / 2 AS area FROM seq q LEFT JOIN sig s ON s.file_id = q.file_id AND s.ts BETWEEN q.b AND q.e WINDOW w AS (PARTITION BY q.file_id, q.id ORDER BY s.ts)),
    f AS (SELECT file_id, reference, coalesce(sum(x), 0) / nullif((epoch_us(first(e)) - epoch_us(first(b))) / 1e6, 0) AS value_sum, quantile_cont(x, 0.5) FILTER (NOT bad) AS value_median, stddev_pop(x) AS value_std, CASE WHEN count(x) > 1 THEN sum(area) END AS value_auc FROM j GROUP BY file_id, reference),
    l AS (SELECT file_id, reference, 'value_sum' AS id, value_sum AS value FROM f UNION ALL SELECT file_id, reference, 'value_median', value_median FROM f UNION ALL SELECT file_id, reference, 'value_std', value_std FROM f UNION ALL SELECT file_id, reference, 'value_auc', value_auc FROM f)
    SELECT file_id, reference, id, round(value, 4) + 0.0 AS value, CASE WHEN id = 'value_median' AND value IS NULL THEN 'bad' ELSE 'ok' END AS status FROM l WHERE value IS NOT NULL OR id = 'value_median'""")
def signal_to_feature(spark: SparkSession, sf: str) -> DataFrame:
    s = samples(spark, sf).select("file_id", "ts", "value", (F.col("label") == "error").alias("bad"))
    return summarize.summarize(s, sequences(spark, sf), _DEFINITIONS).withColumn("value", rounded("value", 4))


_LONG = _TIME + ", long AS (" + " UNION ALL ".join(f"""SELECT file_id, reference, '{c}' AS id, "{c}" AS value FROM wide""" for c in HRV) + ")"
_NAMES = ", ".join(f"('{c}', '{summarize.DICTIONARY[c][0]}', '{summarize.DICTIONARY[c][1]}')" for c in HRV)


@query(_LONG + f" SELECT file_id, reference, id, round(value, 6) AS value, name, units FROM long JOIN (VALUES {_NAMES}) d(id, name, units) USING (id)")
def features_long(spark: SparkSession, sf: str) -> DataFrame:
    wide = hrv.time_features(nn_table(spark, sf), sequences(spark, sf))
    return r6(summarize.describe_features(summarize.melt(wide, ["file_id", "reference"]), summarize.DICTIONARY), "value").select("file_id", "reference", "id", "value", "name", "units")


@query(_LONG + """ SELECT file_id, reference, round(max(value) FILTER (id = 'meanNN'), 6) AS "meanNN", round(max(value) FILTER (id = 'SDNN'), 6) AS "SDNN" FROM long GROUP BY file_id, reference""")
def features_wide(spark: SparkSession, sf: str) -> DataFrame:
    wide = hrv.time_features(nn_table(spark, sf), sequences(spark, sf))
    return r6(summarize.widen(summarize.melt(wide, ["file_id", "reference"]), ["file_id", "reference"], ["meanNN", "SDNN"]), "meanNN", "SDNN")


#: Rows of a block in the queries of blocks: fewer than the recordings have.
_BLOCK = 16


def _same_sql(name: str, f: Callable[[SparkSession, str], DataFrame]) -> None:
    """A query in blocks gives what the query over whole recordings gives, by the same SQL."""
    f.__name__ = f"{name}_blocks"
    query(ORACLES[name])(f)


_same_sql("uniform_resample_linear", lambda spark, sf: r6(signal.resample(samples(spark, sf), "value", 1e6 / _STEP, "linear", block_rows=_BLOCK).select("file_id", us("ts"), "value"), "value"))
_same_sql("ssf_transform", lambda spark, sf: r6(signal.slope_sum(samples(spark, sf).select("file_id", "ts", "value"), "value", 4, block_rows=_BLOCK).select("file_id", us("ts"), "ssf"), "ssf"))
_same_sql("fir_lowpass", lambda spark, sf: r6(signal.fir_filter(samples(spark, sf), "value", 1.0, 10, [0.2], block_rows=_BLOCK).select("file_id", us("ts"), "value", "value_filtered"), "value_filtered"))
_same_sql("pchip_fill", lambda spark, sf: r6(signal.fill_gaps(_gsr_raw(spark, sf), "x", block_rows=_BLOCK).select("file_id", us("ts"), "x", "x_clean"), "x_clean"))
