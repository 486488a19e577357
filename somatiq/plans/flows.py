"""Named flows: datasets, standardisation, features and summaries, over a folder of keyed tables.

Keys: /raw/events, /raw/signals (file_id, ts, device channels), /standard/events, /standard/signals,
/features/<family>; summaries are CSV under /population.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import missing_annotation
from ..operators import behavior, eda, events, forms, hrv, nn, respiration, signal, summarize, survey
from ..operators.blocks import ROWS
from ..operators.intervals import filter_sequences
from ..sources.readers import open_dataset, read_key, read_responses
from ..sources.sinks import write_population, write_responses
from .pipeline import Operator, SoftFailure, run_all

#: Device channels and their standard names.
CHANNELS = {"G": "PPG", "F": "GSR", "H": "PZT"}
RATE, GSR_RATE = 512, 256

Flow = Callable[..., object]
FLOWS: dict[str, Flow] = {}


def flow(f: Flow) -> Flow:
    FLOWS[f.__name__] = f
    return f


def _sequences(table: DataFrame) -> DataFrame:
    return table.where(F.col("end").isNotNull() & F.col("id").isin(events.known_sequence_ids())).select("file_id", "name", "id", "begin", "end")


def _points(table: DataFrame) -> DataFrame:
    """Standard events as labelled points in time."""
    return table.where(F.col("end").isNull()).select("file_id", F.col("begin").alias("ts"), F.col("name").alias("label"), "data")


def _long(wide: DataFrame, parts: list[DataFrame] | None = None) -> DataFrame:
    out = wide
    for p in parts or []:
        out = out.join(p, ["file_id", "reference"], "left")
    return summarize.melt(out, ["file_id", "reference"])


def standardize_events(raw: DataFrame) -> DataFrame:
    return events.standardize(raw, events.extract_sequences(raw, events.known_sequence_ids()))


def standardize_signals(raw: DataFrame, rate: float = RATE) -> DataFrame:
    """All known channels on one uniform grid, with annotations of missing samples."""
    out = None
    for device, name in CHANNELS.items():
        if device in raw.columns:
            one = signal.resample(raw, device, rate, "linear", name, ROWS)
            out = one if out is None else out.join(one, ["file_id", "ts"], "full_outer")
    if out is None:
        raise SoftFailure("no known channel")
    return out.withColumns({f"{n}_annotation": missing_annotation(F.col(n)) for n in CHANNELS.values() if n in out.columns})


def cardiac(signals: DataFrame, table: DataFrame, rate: float = RATE) -> DataFrame:
    if "PPG" not in signals.columns:
        raise SoftFailure("no PPG channel")
    banded = signal.fir_filter(signals, "PPG", rate, int(rate), [0.5, min(11.0, 0.45 * rate)], "bandpass", block_rows=ROWS)
    clean = banded.select("file_id", "ts", signal.scaled("PPG_filtered", "robust").alias("PPG"))
    ssf = signal.slope_sum(clean, "PPG", max(1, int(0.125 * rate)))
    peaks = signal.adaptive_peaks(signal.slope_sum_peaks(ssf, "ssf", rate), "value", 0.5, start=F.col("start"))
    intervals = nn.reject_artifacts(nn.intervals_from_peaks(peaks))
    nni = signal.interpolate_nn(intervals, 4.0)
    q = _sequences(table)
    return _long(hrv.time_features(intervals, q), [hrv.geometric_features(intervals, q), hrv.frequency_features(nni.withColumnRenamed("nni", "nni"), q, 4.0), hrv.nonlinear_features(intervals, q)])


def galvanic(signals: DataFrame, table: DataFrame, rate: float = RATE, target: float = GSR_RATE) -> DataFrame:
    if "GSR" not in signals.columns:
        raise SoftFailure("no GSR channel")
    told = signals.select("file_id", "ts", F.col("GSR").alias("gsr"), F.col("GSR_annotation").alias("annotation"))
    clean = eda.clean(told, _points(table), rate, block_rows=ROWS)
    slow = signal.downsample(clean.where("status = 'ok'").select("file_id", "ts", "gsr_filtered_clean_zscored"), rate, target)
    split = eda.tonic_phasic(slow, "gsr_filtered_clean_zscored", target)
    peaks = eda.scr_peaks(split, target)
    q = filter_sequences(_sequences(table), exclude=events.NOT_FOR_GSR)
    line = eda.trend_robust(split, q, "scl").select("file_id", "reference", F.col("slope").alias("SCLslope"), F.col("intercept").alias("SCLintercept"), F.col("r").alias("SCLr"))
    return _long(eda.scl_features(split, q), [eda.scr_features(split, peaks, q), line])


def breathing(signals: DataFrame, table: DataFrame, rate: float = RATE) -> DataFrame:
    if "PZT" not in signals.columns:
        raise SoftFailure("no PZT channel")
    clean = respiration.clean(signals, _points(table), rate, block_rows=ROWS)
    return _long(respiration.features(respiration.cycles(respiration.extrema(clean, "PZT_filtered")), _sequences(table)))


def game(table: DataFrame) -> DataFrame:
    return behavior.wave_features(_points(table), _sequences(table))


def reports(table: DataFrame) -> DataFrame:
    got = survey.report_features(table)
    return got.unionByName(survey.meta_features(got).select(got.columns))


_STANDARD = {"table": "standard/events"}
OPERATORS = {
    "standardize_events": Operator("standardize_events", "standard/events", standardize_events, {"raw": "raw/events"}),
    "standardize_signals": Operator("standardize_signals", "standard/signals", standardize_signals, {"raw": "raw/signals"}),
    "features_cardiac": Operator("features_cardiac", "features/cardiac", cardiac, {"signals": "standard/signals", **_STANDARD}),
    "features_galvanic": Operator("features_galvanic", "features/galvanic", galvanic, {"signals": "standard/signals", **_STANDARD}),
    "features_respiration": Operator("features_respiration", "features/respiration", breathing, {"signals": "standard/signals", **_STANDARD}),
    "features_behavior": Operator("features_behavior", "features/behavior", game, _STANDARD),
    "features_surveys": Operator("features_surveys", "features/surveys", reports, _STANDARD),
}


@flow
def dataset_local(spark: SparkSession, base: str, pattern: str = "*", limit: int | None = None) -> DataFrame:
    return open_dataset(spark, "local", base=base, pattern=pattern, limit=limit)


@flow
def dataset_catalog(spark: SparkSession, sql: str, seed: int | None = None, limit: int | None = None) -> DataFrame:
    return open_dataset(spark, "catalog", sql=sql, seed=seed, limit=limit)


@flow
def dataset_generic(spark: SparkSession, source: str, **options) -> DataFrame:
    return open_dataset(spark, source, **options)


@flow
def dataset_show(spark: SparkSession, source: str, **options) -> DataFrame:
    found = open_dataset(spark, source, **options)
    found.show(truncate=False)
    return found


@flow
def standardize_vr(spark: SparkSession, root: str, forced: bool = False) -> list:
    return run_all(spark, root, [OPERATORS["standardize_events"], OPERATORS["standardize_signals"]], forced)


def _features(family: str) -> Flow:
    def run(spark: SparkSession, root: str, forced: bool = False) -> list:
        return run_all(spark, root, [OPERATORS[f"features_{family}"]], forced)

    run.__name__ = f"features_{family}"
    run.__doc__ = f"Features of the {family} family for all files."
    return flow(run)


def _summary(family: str) -> Flow:
    def run(spark: SparkSession, root: str, path: str | None = None) -> str:
        target = path or f"{root.rstrip('/')}/population/{family}"
        write_population([read_key(spark, root, f"features/{family}")], target)
        return target

    run.__name__ = f"summarize_{family}"
    run.__doc__ = f"The {family} features of the whole population as CSV."
    return flow(run)


for _f in ("cardiac", "galvanic", "respiration", "behavior", "surveys"):
    _features(_f)
    _summary(_f)


@flow
def download_forms(spark: SparkSession, pages: str, path: str) -> str:
    """Stored response pages as one JSON document per response, each token once."""
    write_responses(read_responses(spark, pages), path)
    return path


@flow
def features_forms(spark: SparkSession, answers: DataFrame, config: dict, ranges: list[tuple[str, float, float]]) -> DataFrame:
    """Scores of all domains and dimensions for each response (response_id, ref, answer)."""
    table = spark.createDataFrame(forms.config_rows(config), forms.CONFIG_SCHEMA)
    return forms.form_features(forms.question_scores(answers, table, spark.createDataFrame(ranges, "ref string, low double, high double")))


@flow
def summarize_forms(spark: SparkSession, features: DataFrame, path: str) -> str:
    write_population([features], path)
    return path
