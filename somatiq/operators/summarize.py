"""Configured summaries of any signal over sequences, and reshaping of feature tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timing import micros, seconds_between
from .byfile import by_file
from .intervals import slice_join
from .quantiles import exact_quantiles

#: Reducers by the names that definitions use; all skip NULLs.
REDUCERS: dict[str, Callable[[Column], Column]] = {
    "numpy.sum": F.sum, "numpy.nansum": F.sum, "numpy.mean": F.avg, "numpy.nanmean": F.avg, "numpy.min": F.min, "numpy.nanmin": F.min, "numpy.max": F.max, "numpy.nanmax": F.max,
    "numpy.std": F.stddev_pop, "numpy.nanstd": F.stddev_pop, "numpy.var": F.var_pop, "numpy.median": lambda c: F.percentile(c, 0.5), "numpy.nanmedian": lambda c: F.percentile(c, 0.5), "numpy.size": F.count, "numpy.count_nonzero": lambda c: F.count_if(c != 0),
}


#: Reducers that users gave, by name: functions of the non-missing values of a sequence.
USER_REDUCERS: dict[str, Callable[[np.ndarray], float]] = {}


def register_reducer(name: str, function: Callable[[np.ndarray], float]) -> None:
    """Let definitions use ``function`` under ``name``: it gets a sequence's values (never none) in time order."""
    if name in REDUCERS:
        raise ValueError(f"{name} is a built-in reducer")
    USER_REDUCERS[name] = function


def user_reducer(name: str | None) -> Callable[[np.ndarray], float] | None:
    """A registered reducer, or any other function of numpy by its name; None if there is none."""
    if name in USER_REDUCERS:
        return USER_REDUCERS[name]
    found = getattr(np, name.removeprefix("numpy."), None) if name and name.startswith("numpy.") else None
    return found if callable(found) else None


@dataclass
class FeatureDefinition:
    """One feature: a reducer's name, or custom ``auc`` or ``linregress``, over some columns."""

    reducer: str | None = None
    columns: list[str] = field(default_factory=list)
    custom: str | None = None
    divide_by_duration: bool = False
    drop_bad_samples: bool = False
    empty_policy: float | str | None = None


def summarize(samples: DataFrame, sequences: DataFrame, definitions: dict[str, FeatureDefinition], names: list[str] | None = None) -> DataFrame:
    """file_id, reference, id (column_feature), value, status, long; features that are NULL everywhere are left out.

    Reducers that are no built-in expression (registered ones, and functions of numpy) run as one
    kernel over each sequence beside the expressions. ``names`` select sequences by substring. A number as empty policy is the value of a feature
    without samples; a text goes to the status column instead.
    """
    columns = sorted({c for d in definitions.values() for c in d.columns})
    unknown = [c for c in columns if c not in samples.columns]
    if unknown:
        raise ValueError(f"columns {unknown} are not in the samples")
    chosen = sequences
    if names is not None:
        cond = F.lit(False)
        for n in names:
            cond = cond | F.col("id").contains(n)
        chosen = sequences.where(cond)
    has_bad = "bad" in samples.columns
    joined = slice_join(chosen, samples.select("file_id", "ts", *columns, *(["bad"] if has_bad else [])))
    w = Window.partitionBy("file_id", "reference").orderBy("ts")
    areas = {}
    for name, d in definitions.items():
        if d.custom in ("auc", "linregress"):
            for c in d.columns:
                ok = F.col(c).isNotNull() & (~F.coalesce(F.col("bad"), F.lit(False)) if d.drop_bad_samples and has_bad else F.lit(True))
                t = F.when(ok, micros("ts"))
                areas[f"__t_{name}_{c}"] = (micros("ts") - F.min(t).over(Window.partitionBy("file_id", "reference"))) / 1e6
                before_t, before_v = (F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)) for x in (t, F.when(ok, F.col(c).cast("double"))))
                areas[f"__a_{name}_{c}"] = F.when(ok, (micros("ts") - before_t) / 1e6 * (F.col(c) + before_v) / 2)
    joined = joined.withColumns(areas) if areas else joined
    duration = seconds_between(F.first("begin"), F.first("end"))
    aggs, policies, kernels = [], {}, {}
    for name, d in definitions.items():
        for c in d.columns:
            good = ~F.coalesce(F.col("bad"), F.lit(False)) if d.drop_bad_samples and has_bad else F.lit(True)
            x = F.when(good, F.col(c).cast("double"))
            if d.custom == "auc":
                made = {f"{c}_{name}": F.when(F.count(x) > 1, F.sum(f"__a_{name}_{c}"))}
            elif d.custom == "linregress":
                t = F.when(good, F.col(f"__t_{name}_{c}"))
                made = {f"{c}_{name}_{k}": F.when(F.count(x) > 1, v) for k, v in (("slope", F.regr_slope(x, t)), ("intercept", F.regr_intercept(x, t)), ("r2", F.regr_r2(x, t)))}
            elif d.custom is not None:
                raise ValueError(f"unknown custom definition {d.custom!r}")
            elif d.reducer in REDUCERS:
                made = {f"{c}_{name}": REDUCERS[d.reducer](x)}
            elif (function := user_reducer(d.reducer)) is not None:
                made = {f"{c}_{name}": F.first(f"{c}_{name}")}
                kernels[f"{c}_{name}"] = (c, d.drop_bad_samples and has_bad, function)
            else:
                raise ValueError(f"unknown reducer {d.reducer!r}")
            for key, value in made.items():
                number = d.empty_policy if isinstance(d.empty_policy, (int, float)) else None
                filled = F.coalesce(value.cast("double"), F.lit(number).cast("double")) if number is not None else value.cast("double")
                aggs.append((F.try_divide(filled, duration) if d.divide_by_duration else filled).alias(key))
                policies[key] = d.empty_policy if isinstance(d.empty_policy, str) else None
    if kernels:
        joined = joined.join(_reduced(joined, kernels, has_bad), ["file_id", "reference"], "left")
    wide = joined.groupBy("file_id", "reference").agg(*aggs)
    long = wide.unpivot(["file_id", "reference"], list(policies), "id", "value")
    status = F.lit("ok")
    for key, text in policies.items():
        if text:
            status = F.when((F.col("id") == key) & F.col("value").isNull(), F.lit(text)).otherwise(status)
    told = long.withColumn("status", status)
    return told.where(F.col("value").isNotNull() | (F.col("status") != "ok"))


def _reduced(joined: DataFrame, kernels: dict[str, tuple[str, bool, Callable[[np.ndarray], float]]], has_bad: bool) -> DataFrame:
    """file_id, reference and a column for each kernel: its value over the sequence's samples; NULL without samples."""
    columns = sorted({c for c, _, _ in kernels.values()})

    def run(c: dict[str, np.ndarray]) -> dict:
        out = {}
        for key, (column, drop, function) in kernels.items():
            x = c[column][~np.isnan(c[column]) & ~(c["bad"] & drop)]
            out[key] = float(function(x)) if len(x) else None
        return out

    bad = F.coalesce(F.col("bad"), F.lit(False)) if has_bad else F.lit(False)
    told = joined.select("file_id", "reference", "ts", bad.alias("bad"), *(F.col(c).cast("double").alias(c) for c in columns))
    kind = joined.schema["file_id"].dataType.simpleString()
    return by_file(told, run, f"file_id {kind}, reference string, " + ", ".join(f"`{k}` double" for k in kernels), keys=("file_id", "reference"))


def lead_columns(df: DataFrame, *first: str) -> DataFrame:
    """The named columns first, then the others in their order."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def melt(wide: DataFrame, by: list[str]) -> DataFrame:
    return wide.unpivot(by, [c for c in wide.columns if c not in by], "id", "value")


def widen(long: DataFrame, by: list[str], ids: list[str]) -> DataFrame:
    """One column for each of the given feature ids (a given list saves the pass that would find them)."""
    return long.groupBy(*by).pivot("id", ids).agg(F.first("value"))


def describe_features(features: DataFrame, dictionary: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Adds name and units from a feature dictionary."""
    table = features.sparkSession.createDataFrame([(k, *v) for k, v in dictionary.items()], "id string, name string, units string")
    return features.join(table, "id")


#: Names and units of features.
DICTIONARY: dict[str, tuple[str, str | None]] = {
    "RMSSD": ("Root mean square of successive NN interval differences", "ms"), "meanNN": ("Mean of NN intervals", "ms"), "SDNN": ("Standard deviation of NN intervals", "ms"), "medianNN": ("Median of NN intervals", "ms"),
    "pNN50": ("Percentage of successive NN intervals that differ by more than 50 ms", "%"), "pNN20": ("Percentage of successive NN intervals that differ by more than 20 ms", "%"),
    "VLF": ("Absolute power of the very-low frequency band", "ms^2"), "LF": ("Absolute power of the low frequency band", "ms^2"), "HF": ("Absolute power of the high frequency band", "ms^2"), "VHF": ("Absolute power of the very-high frequency band", "ms^2"), "LFHF": ("Ratio of LF-to-HF power", "%"),
    "DFA1": ("DFA α1, short-term fractal scaling exponent", None), "DFA2": ("DFA α2, long-term fractal scaling exponent", None), "HTI": ("HRV triangular index", None), "Shannon_h": ("Shannon entropy", "bit"),
    "SCRamplitude": ("Mean amplitude of SCR component", "au"), "SCRincrease": ("Increase duration of SCR component", "s"), "SCRdecrease": ("Recovery duration of SCR component", "s"), "SCRrate": ("Number of SCR peaks divided by duration", "peaks/min"),
    "SCLmean": ("Mean of SCL component", "su"), "SCLmedian": ("Median of SCL component", "su"), "SCLsd": ("Standard deviation of SCL component", "su"), "SCLauc": ("Area Under Curve divided by duration of SCL component", "su/min"), "SCLslope": ("Slope from linear regression on SCL component", "su"), "SCLintercept": ("Intercept from linear regression on SCL component", "su"), "SCLr": ("R coefficient from linear regression on SCL component", "su"),
    "AMPmean": ("Mean respiratory amplitude", "au"), "AMPmax": ("Max respiratory amplitude", "au"), "AMPmin": ("Min respiratory amplitude", "au"), "AMPsd": ("Standard Deviation respiratory amplitude", "au"), "PERIODmean": ("Mean respiratory cycle duration", "s"), "PERIODsd": ("Standard Deviation of respiratory cycle duration", "s"), "INSPImean": ("Mean respiratory inspiration duration", "s"), "EXPImean": ("Mean respiratory expiration duration", "s"), "IEmean": ("Mean ratio between inspiration and expiration durations", "au"),
    "answerFinal": ("Final answer", "su"), "answerDuration": ("Duration of the answer", "s"),
}


def sequence_quantiles(samples: DataFrame, sequences: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """file_id, reference, n, and a column for each named share: exact quantiles of the samples of each sequence.

    Sequences without values have n 0 and NULL quantiles. No group is gathered, however long it is.
    """
    joined = slice_join(sequences, samples.select("file_id", "ts", F.col(column).cast("double").alias("__v")), "inner")
    told = exact_quantiles(joined, ["file_id", "reference"], "__v", list(shares.values())).select(F.col("file_id").alias("__f"), F.col("reference").alias("__r"), F.col("n").alias("__n"), "quantiles")
    named = sequences.select("file_id", F.col("id").alias("reference")).distinct()
    met = named.join(told, F.col("file_id").eqNullSafe(F.col("__f")) & F.col("reference").eqNullSafe(F.col("__r")), "left")
    return met.select("file_id", "reference", F.coalesce("__n", F.lit(0)).cast("long").alias("n"), *[F.col("quantiles")[j].alias(name) for j, name in enumerate(shares)])
