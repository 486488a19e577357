"""Standard specifications as operators: each gives rows (check, violations), zero meaning valid."""

from __future__ import annotations

import enum

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timing import micros
from ..model import signal_channels


class Code(str, enum.Enum):
    BAD_TYPE = "BAD_TYPE"
    MISSING_COLUMN = "MISSING_COLUMN"
    INCORRECT_COLUMN_TYPE = "INCORRECT_COLUMN_TYPE"
    INCORRECT_CONTENTS = "INCORRECT_CONTENTS"
    REPEATED_ID = "REPEATED_ID"
    BEGIN_END_ORDER = "BEGIN_END_ORDER"
    ROW_ORDER = "ROW_ORDER"
    UNKNOWN_COLUMN_NAME = "UNKNOWN_COLUMN_NAME"
    BAD_SAMPLING = "BAD_SAMPLING"
    BAD_ANNOTATION_INDEX = "BAD_ANNOTATION_INDEX"
    BAD_ANNOTATION_CONTENTS = "BAD_ANNOTATION_CONTENTS"


class SpecificationError(ValueError):
    def __init__(self, code: Code, message: str) -> None:
        super().__init__(f"{code.value}: {message}")
        self.code = code


_TIMES = (T.TimestampNTZType, T.TimestampType)
_NUMBERS = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType)


def _version(version: str | None) -> None:
    if version not in (None, "1"):
        raise ValueError(f"unknown specification version {version!r}")


def _need(df: DataFrame, columns: dict[str, tuple]) -> None:
    types = {f.name: f.dataType for f in df.schema.fields}
    for name, kinds in columns.items():
        if name not in types:
            raise SpecificationError(Code.MISSING_COLUMN, name)
        if not isinstance(types[name], (*kinds, T.NullType)):
            raise SpecificationError(Code.INCORRECT_COLUMN_TYPE, f"{name} is {types[name].simpleString()}")


def event_violations(events: DataFrame, version: str | None = None, row: str | None = None) -> DataFrame:
    """check, violations for events (file_id, id, name, begin, end, data); ``row`` is the stored order, if known."""
    _version(version)
    _need(events, {"id": (T.StringType,), "name": (T.StringType,), "begin": _TIMES, "end": _TIMES, "data": (T.StringType,)})
    bad_data = F.col("data").isNotNull() & ~F.coalesce(F.ltrim("data").startswith("{") & F.get_json_object("data", "$").isNotNull(), F.lit(False))
    flags = {
        Code.INCORRECT_CONTENTS: F.col("id").isNull() | F.col("begin").isNull() | bad_data,
        Code.BEGIN_END_ORDER: F.coalesce(F.col("end") < F.col("begin"), F.lit(False)),
    }
    per = Window.partitionBy("file_id")
    told = events
    if row is not None:
        stored = F.row_number().over(per.orderBy(row))
        wanted = F.row_number().over(per.orderBy("begin", F.asc_nulls_last("end"), "id"))
        told = told.withColumn("__order", stored != wanted)
        flags[Code.ROW_ORDER] = F.col("__order")
    counts = told.agg(*[F.count_if(c).alias(k.value) for k, c in flags.items()])
    repeats = events.groupBy("file_id", "id").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")).select(F.lit(Code.REPEATED_ID.value).alias("check"), "violations")
    return counts.unpivot([], [k.value for k in flags], "check", "violations").unionByName(repeats)


def feature_violations(features: DataFrame, version: str | None = None) -> DataFrame:
    """check, violations for features (file_id, id, reference, value)."""
    _version(version)
    _need(features, {"id": (T.StringType,), "reference": (T.StringType,), "value": _NUMBERS})
    return features.agg(F.count_if(F.col("id").isNull() | F.col("reference").isNull()).alias("violations")).select(F.lit(Code.INCORRECT_CONTENTS.value).alias("check"), "violations")


def signal_violations(signals: DataFrame, version: str | None = None, channels: set[str] | None = None, jitter_us: int = 1) -> DataFrame:
    """check, violations for signals (file_id, ts, channels): files whose steps exceed twice the median."""
    _version(version)
    known = signal_channels() if channels is None else channels
    types = {f.name: f.dataType for f in signals.schema.fields}
    if not isinstance(types.get("ts"), _TIMES):
        raise SpecificationError(Code.BAD_TYPE, "ts is no timestamp")
    for name, kind in types.items():
        if name in ("file_id", "ts"):
            continue
        if name not in known:
            raise SpecificationError(Code.UNKNOWN_COLUMN_NAME, name)
        if not isinstance(kind, _NUMBERS) or name == "sample_number" and not isinstance(kind, (T.LongType, T.IntegerType)):
            raise SpecificationError(Code.INCORRECT_COLUMN_TYPE, name)
    w = Window.partitionBy("file_id").orderBy("ts")
    steps = signals.select("file_id", (micros("ts") - micros(F.lag("ts").over(w))).alias("d"))
    per = steps.groupBy("file_id").agg(F.percentile("d", 0.5).alias("m"), F.max(F.col("d")).alias("hi"), F.min(F.col("d")).alias("lo"))
    odd = (F.col("hi") - F.col("m") > F.col("m") + jitter_us) | (F.col("m") - F.col("lo") > F.col("m") + jitter_us) | (F.col("lo") <= 0)
    return per.agg(F.count_if(odd).alias("violations")).select(F.lit(Code.BAD_SAMPLING.value).alias("check"), "violations")


def annotation_violations(signals: DataFrame, annotations: DataFrame) -> DataFrame:
    """check, violations: annotations without a sample, missing samples with an empty annotation."""
    columns = [c for c in annotations.columns if c not in ("file_id", "ts")]
    for c in columns:
        if c not in signals.columns:
            raise SpecificationError(Code.UNKNOWN_COLUMN_NAME, c)
        if not isinstance(annotations.schema[c].dataType, T.StringType):
            raise SpecificationError(Code.BAD_ANNOTATION_CONTENTS, c)
    lost = annotations.join(signals.select("file_id", "ts"), ["file_id", "ts"], "left_anti").agg(F.count(F.lit(1)).alias("violations")).select(F.lit(Code.BAD_ANNOTATION_INDEX.value).alias("check"), "violations")
    notes = annotations.select("file_id", "ts", *[F.col(c).alias(f"__{c}") for c in columns])
    met = signals.join(notes, ["file_id", "ts"])
    silent = F.lit(False)
    for c in columns:
        silent = silent | (F.col(c).isNull() & (F.coalesce(F.col(f"__{c}"), F.lit("")) == ""))
    return lost.unionByName(met.agg(F.count_if(silent).alias("violations")).select(F.lit(Code.BAD_ANNOTATION_CONTENTS.value).alias("check"), "violations"))


def check(violations: DataFrame) -> None:
    """Raise the first violated check of a violations table."""
    for r in violations.where("violations > 0").orderBy("check").collect():
        raise SpecificationError(Code(r["check"]), f"{r['violations']} violations")


def infer_groups(tables: dict[str, DataFrame]) -> dict[str, list[str]]:
    """Which keys hold signals, events or features, by trying the specifications; annotations are passed over."""
    found: dict[str, list[str]] = {"signals": [], "events": [], "features": []}
    trials = {"events": event_violations, "features": feature_violations, "signals": signal_violations}
    for key, df in tables.items():
        if key.rstrip("/").endswith("/annotations"):
            continue
        for kind, trial in trials.items():
            try:
                check(trial(df))
            except ValueError:
                continue
            found[kind].append(key)
            break
    return found
