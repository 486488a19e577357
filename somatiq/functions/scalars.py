"""Scalar expressions: conversions, annotations, bins, recodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The texts of annotations.
SATURATED_HIGH, SATURATED_LOW, UNKNOWN, OUTSIDE, OUTLIER = "saturated high", "saturated low", "unknown", "outside_session", "outliers"


def gsr_from_raw(raw: Column, slope: float = 1.0, offset: float = 0.0) -> Column:
    """1000 / (slope * raw + offset); NULL where the divisor is zero."""
    return F.try_divide(F.lit(1000.0), raw * slope + offset)


def gsr_saturation(raw: Column, high: float = 2000.0) -> Column:
    """The annotation of a raw sample: zero or at least ``high``, negative, missing, or nothing."""
    return F.when(raw.isNull(), F.lit(UNKNOWN)).when((raw == 0) | (raw >= high), F.lit(SATURATED_HIGH)).when(raw < 0, F.lit(SATURATED_LOW)).otherwise(F.lit(""))


def missing_annotation(value: Column) -> Column:
    return F.when(value.isNull(), F.lit(UNKNOWN)).otherwise(F.lit(""))


def grid_bin(x: Column, low: float, high: float, n: int) -> Column:
    """1-based bin of a left-closed grid; the upper bound itself is bin n + 1."""
    return F.width_bucket(x, F.lit(float(low)), F.lit(float(high)), F.lit(n))


def histogram_bin(x: Column, low: Column, high: Column, width: float) -> Column:
    """1-based bin from ``low`` in steps of ``width``; the maximum is clamped to the last bin."""
    return F.least(F.floor((x - low) / width) + 1, F.ceil((high - low) / width))


def recode(mapping: dict[str, float], key: Column) -> Column:
    """The mapped value; NULL for keys that the map lacks."""
    pairs = [x for k, v in mapping.items() for x in (F.lit(k), F.lit(float(v)))]
    return F.create_map(*pairs)[key]


def reverse_score(value: Column, low: Column, high: Column) -> Column:
    return low + high - value


def truthy(text: Column) -> Column:
    """Whether a text says yes."""
    return F.lower(text).isin("yes", "true", "t", "1")


def version_key(version: Column) -> Column:
    """Numbers of a dotted version, so that 0.10.0 comes after 0.4.0."""
    return F.transform(F.split(version, r"\."), lambda p: F.coalesce(F.regexp_extract(p, r"^\d+", 0).try_cast("int"), F.lit(0)))


def json_field(data: Column, path: str) -> Column:
    return F.get_json_object(data, f"$.{path}")
