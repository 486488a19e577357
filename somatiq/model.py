"""Schemas of the data model, and empty tables that satisfy them.

Every table is keyed by ``file_id`` (one recording or participant session). NaN becomes NULL at
ingest and stays NULL; timestamps are TIMESTAMP_NTZ in UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _D, _L, _B, _TS = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, null) for n, t, null in fields])


EVENTS = _schema(("file_id", _S, False), ("id", _S, False), ("name", _S, True), ("begin", _TS, False), ("end", _TS, True), ("data", _S, True))
FEATURES = _schema(("file_id", _S, False), ("id", _S, False), ("reference", _S, False), ("value", _D, True))
NN = _schema(("file_id", _S, False), ("ts", _TS, False), ("nn", _D, True), ("bad", _B, False), ("details", _S, False))
METADATA = _schema(("file_id", _S, False), ("base", _S, True), ("journal", _S, True), ("standard", _S, True), ("protocol", _S, True), ("owner", _S, True))

#: Channels that a standard signal may have beside the 10-05 electrode names.
ECG_LEADS = ("I", "II", "III", "aVR", "aVL", "aVF")
PERIPHERAL = ("PPG", "GSR", "PZT")


def eeg_channels() -> set[str]:
    """The electrode names of the 10-05 system, by its rule.

    Fifteen rows run from ear to ear: sites 7 to 10 bear the lateral letters, all nearer ones the
    medial letters, and half steps an h. Five short rows lie at the poles.
    """
    rows = [("AFp", "AFp"), ("AF", "AF"), ("AFF", "AFF"), ("F", "F"), ("FFC", "FFT"), ("FC", "FT"), ("FCC", "FTT"), ("C", "T"), ("CCP", "TTP"), ("CP", "TP"), ("CPP", "TPP"), ("P", "P"), ("PPO", "PPO"), ("PO", "PO"), ("POO", "POO")]
    full = {(medial if i <= 6 else lateral) + f"{i}{half}" for medial, lateral in rows for i in range(1, 11) for half in ("", "h")} | {f"{medial}z" for medial, _ in rows}
    poles = {f"{row}{site}" for row in ("Fp", "O", "OI", "I") for site in ("1", "z", "2", "1h", "2h")}
    return full | poles | {"T3", "T4", "T5", "T6", "A1", "A2", "M1", "M2"}


def signal_channels() -> set[str]:
    return eeg_channels() | set(ECG_LEADS) | set(PERIPHERAL) | {"sample_number"}


def signals_schema(*channels: str) -> T.StructType:
    return _schema(("file_id", _S, False), ("ts", _TS, False), *((c, _L if c == "sample_number" else _D, True) for c in channels))


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A table without rows, of one of the schemas above."""
    return spark.createDataFrame([], schema)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating-point column."""
    return df.select(*[F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name) for f in df.schema.fields])
