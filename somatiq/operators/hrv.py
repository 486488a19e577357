"""Heart-rate-variability features per file and sequence."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import histogram_bin
from ..kernels import spectral
from .byfile import by_file
from .intervals import slice_join

#: Band limits in Hz and epoch lengths in seconds.
HRV_BANDS = {"VLF": (0.003, 0.04, 300), "LF": (0.04, 0.15, 120), "HF": (0.15, 0.4, 60), "VHF": (0.4, 0.5, 60)}
#: Fixed value: the width of a histogram bin in milliseconds (1/128 s).
BIN_MS = 7.8125


def time_features(nn: DataFrame, sequences: DataFrame) -> DataFrame:
    """file_id, reference, RMSSD, meanNN, SDNN, medianNN, pNN50, pNN20 over the good intervals of each sequence.

    Successive differences are signed and counted over N, not N - 1. Sequences without intervals
    have NULL features.
    """
    joined = slice_join(sequences, nn.where("not bad").select("file_id", "ts", "nn"))
    w = Window.partitionBy("file_id", "reference").orderBy("ts")
    diffed = joined.withColumn("d", F.col("nn") - F.lag("nn").over(w))
    n = F.count("nn")
    share = lambda t: F.try_divide(100.0 * F.count_if(F.col("d") > t), n)
    return diffed.groupBy("file_id", "reference").agg(
        F.sqrt(F.avg(F.col("d") * F.col("d"))).alias("RMSSD"), F.avg("nn").alias("meanNN"), F.stddev_samp("nn").alias("SDNN"), F.percentile("nn", 0.5).alias("medianNN"), share(50).alias("pNN50"), share(20).alias("pNN20")
    )


def geometric_features(nn: DataFrame, sequences: DataFrame, width: float = BIN_MS) -> DataFrame:
    """file_id, reference, HTI (intervals over the greatest bin index), Shannon_h (bits of the bin counts)."""
    joined = slice_join(sequences, nn.where("not bad").select("file_id", "ts", "nn"), "inner")
    per = Window.partitionBy("file_id", "reference")
    binned = joined.withColumn("bin", histogram_bin(F.col("nn"), F.min("nn").over(per), F.max("nn").over(per), width))
    counts = binned.groupBy("file_id", "reference", "bin").agg(F.count(F.lit(1)).alias("c"))
    p = counts.withColumn("p", F.col("c") / F.sum("c").over(per))
    return p.groupBy("file_id", "reference").agg(F.try_divide(F.sum("c").cast("double"), F.max("bin")).alias("HTI"), (-F.sum(F.col("p") * F.log2("p"))).alias("Shannon_h"))


def frequency_features(nni: DataFrame, sequences: DataFrame, fs: float) -> DataFrame:
    """file_id, reference, VLF, LF, HF, VHF, LFHF of uniformly sampled intervals (column nni)."""
    joined = slice_join(sequences, nni.select("file_id", "ts", F.col("nni").cast("double").alias("nni")))

    def run(c: dict[str, np.ndarray]) -> dict:
        x = c["nni"][~np.isnan(c["nni"])]
        power = {n: spectral.mean_band_power(x, fs, lo, hi, size, size - 1) for n, (lo, hi, size) in HRV_BANDS.items()}
        ratio = power["LF"] / power["HF"] if power["LF"] is not None and power["HF"] else None
        return power | {"LFHF": ratio}

    kind = nni.schema["file_id"].dataType.simpleString()
    return by_file(joined, run, f"file_id {kind}, reference string, VLF double, LF double, HF double, VHF double, LFHF double", keys=("file_id", "reference"))


def nonlinear_features(nn: DataFrame, sequences: DataFrame) -> DataFrame:
    """file_id, reference, DFA1 (windows 3-15, n >= 16), DFA2 (windows 16-63, n >= 64)."""
    joined = slice_join(sequences, nn.where("not bad").select("file_id", "ts", "nn"))

    def run(c: dict[str, np.ndarray]) -> dict:
        x = c["nn"][~np.isnan(c["nn"])]
        short = spectral.dfa(x, range(3, 16)) if len(x) >= 16 else None
        long = spectral.dfa(x, range(16, 64)) if len(x) >= 64 else None
        return {"DFA1": short, "DFA2": long}

    kind = nn.schema["file_id"].dataType.simpleString()
    return by_file(joined, run, f"file_id {kind}, reference string, DFA1 double, DFA2 double", keys=("file_id", "reference"))
