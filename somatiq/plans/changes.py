"""What changed in the inputs of an operator since its last run, recording by recording.

A snapshot has a row for each data file of an input and each recording in it: path, size and time
of the file, and the number and two sums of hashes of the recording's rows. Sums do not depend on
order or on how rows are dealt to files, so a compacted input has not changed. A new snapshot takes
the rows of files that are still there as they are; only files that are new, or were written again,
are scanned. Versions of recordings are sums over files, and change sets are joins of two versions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.readers import PART_COLUMN

SNAPSHOT = "input string, path string, length long, modified timestamp, file_id string, n long, a decimal(38,0), b decimal(38,0)"
NEW, CHANGED, FAILED_BEFORE, OLD, REMOVED, SAME = "new", "changed", "failed", "old", "removed", "same"
#: So many new files at most are named in a filter, which prunes the scan; more are joined.
MOST_NAMED = 2000


def row_hash(table: DataFrame, salt: int) -> Column:
    """A 64-bit hash of all columns of a row by name; nulls count where they stand."""
    parts = []
    for name in sorted(table.columns):
        kind = table.schema[name].dataType
        value = F.to_json(F.col(f"`{name}`")) if isinstance(kind, (T.MapType, T.VariantType)) else F.col(f"`{name}`")
        parts += [F.col(f"`{name}`").isNull(), value]
    return F.xxhash64(F.lit(salt), *parts)


def row_sums(table: DataFrame) -> list[Column]:
    """n, a, b: the number of rows and two sums of their hashes."""
    plain = table.drop(PART_COLUMN)
    return [F.count(F.lit(1)).alias("n"), *(F.sum(row_hash(plain, salt).cast("decimal(38,0)")).cast("decimal(38,0)").alias(c) for salt, c in enumerate("ab"))]


def content_versions(table: DataFrame, by: str = "file_id") -> DataFrame:
    """by, version of each recording of one table: equal rows, in any order, give equal versions."""
    return table.groupBy(by).agg(*row_sums(table)).select(by, F.concat_ws(":", "n", "a", "b").alias("version"))


def snapshot(spark: SparkSession, paths: dict[str, str], before: DataFrame | None = None) -> DataFrame:
    """Rows as SNAPSHOT says of all inputs (name to folder); ``before`` is an earlier snapshot of them."""
    out = spark.createDataFrame([], SNAPSHOT)
    place = ["path", "length", "modified"]
    for name, path in paths.items():
        table = spark.read.option("mergeSchema", True).parquet(path)
        file = [F.col(f"_metadata.{c}").alias(a) for c, a in zip(("file_path", "file_size", "file_modification_time"), place, strict=True)]
        id_ = (F.col("file_id").cast("string") if "file_id" in table.columns else F.lit(None).cast("string")).alias("file_id")
        scanned = table
        if before is not None:
            known = before.where(F.col("input") == name)
            listed = table.select(*file).distinct()
            out = out.unionByName(known.join(listed, place, "left_semi"))
            fresh = listed.join(known, place, "left_anti").select("path")
            named = [r.path for r in fresh.limit(MOST_NAMED + 1).collect()]
            if len(named) <= MOST_NAMED:
                scanned = table.where(F.col("_metadata.file_path").isin(named)) if named else table.where("false")
            else:
                scanned = table.join(fresh, F.col("_metadata.file_path") == F.col("path"), "left_semi")
        out = out.unionByName(scanned.groupBy(*file, id_).agg(*row_sums(table)).withColumn("input", F.lit(name)))
    return out


def file_versions(snapshot: DataFrame) -> DataFrame:
    """file_id, version over all inputs."""
    per = snapshot.groupBy("input", "file_id").agg(*(F.sum(c).alias(c) for c in ("n", "a", "b")))
    told = F.array_sort(F.collect_list(F.concat_ws(":", "input", "n", "a", "b")))  # one for each input of the operator
    return per.groupBy("file_id").agg(F.sha2(F.array_join(told, "|"), 256).alias("version"))


def change_set(before: DataFrame, now: DataFrame, failed: Column | None = None, old: Column | None = None) -> DataFrame:
    """file_id, version, change of every recording of two tables (file_id, version): new, changed, failed, old, removed or same.

    ``failed`` and ``old`` are conditions on columns of ``before``: equal versions that have to be
    computed again. A null file_id is a recording of its own.
    """
    flags = [F.coalesce(c, F.lit(False)).alias(n) for c, n in ((failed if failed is not None else F.lit(False), "__failed"), (old if old is not None else F.lit(False), "__old"))]
    a = before.select(F.col("file_id").alias("__id"), F.col("version").alias("__version"), F.lit(True).alias("__was"), *flags)
    b = now.select("file_id", "version", F.lit(True).alias("__is"))
    change = (
        F.when(F.col("__was").isNull(), NEW).when(F.col("__is").isNull(), REMOVED).when(F.col("__version") != F.col("version"), CHANGED)
        .when(F.col("__failed"), FAILED_BEFORE).when(F.col("__old"), OLD).otherwise(SAME)
    )
    joined = a.join(b, F.col("__id").eqNullSafe(F.col("file_id")), "full_outer")
    return joined.select(F.when(F.col("__is").isNull(), F.col("__id")).otherwise(F.col("file_id")).alias("file_id"), "version", change.alias("change"))
