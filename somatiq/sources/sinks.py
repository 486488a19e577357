"""Sinks: keyed datasets, population CSV, JSON responses, catalog rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.population import union_all
from .readers import key_path, read_key


def store_key(df: DataFrame, root: str, key: str, annotations: DataFrame | None = None, partition: str | None = "file_id", mode: str = "overwrite") -> None:
    """Write a dataset, and its annotations beside it, replacing what was there.

    With a partition column only the partitions that the dataset holds are replaced: files that
    are run again replace their own rows.
    """
    for frame, at in ((df, key), (annotations, f"{key}/annotations")):
        if frame is not None:
            writer = frame.write.mode(mode).option("partitionOverwriteMode", "dynamic" if partition else "static")
            if partition:
                writer = writer.partitionBy(partition)
            writer.parquet(key_path(root, at))


def write_population(tables: list[DataFrame | None], path: str, single: bool = False) -> None:
    """All feature tables as CSV with a header; ``single`` makes one file of a table known to be small."""
    merged = union_all(tables)
    (merged.coalesce(1) if single else merged).write.mode("overwrite").option("header", True).csv(path)


def write_responses(responses: DataFrame, path: str) -> None:
    """One JSON document per response, keys in order."""
    responses.select(F.to_json(F.struct(*sorted(responses.columns))).alias("value")).write.mode("overwrite").text(path)


def merge_datasets(spark: SparkSession, sources: list[tuple[str, str]], root: str) -> list[str]:
    """Put datasets (root, key) of several places under one root; the keys that were written.

    A key that two places claim raises before anything is written; places without the dataset, or
    with an empty one, are passed over.
    """
    found = [(key.strip("/"), table) for source, key in sources if (table := read_key(spark, source, key)) is not None and not table.isEmpty()]
    keys = [key for key, _ in found]
    twice = sorted({k for k in keys if keys.count(k) > 1})
    if twice:
        raise ValueError(f"groups from more than one input: {', '.join(twice)}")
    for key, table in found:
        table.write.mode("overwrite").parquet(key_path(root, key))
    return keys


def append_catalog(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system, if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within its file system; parents of the new name are made."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(path(target).getParent())
    if not store.rename(path(source), path(target)):
        raise OSError(f"cannot move {source} to {target}")
