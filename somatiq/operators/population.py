"""Population tables from many files: unions, outer joins, merges of keyed groups."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(tables: list[DataFrame | None]) -> DataFrame:
    """All rows of all tables, by column name, missing columns NULL; None is passed over.

    Halves are joined, so that the plan of many tables is a shallow tree; columns come in the order
    in which the tables bring them.
    """
    some = [t for t in tables if t is not None]
    if not some:
        raise ValueError("nothing to merge")
    while len(some) > 1:
        pairs = [some[i].unionByName(some[i + 1], allowMissingColumns=True) for i in range(0, len(some) - 1, 2)]
        some = pairs + some[2 * len(pairs) :]
    return some[0]


def outer_join_all(tables: list[DataFrame], on: list[str]) -> DataFrame:
    return functools.reduce(lambda a, b: a.join(b, on, "full_outer"), tables)


def duplicate_groups(groups: DataFrame) -> DataFrame:
    """key, n of keys that more than one successful input claims (file_id, key, status)."""
    return groups.where("status = 'SUCCESS'").select("key", "file_id").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def merge_groups(groups: DataFrame) -> DataFrame:
    """Groups of successful inputs; raises if a key is claimed twice for the same parent."""
    good = groups.where("status = 'SUCCESS'")
    if not good.groupBy("parent_id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        raise ValueError("a group comes from more than one input")
    return good


def relocate_key(column: str = "key") -> Column:
    """The key with its first underscore-joined prefix as a folder: a_b becomes a/b."""
    return F.regexp_replace(F.col(column), "^([^_/]+)_", "$1/")
