"""The session that the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def make_session(name: str = "somatiq", **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; other settings are the cluster's business."""
    told = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    return SparkSession.builder.appName(name).config(map=told).getOrCreate()
