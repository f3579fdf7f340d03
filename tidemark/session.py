"""Session settings that the plans count on; everything else is left to the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",  # partition sizes and broadcasts from measured sizes
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, name: str = "tidemark", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
