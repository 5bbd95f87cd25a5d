"""Session factory with the settings that the engine's semantics rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "brightsieve", master: str | None = None, **conf: str) -> SparkSession:
    """UTC timestamps and adaptive execution; everything else is left to the cluster's defaults."""
    builder = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or "local[*]")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    """A driver table; the path may be one that only Spark's readers can open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
