"""Session settings used by the tests and the benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str | None = None, memory: str = "8g") -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    return (SparkSession.builder.master(f"local[{cores}]").appName("exonloom")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.sql.adaptive.enabled", "true")
            .config("spark.sql.adaptive.skewJoin.enabled", "true")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.sql.execution.arrow.pyspark.enabled", "true")
            .config("spark.ui.enabled", "false")
            .config("spark.driver.memory", memory)
            .getOrCreate())
