"""Session used by tests, the bench and scripts; clusters bring their own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: str = "8", partitions: int | None = None, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("screenwright")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions or (cores if cores != "*" else os.cpu_count())))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
