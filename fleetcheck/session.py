"""Local session for tests and the benchmark; a cluster brings its own settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, memory: str = "8g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("weighlens")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="weighlens-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
