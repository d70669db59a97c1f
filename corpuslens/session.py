"""Session defaults. A cluster session passes its own; nothing here overrides what is set."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", partitions: int = 8, memory: str = "16g") -> SparkSession:
    """Single-machine session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpuslens")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
