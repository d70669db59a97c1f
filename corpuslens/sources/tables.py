"""Parquet, CSV and JSON tables, and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because executors on other machines
    could not read it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    current = context.getCheckpointDir()
    if current is None:
        current = tempfile.mkdtemp(prefix="corpuslens-")
        context.setCheckpointDir(current)
    return current.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Cuts lineage, keeps column pruning for later readers and survives the loss of executors.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/corpuslens/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_processed(df: DataFrame, path: str) -> None:
    """Processed articles, one folder per split, so that a split filter prunes files."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def read_processed(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if split is None else df.filter(df["split"] == split)


def write_json_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv_report(df: DataFrame, path: str) -> None:
    """White space around a value is part of it; without the two options Spark's writer would cut it."""
    exact = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**exact).csv(path)


def read_json_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_csv_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that ``write_csv_report`` wrote; quoted fields may hold line ends. CSV has one blank: empty texts are null."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)
