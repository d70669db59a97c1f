"""Measure a stored model on the stored test split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpuslens.plans.train import measure, metric_table
from corpuslens.sources.models import load_model
from corpuslens.sources.tables import read_processed


def evaluate_stored(spark: SparkSession, model_path: str, processed_path: str) -> DataFrame:
    model = load_model(spark, model_path)
    test = read_processed(spark, processed_path, "test")
    return metric_table(spark, {"test": measure(model, test)})
