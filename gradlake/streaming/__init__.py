"""The sources as streams: files that arrive while a job runs go through the same columns and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradlake.sources.examples import csv_reader, parsed_columns
from gradlake.sources.runs import RECORD_END, named_records


def stream_examples_csv(spark: SparkSession, path: str, n_features: int) -> DataFrame:
    """Stream of ``features, label`` from CSV files as they appear in a folder.

    Row-wise operators and the loss aggregates of :mod:`gradlake.operators.linear` apply to it unchanged.
    """
    return csv_reader(spark.readStream, n_features).csv(path).select(*parsed_columns(n_features))


def stream_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of run records as a sweep writes them."""
    return named_records(spark.readStream.option("lineSep", RECORD_END).text(f"{folder.rstrip('/')}/*.json"))
