"""Weight vectors: one CSV row of ``C`` numbers, an array, or a long table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def weights_to_long(vectors: DataFrame, vector: str, *keys: str) -> DataFrame:
    """``keys, feature_idx, w`` from an array column."""
    return vectors.select(*keys, F.posexplode(vector).alias("feature_idx", "w"))


def weights_from_long(weights: DataFrame, *keys: str) -> DataFrame:
    """The array ``w`` again, in the order of the feature numbers."""
    ordered = F.array_sort(F.collect_list(F.struct("feature_idx", "w")))
    return weights.groupBy(*keys).agg(F.transform(ordered, lambda c: c["w"]).alias("w"))


def write_weights_csv(spark: SparkSession, weights: list[float], path: str) -> None:
    """One row of ``C`` columns."""
    schema = T.StructType([T.StructField(f"w{j}", T.DoubleType()) for j in range(len(weights))])
    spark.createDataFrame([tuple(float(v) for v in weights)], schema).coalesce(1).write.option("header", False).csv(path)


def read_weights_csv(spark: SparkSession, path: str, n_features: int) -> DataFrame:
    """``weights(feature_idx, w)`` from such a file; any other number of cells fails."""
    schema = T.StructType([T.StructField(f"w{j}", T.DoubleType()) for j in range(n_features)])
    row = spark.read.schema(schema).option("header", False).option("mode", "FAILFAST").option("columnPruning", False).csv(path)
    return weights_to_long(row.select(F.array(*schema.names).alias("w_row")), "w_row")
