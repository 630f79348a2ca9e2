"""Synthetic linear-regression data of any size.

Every number is a function of the seed, the row and the feature, so any task can make any row by itself, and a smaller data
set with the same seed is a part of the larger one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.functions import vectors as V
from gradlake.functions.half import to_half
from gradlake.functions.seeded import normal, uniform_value
from gradlake.sources.examples import write_examples_csv
from gradlake.sources.weights import write_weights_csv


def true_coefficients(n_features: int, seed: int = 42) -> list[float]:
    """Coefficients uniform in (0, 100); every feature is informative."""
    return [100.0 * uniform_value(seed, "coef", j) for j in range(n_features)]


def generated_features(row_id: Column, n_features: int | Column, seed: int) -> Column:
    """Vector of standard normal numbers."""
    if isinstance(n_features, int) and n_features <= V.UNROLL:
        return F.array(*[normal(seed, row_id, j) for j in range(n_features)])
    width = n_features if isinstance(n_features, Column) else F.lit(n_features)
    return F.transform(F.sequence(F.lit(0), width - 1), lambda j: normal(seed, row_id, j))


def _labelled(df: DataFrame, coefficients: Column | list[float], row_id: str, noise: float, seed: int) -> DataFrame:
    label = V.dot(F.col("features"), coefficients)
    if noise:
        label = label + F.lit(float(noise)) * normal(seed, "noise", F.col(row_id))
    return df.withColumn("label", label)


def generate_regression(ids: DataFrame, n_features: int, noise: float = 0.0, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """Features and labels for a table of row ids; bias 0, one target, Gaussian label noise of the given deviation."""
    if n_features < 1:
        raise ValueError("at least one feature is needed")
    made = ids.select(row_id, generated_features(F.col(row_id), n_features, seed).alias("features"))
    return _labelled(made, true_coefficients(n_features, seed), row_id, noise, seed)


def make_linear(spark: SparkSession, n_rows: int, n_features: int, noise: float = 0.0, seed: int = 42) -> tuple[DataFrame, list[float]]:
    """A data set with dense row ids, and its true coefficients."""
    ids = spark.range(n_rows).withColumnRenamed("id", "row_id")
    return generate_regression(ids, n_features, noise, seed), true_coefficients(n_features, seed)


def stepped_range(start: int, end: int, stride: int) -> list[int]:
    """``start, start + stride, ...`` up to and including ``end``; a last step beyond ``end`` stops at ``end``."""
    if stride < 1 or start < 1 or end < start:
        raise ValueError("need 1 <= start <= end and a positive stride")
    sizes = list(range(start, end + 1, stride))
    return sizes if sizes[-1] == end else [*sizes, end]


def feature_family(ids: DataFrame, sizes: Sequence[int], noise: float = 0.0, seed: int = 42, row_id: str = "row_id") -> DataFrame:
    """Data sets of the same rows and noise with different numbers of features, told apart by ``n_features``."""
    wanted = F.explode(F.array(*[F.lit(int(s)) for s in sizes])).alias("n_features")
    made = ids.select(row_id, wanted)
    made = made.withColumn("features", generated_features(F.col(row_id), F.col("n_features"), seed))
    coefficients = F.slice(V.vector_literal(true_coefficients(max(sizes), seed)), F.lit(1), F.col("n_features"))
    return _labelled(made, coefficients, row_id, noise, seed)


def nested_family(base: DataFrame, sizes: Sequence[int], row_id: str = "row_id") -> DataFrame:
    """For each size ``k`` the first ``k`` rows of a base set with dense ids, told apart by the column ``k``.

    A row is repeated only for the sizes that contain it.
    """
    holding = F.filter(F.array(*[F.lit(int(s)).cast("bigint") for s in sizes]), lambda k: F.col(row_id) < k)
    return base.withColumn("k", F.explode(holding))


def half_precision(examples: DataFrame) -> DataFrame:
    """Round features and label to half precision, as stored data sets are."""
    return examples.withColumn("features", F.transform("features", to_half)).withColumn("label", to_half(F.col("label")))


def write_family(family: DataFrame, path: str, by: str) -> None:
    """One folder per member, so that reading one member touches only its files."""
    family.write.partitionBy(by).parquet(path)


def write_data_set(examples: DataFrame, coefficients: Sequence[float], stem: str) -> None:
    """``<stem>.csv`` with features and label, and ``<stem>_weights.csv`` with the true coefficients."""
    write_examples_csv(examples, f"{stem}.csv", len(coefficients))
    write_weights_csv(examples.sparkSession, list(coefficients), f"{stem}_weights.csv")


def write_feature_family(ids: DataFrame, sizes: Sequence[int], stem: str, noise: float = 0.0, seed: int = 42) -> None:
    """One data set per number of features, in half precision, named ``<stem>-<features>``."""
    for size in sizes:
        made = half_precision(generate_regression(ids, int(size), noise, seed))
        write_data_set(made, true_coefficients(int(size), seed), f"{stem}-{size}")


def write_nested_family(base: DataFrame, coefficients: Sequence[float], sizes: Sequence[int], stem: str) -> None:
    """The first ``k`` rows of a base set for each ``k`` as ``<stem>-<k>.csv``, and its coefficients once."""
    for size in sizes:
        write_examples_csv(base.where(F.col("row_id") < int(size)), f"{stem}-{size}.csv", len(coefficients))
    write_weights_csv(base.sparkSession, list(coefficients), f"{stem}_weights.csv")
