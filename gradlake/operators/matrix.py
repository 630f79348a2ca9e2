"""A matrix stored one row per example, and its long form with one row per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradlake.functions import vectors as V


def split_label(df: DataFrame, record: str, n_features: int) -> DataFrame:
    """Split an array of ``n_features + 1`` numbers into ``features`` and ``label``; the label comes last."""
    values = V.as_doubles(F.col(record))
    complete = F.when(
        F.size(values) != n_features + 1,
        F.raise_error(F.lit(f"a record must hold {n_features} features and one label")).cast("array<double>"),
    ).otherwise(values)
    checked = df.withColumn("_record", complete)
    return (
        checked.withColumn("features", F.slice("_record", 1, n_features))
        .withColumn("label", F.element_at("_record", -1))
        .drop("_record", record)
    )


def to_long(df: DataFrame, row_id: str = "row_id", features: str = "features") -> DataFrame:
    """``cells(row_id, col, value)``: one row per matrix cell."""
    return df.select(row_id, F.posexplode(features).alias("col", "value"))


def cell_row(linear: Column, n_features: int) -> Column:
    """Row number of a linear index of a row-major matrix."""
    return F.floor(linear / n_features) if n_features == 1 else F.call_function("div", linear, F.lit(n_features))


def cell_col(linear: Column, n_features: int) -> Column:
    """Column number of a linear index of a row-major matrix."""
    return linear % n_features


def linear_index(row: Column, col: Column, n_features: int) -> Column:
    """Linear index of a cell of a row-major matrix."""
    return row * F.lit(n_features).cast("bigint") + col


def from_long(cells: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Rebuild ``features`` from cells. A group is one row of the matrix, so its size is the number of features."""
    ordered = F.array_sort(F.collect_list(F.struct("col", "value")))
    return cells.groupBy(row_id).agg(F.transform(ordered, lambda c: c["value"]).alias("features"))


def scale_rows(df: DataFrame, factor: Column, features: str = "features") -> DataFrame:
    """Multiply each row of the matrix by the scalar of that row."""
    return df.withColumn(features, V.scale(F.col(features), factor))


def scale_rows_by(
    df: DataFrame, factors: DataFrame, factor: str = "factor", row_id: str = "row_id", features: str = "features"
) -> DataFrame:
    """The same with the scalars in a second table, found by row id. The planner broadcasts it when it is small."""
    joined = df.join(factors.select(row_id, factor), row_id)
    return scale_rows(joined, F.col(factor), features).drop(factor)


def column_sums(
    df: DataFrame, n_features: int | None = None, divide_by: float = 1.0, features: str = "features"
) -> DataFrame:
    """``(feature_idx, total)``: the sum of every column, divided by a constant in the same aggregate.

    A null vector, a null entry and a vector of another width are errors, whatever the width. Both forms reduce inside each task first, so
    the shuffle carries one partial sum per column and task.
    """
    if divide_by == 0:
        raise ValueError("cannot divide column sums by zero")
    divisor = F.lit(float(divide_by))
    if n_features is not None and n_features <= V.UNROLL:
        vector = F.col(features)
        sums = [F.sum(V.of_width(V.required(x, features), vector, n_features)) / divisor for x in V.entries(vector, n_features)]
        return df.agg(F.array(*sums).alias("sums")).select(F.posexplode("sums").alias("feature_idx", "total"))
    vector = V.complete(F.col(features), features)
    whole = df.agg(V.vector_sum(vector if n_features is None else V.of_width(vector, vector, n_features)).alias("sums"))
    return whole.select(F.posexplode("sums").alias("feature_idx", "total")).withColumn("total", F.col("total") / divisor)


def row_sums(df: DataFrame, row_id: str = "row_id", features: str = "features") -> DataFrame:
    """``(row_id, total)``: the sum of every row, with no shuffle."""
    return df.select(row_id, V.total(F.col(features)).alias("total"))


def segment_sums(cells: DataFrame, segment: Column, value: str = "value") -> DataFrame:
    """``(segment, total)``: sum by key over the linearised matrix, whatever the order of its cells."""
    return cells.groupBy(segment.alias("segment")).agg(F.sum(value).alias("total"))


def l1_norm(df: DataFrame, value: Column) -> DataFrame:
    """Sum of absolute values of a column."""
    return df.agg(F.sum(F.abs(value)).alias("l1_norm"))
