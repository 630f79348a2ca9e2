"""Linear model without intercept: prediction, residual, gradients and losses.

``w`` is a list of numbers that travels inside the plan. Tables of examples have ``features`` and ``label`` columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradlake.functions import vectors as V
from gradlake.functions.arrow import matrix_of

PARTIAL_BYTES = 64 * 2**20  # sums a Python task holds before it hands them on


def prediction(w: V.Vector, features: str = "features") -> Column:
    return V.dot(F.col(features), w)


def residual(w: V.Vector, features: str = "features", label: str = "label") -> Column:
    """Derivative of the half squared error by the prediction: prediction minus label."""
    return prediction(w, features) - F.col(label)


def half_squared_error(w: V.Vector) -> Column:
    r = residual(w)
    return F.lit(0.5) * r * r


def with_gradient(examples: DataFrame, w: V.Vector) -> DataFrame:
    """Add the gradient of each row, ``(x . w - y) * x``."""
    return examples.withColumn("gradient", V.scale(F.col("features"), residual(w)))


def mean_abs_error(examples: DataFrame, w: V.Vector) -> DataFrame:
    """One row: mean absolute error over all rows."""
    return examples.agg(F.avg(F.abs(V.required(residual(w), "label and features"))).alias("mean_abs_error"))


def total_loss(examples: DataFrame, w: V.Vector) -> DataFrame:
    """One row: half the sum of squared errors."""
    return examples.agg(F.sum(V.required(half_squared_error(w), "label and features")).alias("total_loss"))


def batch_gradients(batched: DataFrame, w: Sequence[float], batch_size: int, keys: Sequence[str] = ("batch",)) -> DataFrame:
    """Average gradient of every batch at the same weights: ``keys`` (whole numbers) plus ``gradient array<double>``.

    A null label, a null entry and a vector of another width are errors, whatever the width.
    """
    n = len(w)
    if n <= V.UNROLL:
        with_residual = batched.select(*keys, "features", V.required(residual(w), "label and features").alias("resid"))
        x = V.entries(F.col("features"), n)
        sums = [F.sum(F.col("resid") * x[i]) / F.lit(float(batch_size)) for i in range(n)]
        return with_residual.groupBy(*keys).agg(F.array(*sums).alias("gradient"))
    sums = partial_gradients(batched, w, keys).groupBy(*keys).agg(V.vector_sum(F.col("part")).alias("total"))
    return sums.select(*(F.col(k).cast(batched.schema[k].dataType).alias(k) for k in keys), V.divide(F.col("total"), float(batch_size)).alias("gradient"))


def partial_gradients(batched: DataFrame, w: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """Sums of row gradients by ``keys``, one ``part`` for each key and task; a task hands its sums on whenever they take ``PARTIAL_BYTES``."""
    keys, weights, n, limit = list(keys), np.asarray(w, dtype=np.float64), len(w), PARTIAL_BYTES

    def run(tables):
        import pyarrow as pa

        held: dict[tuple, np.ndarray] = {}

        def flush():
            columns = [pa.array([key[i] for key in held], pa.int64()) for i in range(len(keys))]
            out = pa.RecordBatch.from_arrays([*columns, pa.array(list(held.values()), pa.list_(pa.float64()))], [*keys, "part"])
            held.clear()
            return out

        for table in tables:
            if not table.num_rows:
                continue
            x, y = matrix_of([table], n)
            ids = np.stack([table.column(k).to_numpy(zero_copy_only=False) for k in keys], axis=1).astype(np.int64)
            groups, place = np.unique(ids, axis=0, return_inverse=True)
            order = np.argsort(place.ravel(), kind="stable")
            starts = np.searchsorted(place.ravel()[order], np.arange(len(groups)))
            sums = np.add.reduceat(((x @ weights - y)[:, None] * x)[order], starts, axis=0)
            for key, part in zip(map(tuple, groups.tolist()), sums):
                held[key] = held[key] + part if key in held else part
            if len(held) * n * 8 > limit:
                yield flush()
        if held:
            yield flush()

    columns = [*[F.col(k).cast("bigint").alias(k) for k in keys], F.col("features"), F.col("label").cast("double").alias("label")]
    return batched.select(*columns).mapInArrow(run, ", ".join([*[f"{k} bigint" for k in keys], "part array<double>"]))


def predict_with_table(examples: DataFrame, weights_row: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Prediction with the weights in a one-row table ``(w array<double>)``: a scalar subquery, so no join at all."""
    with_weights = examples.select(row_id, "features", weights_row.select("w").scalar().alias("w"))
    return with_weights.select(row_id, V.dot(F.col("features"), F.col("w")).alias("prediction"))


def predict_long(cells: DataFrame, weights: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Prediction on the long form: join on the feature number, then sum by row."""
    joined = cells.join(weights, F.col("col") == F.col("feature_idx"))
    return joined.groupBy(row_id).agg(F.sum(F.col("value") * F.col("w")).alias("prediction"))
