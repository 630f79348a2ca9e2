"""Sums that a batch contributes to training: ``G = sum x x'`` and ``c = sum x y``.

The average gradient of a batch at ``w`` is ``(G w - c) / b``, so these sums are all that training needs from the rows. They
add up over any split of a batch: tasks reduce their own rows first and no batch has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradlake.functions import vectors as V
from gradlake.functions.arrow import refuse_nulls

PARTIAL_BYTES = 128 * 2**20  # sums a Python task holds before it hands them on


def _checked(examples: DataFrame, n_features: int) -> DataFrame:
    """Fail on a row of another length instead of mixing up columns."""
    message = F.lit(f"every row must hold {n_features} features")
    ok = F.size("features") == n_features
    return examples.withColumn("features", F.when(ok, F.col("features")).otherwise(F.raise_error(message).cast("array<double>")))


def narrow_moments(batched: DataFrame, n_features: int, keys: Sequence[str] = ()) -> DataFrame:
    """One row per key: ``rows``, ``g_i_j`` for i <= j, ``c_i``. Plain aggregates, inside code generation."""
    source = _checked(batched, n_features).select(
        *keys, V.required(F.col("label"), "label and features").alias("label"), *[V.required(x, "label and features").alias(f"x{i}") for i, x in enumerate(V.entries(F.col("features"), n_features))]
    )
    x = [F.col(f"x{i}") for i in range(n_features)]
    sums = [F.count("*").alias("rows")]
    sums += [F.sum(x[i] * x[j]).alias(f"g_{i}_{j}") for i in range(n_features) for j in range(i, n_features)]
    sums += [F.sum(x[i] * F.col("label")).alias(f"c_{i}") for i in range(n_features)]
    return source.groupBy(*keys).agg(*sums) if keys else source.agg(*sums)


def narrow_arrays(columns: dict[str, np.ndarray], n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Collected rows of :func:`narrow_moments` as stacked matrices ``G`` and vectors ``c``."""
    n = len(columns["rows"])
    g = np.empty((n, n_features, n_features))
    for i in range(n_features):
        for j in range(i, n_features):
            g[:, i, j] = g[:, j, i] = columns[f"g_{i}_{j}"]
    c = np.stack([columns[f"c_{i}"] for i in range(n_features)], axis=1)
    return g, c


FAN_IN = 32  # parts that one reducer adds up in a level of a tree sum
ROWS_PER_PART = 4  # rows of a part against the width of a row; its triangle is then an eighth of its rows


def tree_sum(parts: DataFrame, keys: Sequence[str], count: int) -> DataFrame:
    """``keys, i, part`` from ``parts(keys, piece, i, part)``: pieces of a key are added up ``FAN_IN`` at a time, level by level.

    ``count`` bounds the pieces of a key. Every level hands on at most one ``FAN_IN``-th of what the one before did, so no reducer
    meets more than ``FAN_IN`` vectors of a key at once, however many tasks there are.
    """
    keys = list(keys)
    while count > FAN_IN:
        count = -(-count // FAN_IN)
        parts = parts.withColumn("piece", F.pmod("piece", F.lit(count))).groupBy(*keys, "piece", "i").agg(V.vector_sum(F.col("part")).alias("part"))
    return parts.groupBy(*keys, "i").agg(V.vector_sum(F.col("part")).alias("part"))


def pieces_of(batch_rows: int, n_features: int) -> int:
    """How many pieces a batch is cut into by :func:`moments_by_rows`."""
    return max(1, batch_rows // (ROWS_PER_PART * (n_features + 1)))


def moments_by_rows(batched: DataFrame, n_features: int, keys: Sequence[str], batch_rows: int, row_id: str = "row_id") -> DataFrame:
    """The same as :func:`wide_moments` for batches of ``batch_rows`` rows: rows move once, to pieces of a batch, and each piece becomes one triangle.

    With the rows of a batch in many tasks, a triangle from each task would be more than the rows themselves. Here the triangles are
    about an eighth of the rows, and they are added up in a tree.
    """
    keys, c, pieces = list(keys), n_features, pieces_of(batch_rows, n_features)
    piece = F.pmod(F.xxhash64(row_id), F.lit(pieces)).alias("piece")
    columns = [*[F.col(k).cast("bigint").alias(k) for k in keys], piece, F.col("features"), F.col("label").cast("double").alias("label")]

    def triangle(key, table):
        import numpy as np
        import pyarrow as pa

        entries = table.column("features").combine_chunks().flatten()
        refuse_nulls(entries, table.column("features"), table.column("label"))
        rows = np.column_stack([entries.to_numpy(zero_copy_only=False).reshape(-1, c), table.column("label").to_numpy()])
        sums = rows.T @ rows
        columns = {name: pa.array([k.as_py()] * (c + 1), pa.int64()) for name, k in zip([*keys, "piece"], key)}
        lines = pa.array([sums[i, i:] for i in range(c + 1)], pa.list_(pa.float64()))
        return pa.table(columns | {"i": pa.array(range(c + 1), pa.int32()), "part": lines})

    schema = ", ".join([*[f"{k} bigint" for k in [*keys, "piece"]], "i int", "part array<double>"])
    parts = _checked(batched, n_features).select(*columns).groupBy(*keys, "piece").applyInArrow(triangle, schema)
    return tree_sum(parts, keys, pieces)


def wide_moments(batched: DataFrame, n_features: int, keys: Sequence[str] = (), tasks: int = 1) -> DataFrame:
    """``keys, i, part``: row ``i`` of the sums from the diagonal on, where index ``n_features`` stands for the label.

    A task sums its rows with a matrix product per batch and hands on what it has when its memory share is full, which is
    exact since partial sums add up. The parts meet as whole vectors, one row of the matrix per reducer key; those of many ``tasks`` in a tree.
    """
    keys = list(keys)
    piece = ["piece"] if tasks > FAN_IN else []
    c = n_features
    limit = PARTIAL_BYTES

    def partial_sums(tables):
        import numpy as np
        import pyarrow as pa

        held: dict[tuple, np.ndarray] = {}

        def flush():
            for key, sums in held.items():
                triangle = [sums[i, i:] for i in range(c + 1)]
                arrays = [pa.array([k] * (c + 1), type=pa.int64()) for k in key]
                arrays += [pa.array([TaskContext.get().partitionId()] * (c + 1), type=pa.int64())] * len(piece)
                arrays += [pa.array(range(c + 1), type=pa.int32()), pa.array(triangle, type=pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keys, *piece, "i", "part"])
            held.clear()

        for table in tables:
            if table.num_rows == 0:
                continue
            entries = table.column("features").flatten()
            refuse_nulls(entries, table.column("features"), table.column("label"))
            flat = entries.to_numpy(zero_copy_only=False)
            rows = np.empty((table.num_rows, c + 1))
            rows[:, :c] = flat.reshape(table.num_rows, c)
            rows[:, c] = table.column("label").to_numpy(zero_copy_only=False)
            if keys:
                ids = np.stack([table.column(k).to_numpy(zero_copy_only=False) for k in keys], axis=1).astype(np.int64)
                groups, place = np.unique(ids, axis=0, return_inverse=True)
                place = place.ravel()
            else:
                groups, place = np.empty((1, 0), dtype=np.int64), np.zeros(table.num_rows, dtype=np.int64)
            by_group = np.argsort(place, kind="stable")
            ends = np.cumsum(np.bincount(place, minlength=len(groups)))
            for g, (lo, hi) in enumerate(zip(np.r_[0, ends[:-1]], ends)):
                part = rows[by_group[lo:hi]]
                key = tuple(groups[g].tolist())
                if key in held:
                    held[key] += part.T @ part
                else:
                    held[key] = part.T @ part
                if len(held) * (c + 1) ** 2 * 8 > limit:
                    yield from flush()
        yield from flush()

    columns = [*[F.col(k).cast("bigint").alias(k) for k in keys], F.col("features"), F.col("label")]
    schema = ", ".join([*[f"{k} bigint" for k in [*keys, *piece]], "i int", "part array<double>"])
    parts = _checked(batched, n_features).select(*columns).mapInArrow(partial_sums, schema)
    return tree_sum(parts, keys, tasks if piece else 1)


def symmetric() -> Callable:
    """A function that puts the rows of :func:`wide_moments` for one batch together as a full matrix."""

    def matrix(table, n_features):
        import numpy as np

        sums = np.zeros((n_features + 1, n_features + 1))
        for i, part in zip(table.column("i").to_pylist(), table.column("part")):
            sums[i, i:] = sums[i:, i] = part.values.to_numpy()
        return sums

    return matrix
