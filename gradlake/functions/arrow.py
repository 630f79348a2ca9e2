"""Arrow batches of examples as NumPy arrays, inside tasks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow.compute as pc

NULLS = "label and features must not be null"


def refuse_nulls(*columns) -> None:
    """Fail on a null in Arrow columns, which NumPy would turn into NaN."""
    if any(c.null_count for c in columns):
        raise ValueError(NULLS)


def matrix_of(tables: Sequence, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """The features and labels of Arrow batches as one matrix and one vector."""
    c = n_features
    rows = sum(t.num_rows for t in tables)
    x, y = np.empty((rows, c)), np.empty(rows)
    at = 0
    for table in tables:
        entries = table.column("features").flatten()
        refuse_nulls(entries, table.column("features"), table.column("label"))
        if not pc.all(pc.equal(pc.list_value_length(table.column("features")), c)).as_py():
            raise ValueError(f"every row must hold {c} features")
        x[at : at + table.num_rows] = entries.to_numpy(zero_copy_only=False).reshape(table.num_rows, c)
        y[at : at + table.num_rows] = table.column("label").to_numpy(zero_copy_only=False)
        at += table.num_rows
    return x, y
