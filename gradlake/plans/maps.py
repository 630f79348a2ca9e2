"""Steps of gradient descent as affine maps, composed on the executors.

One batch moves the weights by ``w -> (I - a/b G) w + a/b c``. Written on the vector ``(w, 1)`` this is one square matrix, and
running batches one after another multiplies their matrices. The product of a run of batches does not depend on the weights
the run starts from, so all runs of all epochs are computed side by side and only their order matters at the end. That
removes the one-batch-at-a-time limit of the textbook loop and gives the same weights up to rounding.

The rows of a run become pieces ``(epoch, batch, whole, data)``: ``whole`` pieces hold the matrix of consecutive full batches
starting with ``batch``; the others hold the moments of the part of a batch that a run has when a batch crosses into the next
run. Moments of the same batch add up.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradlake.functions.arrow import refuse_nulls
from gradlake.plans.moments import symmetric

GROUP_BYTES = 64 * 2**20
PIECE_SCHEMA = "epoch int, batch bigint, whole boolean, data array<double>"


def piece_table() -> Callable:
    """A function that packs pieces of one epoch into an Arrow table."""

    def pack(epoch, pieces):
        import pyarrow as pa

        return pa.table(
            {
                "epoch": pa.array([epoch] * len(pieces), type=pa.int32()),
                "batch": pa.array([p[0] for p in pieces], type=pa.int64()),
                "whole": pa.array([p[1] for p in pieces], type=pa.bool_()),
                "data": pa.array([p[2].ravel() for p in pieces], type=pa.list_(pa.float64())),
            }
        )

    return pack


def ordered_maps(n_features: int, batch_size: int) -> Callable:
    """A function that turns the pieces of one epoch into maps in the order of their batches."""
    c, b = n_features, batch_size

    def maps(table, rate):
        import numpy as np
        import pyarrow.compute as pc

        table = table.sort_by("batch").combine_chunks()
        stack = pc.list_flatten(table.column("data")).to_numpy().reshape(table.num_rows, c + 1, c + 1)
        batches, whole = table.column("batch").to_numpy(), table.column("whole").to_numpy(zero_copy_only=False)
        at = 0
        while at < len(batches):
            following = at + 1
            if whole[at]:
                yield stack[at]
            else:
                while following < len(batches) and batches[following] == batches[at]:
                    following += 1
                sums = stack[at:following].sum(axis=0)
                run = np.eye(c + 1)
                run[:c, :c] -= rate / b * sums[:c, :c]
                run[:c, c] = rate / b * sums[:c, c]
                yield run
            at = following

    return maps


def block_pieces(
    rows: DataFrame, n_features: int, batch_size: int, batches: int, rates: Mapping[int, float], most_rows: int
) -> DataFrame:
    """Pieces of every ``(epoch, block)``: rows are sorted by their key, cut at the batch limits and composed.

    A block holds at most ``most_rows`` rows, which the caller sizes to fit a task.
    """
    c, b, rates = n_features, batch_size, {int(e): float(r) for e, r in rates.items()}
    pack = piece_table()

    def compose_rows(key, table):
        import numpy as np
        import pyarrow.compute as pc

        epoch, block = key[0].as_py(), key[1].as_py()
        ids = table.column("row_id").to_numpy()
        order = np.lexsort((ids, table.column("order_key").to_numpy()))
        n = table.num_rows
        if (ids[order[1:]] == ids[order[:-1]]).any():
            raise ValueError("row ids repeat")
        if n > most_rows:
            raise ValueError(f"block {block} of epoch {epoch} holds {n} rows")
        entries = pc.list_flatten(table.column("features").combine_chunks())
        refuse_nulls(entries, table.column("label"))
        flat = entries.to_numpy()
        if flat.size != n * c:
            raise ValueError(f"every row must hold {c} features")
        x = flat.reshape(n, c)[order]
        y = table.column("label").to_numpy()[order]
        start = table.column("first_pos")[0].as_py()
        stop = min(start + n, batches * b)
        step = rates[epoch] / b
        pieces = []
        # rows up to the first batch limit, whole batches, rows after the last limit
        head = min(-(-start // b) * b, stop)
        tail = max(stop // b * b, head)
        for lo, hi in ((start, head), (tail, stop)):
            if hi > lo:
                part = np.column_stack([x[lo - start : hi - start], y[lo - start : hi - start]])
                pieces.append((lo // b, False, part.T @ part))
        if tail > head:
            run = np.eye(c + 1)
            for first in range(head - start, tail - start, b):
                xb = x[first : first + b]
                residual = xb @ run[:c]
                residual[:, c] -= y[first : first + b]
                run[:c] -= step * (xb.T @ residual)
            pieces.append((head // b, True, run))
        return pack(epoch, pieces)

    columns = ["epoch", "block", "first_pos", "order_key", "row_id", "features", F.col("label").cast("double").alias("label")]
    return rows.select(*columns).groupBy("epoch", "block").applyInArrow(compose_rows, PIECE_SCHEMA)


def moment_pieces(moments: DataFrame, n_features: int) -> DataFrame:
    """One piece per batch from :func:`gradlake.plans.moments.wide_moments`; a group holds one triangle."""
    pack, matrix = piece_table(), symmetric()

    def fold(key, table):
        return pack(key[0].as_py(), [(key[1].as_py(), False, matrix(table, n_features))])

    return moments.groupBy("epoch", "batch").applyInArrow(fold, PIECE_SCHEMA)


def compose(pieces: DataFrame, n_features: int, batch_size: int, rates: Mapping[int, float], span: int) -> DataFrame:
    """Multiply the maps of each span of consecutive batches of an epoch into one."""
    rates = {int(e): float(r) for e, r in rates.items()}
    pack, maps = piece_table(), ordered_maps(n_features, batch_size)

    def multiply(key, table):
        import numpy as np

        epoch = key[0].as_py()
        product = np.eye(n_features + 1)
        for run in maps(table, rates[epoch]):
            product = run @ product
        return pack(epoch, [(key[1].as_py() * span, True, product)])

    spanned = pieces.withColumn("span", F.call_function("div", F.col("batch"), F.lit(span).cast("bigint")))
    return spanned.groupBy("epoch", "span").applyInArrow(multiply, PIECE_SCHEMA)


def compose_until(
    pieces: DataFrame, n_features: int, batch_size: int, batches: int, rates: Mapping[int, float], count: int, limit_bytes: int
) -> DataFrame:
    """Compose level by level until the pieces of all epochs together fit into ``limit_bytes``.

    ``count`` is the number of pieces of an epoch, which are spread evenly over its batches.
    """
    each = (n_features + 1) ** 2 * 8
    fan_in = int(min(1024, max(4, GROUP_BYTES // each)))
    span = 1
    while count > 2 and count * len(rates) * each > limit_bytes:
        count = -(-count // fan_in)
        span = max(2 * span, -(-batches // count))
        pieces = compose(pieces, n_features, batch_size, rates, span)
    return pieces


def apply_pieces(w: np.ndarray, table, n_features: int, batch_size: int, rates: Mapping[int, float]):
    """Move the weights through collected pieces; yields the weights after each epoch."""
    import pyarrow.compute as pc

    maps = ordered_maps(n_features, batch_size)
    for epoch in sorted(rates):
        for run in maps(table.filter(pc.equal(table.column("epoch"), epoch)), rates[epoch]):
            w = run[:n_features, :n_features] @ w + run[:n_features, n_features]
        yield epoch, w
