"""Batch steps on stored blocks of rows, for small tables and for models too wide for maps.

A step needs two products with the rows of its batch, ``r = X w - y`` and ``X' r``, far less work than the maps of :mod:`gradlake.plans.maps`, but
one batch has to follow the other. So rows are laid down once per epoch in blocks of consecutive batches, and the weights travel to the
blocks: one small job per block, not per batch.

* A table that a task can hold is moved to one, which goes through all epochs by itself.
* Otherwise a block is one folder on disk. A task goes through the batches in order; a batch that goes on in the next block hands on its part of
  the gradient.
* Rows too wide for that are cut by columns, and a block of ``k`` whole batches is spread over several tasks. From the Gram matrix ``X X'`` of its
  rows, which is summed over the slices beforehand and for all blocks at once, the residuals of all its batches follow from ``X w`` alone:
  ``r_j = (X w - y)_j - sum_i<j a (X X')_ji r_i`` for the batches i before j in the block. So k batches take one job for ``X w`` and one for ``X' r``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.functions import vectors as V
from gradlake.functions.arrow import matrix_of
from gradlake.functions.seeded import ORDER_PRIME, WORD_BITS, order_words
from gradlake.session import discard, fresh_path, materialise

CHUNK_BYTES = 8 * 2**20  # of a block that is handed on as one row
REPEATED = "row ids repeat"


def epoch_keys(high: np.ndarray, low: np.ndarray, epoch: int) -> np.ndarray:
    """The keys of :func:`gradlake.functions.seeded.order_key`, from the same words."""

    def part(word: np.ndarray) -> np.ndarray:
        return ((word >> WORD_BITS) * epoch + (word & (2**WORD_BITS - 1))) % ORDER_PRIME

    return (part(high) << WORD_BITS) + part(low)


@dataclass
class Setting:
    """One training run over a table that a task can hold: the rows with smaller ids (all if None), the first features, batch size and start."""

    batch_size: int
    w0: np.ndarray
    rows_below: int | None = None


@dataclass
class OneTask:
    """What a task of :func:`all_epochs` says: weights, rows, the last epoch, mean absolute error, and the milliseconds of reading and of each epoch's phases."""

    weights: np.ndarray
    rows: int
    epoch: int
    error: float
    read: float
    shuffle: list[float]
    gradient: list[float]


def all_epochs(examples: DataFrame, settings: Sequence[Setting], rates: Sequence[float], seed: int, shuffle: bool) -> list[OneTask]:
    """All epochs of every setting, each in one task, from one scan; the caller has checked that the table is no larger than a block.

    A row goes to the tasks of the settings that have it.
    """
    width = max(len(s.w0) for s in settings)
    takes = [F.lit(True) if s.rows_below is None else F.col("row_id") < s.rows_below for s in settings]
    chosen = F.explode(F.filter(F.array(*[F.when(t, F.lit(i)) for i, t in enumerate(takes)]), lambda i: i.isNotNull())).alias("setting")
    rows = examples.select("row_id", "features", F.col("label").cast("double").alias("label"))
    if any(s.rows_below is not None for s in settings) or len(settings) > 1:
        rows = rows.select("*", chosen).repartitionById(len(settings), F.col("setting")).drop("setting")
    else:
        rows = rows.repartition(1)
    keyed = order_words(rows, "row_id", seed) if shuffle else rows

    def run(tables):
        import time

        import pyarrow as pa

        started = time.perf_counter()
        held = [t for t in tables if t.num_rows]
        if not held:
            return
        number = TaskContext.get().partitionId()
        own = settings[number]
        x, y = matrix_of(held, width)
        x, b, weights = x[:, : len(own.w0)], own.batch_size, own.w0
        ids = np.concatenate([t.column("row_id").to_numpy() for t in held])
        by_id = np.argsort(ids, kind="stable")
        if (ids[by_id[1:]] == ids[by_id[:-1]]).any():
            raise ValueError(REPEATED)
        if shuffle:
            high, low = (np.concatenate([t.column(name).to_numpy() for t in held])[by_id] for name in ("_high", "_low"))
        read = 1000 * (time.perf_counter() - started)
        spent: tuple[list[float], list[float]] = ([], [])
        with np.errstate(all="ignore"):
            for epoch, rate in enumerate(rates, 1):
                started = time.perf_counter()
                # equal keys go by id
                order = by_id[np.argsort(epoch_keys(high, low, epoch), kind="stable")] if shuffle else by_id
                spent[0].append(1000 * (time.perf_counter() - started))
                started, step = time.perf_counter(), rate / b
                for at in range(0, len(y) // b * b, b):
                    batch = order[at : at + b]
                    part = x[batch]
                    weights = weights - step * ((part @ weights - y[batch]) @ part)
                spent[1].append(1000 * (time.perf_counter() - started))
                if not np.isfinite(weights).all():
                    break
            error = float(np.abs(x @ weights - y).mean())
        columns = [[number], [weights], [len(y)], [epoch], [error], [read], [spent[0]], [spent[1]]]
        numbers = pa.list_(pa.float64())
        kinds = [pa.int32(), numbers, pa.int64(), pa.int32(), pa.float64(), pa.float64(), numbers, numbers]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["setting", "w", "n_rows", "epoch", "error", "read", "shuffle", "gradient"])

    schema = "setting int, w array<double>, n_rows bigint, epoch int, error double, read double, shuffle array<double>, gradient array<double>"
    found = {r["setting"]: r for r in keyed.mapInArrow(run, schema).collect()}
    if len(found) < len(settings):
        raise ValueError("the data set is empty")
    return [OneTask(np.array(r["w"]), r["n_rows"], r["epoch"], r["error"], r["read"], r["shuffle"], r["gradient"]) for _, r in sorted(found.items())]


def packed(tables: Sequence, n_features: int, first: int, **more: int):
    """The rows of Arrow batches in the order of their keys, as chunks: ``more``, the place of the ``first`` row, and ``x`` and ``y`` as packed numbers."""
    import pyarrow as pa

    x, y = matrix_of(tables, n_features)
    ids, keys = (np.concatenate([t.column(name).to_numpy() for t in tables]) for name in ("row_id", "order_key"))
    order = np.lexsort((ids, keys))
    if (ids[order[1:]] == ids[order[:-1]]).any():
        raise ValueError(REPEATED)
    size = max(1, CHUNK_BYTES // (8 * max(1, n_features)))
    for at in range(0, len(y), size):
        rows = order[at : at + size]
        columns = {name: pa.array([v], pa.int32()) for name, v in more.items()}
        columns |= {"first": pa.array([first + at]), "x": pa.array([x[rows].tobytes()], pa.binary()), "y": pa.array([y[rows].tobytes()], pa.binary())}
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def unpacked(tables):
    """``(first, x, y)`` of every chunk."""
    for table in tables:
        for first, x, y in zip(table.column("first").to_pylist(), table.column("x"), table.column("y")):
            labels = np.frombuffer(y.as_buffer())
            yield first, np.frombuffer(x.as_buffer()).reshape(len(labels), -1), labels


@dataclass
class Blocks:
    """Blocks on disk, a folder each: what a lost executor held is read again, not computed again."""

    spark: SparkSession
    path: str
    numbers: frozenset[int]

    def of(self, block: int, *below: str) -> DataFrame:
        """The chunks of a block as one partition, in any order."""
        folder = "/".join([self.path, f"block={block}", *below])
        return self.spark.read.schema(CHUNKS).parquet(folder).coalesce(1)

    def discard(self) -> None:
        table = self.spark.read.schema(CHUNKS).parquet(self.path)
        table.written_to = self.path
        discard(table)


CHUNKS = "first bigint, x binary, y binary"


def write_blocks(chunks: DataFrame, *folders: str) -> Blocks:
    path = fresh_path(chunks.sparkSession, "gradlake-blocks")
    chunks.write.option("compression", "none").partitionBy(*folders).parquet(path)
    found = chunks.sparkSession.read.schema(f"{CHUNKS}, block int").parquet(path).select("block").distinct().collect()
    return Blocks(chunks.sparkSession, path, frozenset(r["block"] for r in found))


def stored_blocks(placed: DataFrame, n_features: int, place: Callable, blocks: int) -> Blocks:
    """The rows of every block in order, as chunks ``first`` (place in the epoch), ``x`` and ``y`` (packed numbers).

    ``place`` gives the number of a block, from 0 to ``blocks``, from the columns ``epoch`` and ``block``.
    """
    c = n_features

    def pack(tables):
        held = [t for t in tables if t.num_rows]
        if held:
            yield from packed(held, c, held[0].column("first_pos")[0].as_py(), block=TaskContext.get().partitionId())

    columns = ["row_id", "order_key", "first_pos", "features", F.col("label").cast("double").alias("label")]
    rows = placed.repartitionById(blocks, place(F.col("epoch"), F.col("block")).cast("int")).select(*columns)
    return write_blocks(rows.mapInArrow(pack, f"block int, {CHUNKS}"), "block")


def step_through(stored: Blocks, block: int, w: np.ndarray, pending: np.ndarray, batch_size: int, stop: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """The weights after one block, and the gradient of the batch it leaves unfinished: a job of one task, which gets the weights."""
    if block not in stored.numbers:
        return w, pending
    b, step = batch_size, rate / batch_size

    def run(tables):
        import pyarrow as pa

        weights, gradient = w, pending
        with np.errstate(all="ignore"):
            for first, x, y in sorted(unpacked(tables), key=lambda c: c[0]):
                at, end = 0, min(len(y), stop - first)
                while at < end:
                    filled = (first + at) % b
                    to = min(end, at + b - filled)
                    gradient = gradient + (x[at:to] @ weights - y[at:to]) @ x[at:to]
                    if filled + to - at == b:
                        weights, gradient = weights - step * gradient, np.zeros(len(w))
                    at = to
        numbers = pa.list_(pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array([weights], numbers), pa.array([gradient], numbers)], ["w", "pending"])

    found = stored.of(block).mapInArrow(run, "w array<double>, pending array<double>").toArrow()
    return found.column("w")[0].values.to_numpy(), found.column("pending")[0].values.to_numpy()


@dataclass
class Slices:
    """Blocks of whole batches, cut by columns into folders of ``width`` each, and the Gram matrices of their rows."""

    chunks: Blocks
    grams: DataFrame
    slices: int
    width: int


def sliced_blocks(placed: DataFrame, n_features: int, width: int, index: Callable, blocks: int) -> Slices:
    """Store the blocks in slices of ``width`` columns, and the Gram matrix of the rows of each, summed over its slices.

    ``placed`` has the whole batches of a block under ``epoch`` and ``block``, and ``order_key``; ``index`` numbers them from 0 to ``blocks``.
    """
    slices = -(-n_features // width)
    checked = F.when(F.size("features") == n_features, F.col("features")).otherwise(F.raise_error(F.lit(f"every row must hold {n_features} features")).cast("array<double>"))
    part = F.explode(F.array(*[F.struct(F.lit(s).alias("slice"), F.slice("whole", 1 + s * width, width).alias("features")) for s in range(slices)]))
    columns = ["row_id", "order_key", F.col("label").cast("double").alias("label"), index(F.col("epoch"), F.col("block")).cast("int").alias("index")]
    rows = placed.select(*columns, checked.alias("whole")).select("row_id", "order_key", "label", "index", part.alias("part"))
    rows = rows.select("row_id", "order_key", "label", "part.features", (F.col("index") * slices + F.col("part.slice")).alias("place"))

    def pack(tables):
        held = [t for t in tables if t.num_rows]
        if held:
            number = TaskContext.get().partitionId()
            yield from packed(held, len(held[0].column("features")[0]), 0, block=number // slices, slice=number % slices)

    chunks = rows.repartitionById(blocks * slices, F.col("place")).select("row_id", "order_key", "features", "label")
    stored = write_blocks(chunks.mapInArrow(pack, f"block int, slice int, {CHUNKS}"), "block", "slice")

    def gram(key, table):
        import pyarrow as pa

        x = np.concatenate([x for _, x, _ in sorted(unpacked([table]), key=lambda c: c[0])])
        found = x @ x.T
        columns = {"block": pa.array([key[0].as_py()] * len(found), pa.int32()), "i": pa.array(range(len(found)), pa.int32())}
        return pa.table(columns | {"line": pa.array(list(found), pa.list_(pa.float64()))})

    cells = placed.sparkSession.read.schema(f"{CHUNKS}, block int, slice int").parquet(stored.path)
    grams = cells.groupBy("block", "slice").applyInArrow(gram, "block int, i int, line array<double>").groupBy("block", "i").agg(V.vector_sum(F.col("line")).alias("line"))
    return Slices(stored, materialise(grams, "grams"), slices, width)


def residuals(start: np.ndarray, gram: np.ndarray, batch_size: int, step: float) -> np.ndarray:
    """The residuals of consecutive batches, each at the weights the ones before have led to, from those at the first weights."""
    r = start.copy()
    for at in range(batch_size, len(r), batch_size):
        r[at : at + batch_size] -= step * (gram[at : at + batch_size, :at] @ r[:at])
    return r


def step_over(stored: Slices, block: int, w: np.ndarray, batch_size: int, rate: float) -> np.ndarray:
    """The weights after all batches of one block: a job for ``X w - y``, a job for ``X' r``."""
    width, context = stored.width, stored.chunks.spark.sparkContext
    if block not in stored.chunks.numbers:
        return w
    lines = stored.grams.where(F.col("block") == block).select("i", "line").toArrow()
    gram = np.empty((lines.num_rows, lines.num_rows))
    for i, line in zip(lines.column("i").to_pylist(), lines.column("line")):
        gram[i] = line.values.to_numpy()
    shared = context.broadcast(w)

    def over_slices(work: Callable) -> list[np.ndarray]:
        """``work`` of the first column, rows and labels of every slice, each in a task of its own."""

        def run(first: int):
            def each(tables):
                import pyarrow as pa

                chunks = sorted(unpacked(tables), key=lambda c: c[0])
                part = work(first, np.concatenate([x for _, x, _ in chunks]), np.concatenate([y for _, _, y in chunks]))
                yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([part], pa.list_(pa.float64()))], ["first", "part"])

            return each

        jobs = [stored.chunks.of(block, f"slice={s}").mapInArrow(run(s * width), "first bigint, part array<double>") for s in range(stored.slices)]
        found = reduce(DataFrame.unionAll, jobs).toArrow().sort_by("first")
        return [p.values.to_numpy() for p in found.column("part")]

    # the labels count once
    products = over_slices(lambda first, x, y: x @ shared.value[first : first + width] - (y if first == 0 else 0.0))
    with np.errstate(all="ignore"):
        r = residuals(np.sum(products, axis=0), gram, batch_size, rate / batch_size)
    told = context.broadcast(r)
    gradient = np.concatenate(over_slices(lambda first, x, y: told.value @ x))
    shared.destroy()
    told.destroy()
    return w - rate / batch_size * gradient
