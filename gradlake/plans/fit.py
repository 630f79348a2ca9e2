"""Fit a linear model by mini-batch gradient descent.

Every epoch shuffles all rows, cuts them into batches of exactly ``batch_size`` rows and skips the remainder. A batch moves
the weights by ``-(lr / epoch ** decay_power)`` times its average gradient.

Strategies, all giving the same weights up to rounding:

``fold``    One pass computes the moments of every batch of many epochs; the driver folds them in order. For models whose
            batch moments are few and small. ``batch_size = 0`` needs one pass for all epochs together.
``blocks``  Rows move once per epoch to blocks of consecutive batches, each block becomes one affine map, and the maps are
            composed in a tree. For many batches or many features.
``steps``   Rows move once per epoch to blocks of consecutive batches, and the weights go from block to block, one small job each. For
            wide models, whose maps cost more than the rows. A table that a task can hold goes through all epochs in one task.
``loop``    One job per batch on a table that is sorted by batch inside its partitions. For batches larger than the blocks of ``steps``.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.functions import vectors as V
from gradlake.functions.arrow import refuse_nulls
from gradlake.functions.seeded import uniform_value
from gradlake.operators import linear
from gradlake.operators.ordering import (
    FEW_BITS,
    MOST_BITS,
    EpochOrder,
    assign_runs,
    assign_units,
    default_bits,
    epochs_per_pass,
    measure_order,
    number_of_batches,
)
from gradlake.plans import maps as M
from gradlake.plans import moments as S
from gradlake.plans import steps as T
from gradlake.session import discard
from gradlake.sources.runs import write_run

STRATEGIES = ("auto", "fold", "blocks", "steps", "loop")
DRIVER_BYTES = 64 * 2**20  # batch statistics or maps that may reach the driver at a time
BLOCK_BYTES = 64 * 2**20  # rows of one block, in one Python task
WHOLE_BYTES = 128 * 2**20  # a table that one Python task may hold
LARGEST_BLOCK_BYTES = 512 * 2**20
MANY_BLOCKS = 2**17
WIDEST_MAP = 2048  # beyond this many features a map of one block outgrows a task
SHUFFLED_BYTES = 256 * 2**30  # rows that one pass over several epochs may move
STORED_BYTES = 4 * 2**30  # blocks that ``steps`` lays down at a time
GRAM_ROWS = 1024  # rows of a block that is cut by columns; their Gram matrix passes through the driver
STEPS_OF_A_TASK = 2**18  # batches of all epochs that one task may go through, some seconds
SMALL_BYTES = 2**30  # a table that Spark may read in a handful of tasks


@dataclass
class FitResult:
    weights: list[float]
    n_rows: int
    n_features: int
    batch_size: int
    num_batches: int
    epochs: int
    strategy: str
    phases: list[tuple[int, str, float]] = field(default_factory=list)  # epoch, phase, milliseconds

    def millis(self, phase: str) -> float:
        return sum((ms for _, name, ms in self.phases if name == phase), 0.0)


def initial_weights(n_features: int, seed: int = 42) -> list[float]:
    """Uniform in [0, 0.01), the same for the same seed."""
    return [0.01 * uniform_value(seed, "w0", j) for j in range(n_features)]


def learning_rate(lr: float, epoch: int, decay_power: float) -> float:
    return lr / epoch**decay_power


def refuse_repeated_ids(examples: DataFrame) -> None:
    """Raise if any row id occurs twice. Ids alone are shuffled, counted per task first."""
    if examples.groupBy("row_id").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        raise ValueError(T.REPEATED)


def weights_table(spark: SparkSession, weights: Sequence[float]) -> DataFrame:
    """``(feature_idx, w)``."""
    return spark.createDataFrame([(j, float(v)) for j, v in enumerate(weights)], "feature_idx int, w double")


def choose_strategy(n_rows: int, n_features: int, batch_size: int, epochs: int) -> str:
    if batch_size == 0:
        return "loop" if n_features > WIDEST_MAP else "fold"
    batches = number_of_batches(n_rows, batch_size)
    row_bytes = (n_features + 1) * 8
    if fits_one_task(n_rows, n_features) and batches * epochs <= STEPS_OF_A_TASK:
        return "steps"
    if n_features > WIDEST_MAP:
        return "steps" if batch_size * row_bytes <= BLOCK_BYTES or batch_size < GRAM_ROWS // 2 else "loop"
    if n_features <= V.UNROLL and _moment_bytes(batches, n_features) <= DRIVER_BYTES:
        return "fold"
    if batch_size * (n_features + 1) * 8 <= LARGEST_BLOCK_BYTES:
        return "blocks"
    return "fold"


def fits_one_task(n_rows: int, n_features: int) -> bool:
    return n_rows * (n_features + 1) * 8 <= WHOLE_BYTES


def fit(
    examples: DataFrame,
    lr: float,
    epochs: int,
    batch_size: int,
    *,
    w0: Sequence[float] | None = None,
    decay_power: float = 0.25,
    seed: int = 42,
    shuffle: bool = True,
    strategy: str = "auto",
    n_features: int | None = None,
    order: EpochOrder | None = None,
) -> FitResult:
    """Fit on ``examples(row_id, features, label)`` with unique row ids.

    ``batch_size = 0`` uses all rows in each step. With ``shuffle=False`` the batches follow the row ids, which must then be
    dense. ``order`` may hold a measured order of these rows and epochs, so that several fits can share it.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if epochs < 1:
        raise ValueError("at least one epoch is needed")
    if n_features is None:
        n_features = _first_width(examples)
    w = np.asarray(initial_weights(n_features, seed) if w0 is None else w0, dtype=np.float64)
    if w.shape != (n_features,):
        raise ValueError(f"{w.size} initial weights do not fit {n_features} features")
    run = _Run(examples, n_features, lr, epochs, batch_size, decay_power, seed, shuffle, order)
    run.start()
    chosen = choose_strategy(run.n_rows, n_features, batch_size, epochs) if strategy == "auto" else strategy
    started = time.perf_counter()
    held = run.hold_small(chosen)
    if order is None and (chosen in ("fold", "loop") or batch_size == 0):
        # the other strategies see equal ids side by side
        refuse_repeated_ids(run.examples)
    try:
        if chosen == "loop":
            w = run.loop(w)
        elif batch_size == 0:
            w = run.full_batch(w)
        elif chosen == "blocks":
            w = run.blocks(w)
        elif chosen == "steps":
            w = run.steps(w)
        else:
            w = run.fold(w)
    finally:
        if held is not None:
            held.unpersist()
    run.phases.append((epochs, "total", 1000 * (time.perf_counter() - started)))
    return FitResult(w.tolist(), run.n_rows, n_features, batch_size, run.num_batches, epochs, chosen, run.phases)


def fit_and_score(examples: DataFrame, lr: float, epochs: int, batch_size: int, **options) -> tuple[FitResult, float]:
    """Fit, then mean absolute error of the final weights over all rows, the skipped ones included."""
    result = fit(examples, lr, epochs, batch_size, **options)
    error = linear.mean_abs_error(examples, result.weights).first()[0]
    return result, float(error)


def run_record(result: FitResult, error: float, read_millis: float = 0.0) -> dict[str, float]:
    """The five numbers of a run record. Each phase is counted once, in milliseconds.

    ``read_millis`` is time spent on reading before the fit; what the fit itself has measured of it is added.
    """
    return {
        "shuffle_time": result.millis("shuffle"),
        "total_gradient_time": result.millis("gradient"),
        "gpu_time": result.millis("total"),
        "transfer_time": float(read_millis) + result.millis("transfer"),
        "error": float(error),
    }


def train_and_record(
    examples: DataFrame, lr: float, epochs: int, batch_size: int, *, folder: str, name: str, parameter: int, codepath: str | None = None, read_millis: float = 0.0, **options
) -> tuple[FitResult, float, str]:
    """Fit, score, and write the run record ``<name>-<parameter>-<path>.json`` to ``folder``: the fit, its error and the record's path.

    The path is that of the strategy unless given. The record is written last and replaces one of the same name, so a run that failed and is
    started again leaves exactly one.
    """
    result, error = fit_and_score(examples, lr, epochs, batch_size, **options)
    path = write_run(examples.sparkSession, run_record(result, error, read_millis), folder, name, parameter, codepath or result.strategy, replace=True)
    return result, error, path


def phase_metrics(spark: SparkSession, runs: dict[str, FitResult]) -> DataFrame:
    """``(run_id, epoch, phase, millis)`` of several runs."""
    rows = [(run_id, e, phase, ms) for run_id, r in runs.items() for e, phase, ms in r.phases]
    return spark.createDataFrame(rows, "run_id string, epoch int, phase string, millis double")


def _first_width(examples: DataFrame) -> int:
    first = examples.select(F.size("features").alias("n")).first()
    if first is None:
        raise ValueError("the data set is empty")
    return int(first["n"])


def _moment_bytes(batches: int, n_features: int) -> int:
    return batches * (n_features * (n_features + 3) // 2 + 3) * 8


def _chunks(items: Sequence[int], size: int) -> list[list[int]]:
    return [list(items[i : i + size]) for i in range(0, len(items), size)]


@dataclass
class _Run:
    examples: DataFrame
    n_features: int
    lr: float
    epochs: int
    batch_size: int
    decay_power: float
    seed: int
    shuffle: bool
    order: EpochOrder | None
    n_rows: int = 0
    num_batches: int = 0
    phases: list[tuple[int, str, float]] = field(default_factory=list)

    def start(self) -> None:
        """Learn the number of rows and batches."""
        if self.order is not None:
            self.n_rows = self.order.rows
        elif self.shuffle or self.batch_size == 0:
            self.n_rows = self.examples.count()
        else:
            self.n_rows = self._check_dense()
        if self.n_rows == 0:
            raise ValueError("the data set is empty")
        self.num_batches = number_of_batches(self.n_rows, self.batch_size)

    def hold_small(self, strategy: str) -> DataFrame | None:
        """Spread a small table over the cores and keep it while it is read several times.

        Spark reads a small file in one task. A large table is left where it is: each pass reads it from its source.
        """
        if self.n_rows * (self.n_features + 2) * 8 > SMALL_BYTES or (self.batch_size == 0 and strategy != "loop"):
            return None
        if strategy == "steps" and self._one_block():
            return None
        cores = self.examples.sparkSession.sparkContext.defaultParallelism
        spread = self.examples.select("row_id", "features", "label").repartition(cores, "row_id")
        self.examples = spread.persist(StorageLevel.MEMORY_AND_DISK)
        return self.examples

    def rate(self, epoch: int) -> float:
        return learning_rate(self.lr, epoch, self.decay_power)

    def _check_dense(self) -> int:
        ids = self.examples.agg(F.count("*"), F.min("row_id"), F.max("row_id")).first()
        if ids[0] and (ids[1] != 0 or ids[2] != ids[0] - 1):
            raise ValueError("batches in row order need dense row ids (see with_row_id)")
        return int(ids[0])

    def _timed(self, epoch: int, phase: str, started: float) -> None:
        self.phases.append((epoch, phase, 1000 * (time.perf_counter() - started)))

    def _order_of(self, epochs: Sequence[int], bits: int) -> EpochOrder:
        """The measured order of these epochs, in buckets of at least this many bits."""
        if self.order is not None and self.order.bits >= bits and set(epochs) <= set(self.order.epochs):
            return self.order.of(epochs)
        started = time.perf_counter()
        found = measure_order(self.examples, epochs, self.seed, bits=bits)
        self._timed(epochs[0], "shuffle", started)
        if found.rows != self.n_rows:
            raise ValueError("the data changed while it was read")
        return found

    def _bits(self) -> int:
        return default_bits(self.n_rows, self.num_batches)

    def _batched(self, epochs: Sequence[int]) -> DataFrame:
        """Rows of the full batches of these epochs."""
        end = self.num_batches * self.batch_size
        if self.shuffle:
            order = self._order_of(epochs, self._bits())
            started = time.perf_counter()
            placed = assign_units(self.examples, order, self.batch_size, end)
            self._timed(epochs[0], "shuffle", started)
            return placed
        return self._in_row_order(epochs, self.batch_size, "batch").where(F.col("row_id") < end)

    def _in_row_order(self, epochs: Sequence[int], rows: int, unit: str) -> DataFrame:
        wanted = F.array(*[F.lit(e) for e in epochs])
        number = F.call_function("div", F.col("row_id"), F.lit(rows).cast("bigint"))
        return self.examples.withColumn("epoch", F.explode(wanted)).withColumn(unit, number)

    def _descend(self, w: np.ndarray, epoch: int, g: np.ndarray, c: np.ndarray, rows: int) -> np.ndarray:
        step = self.rate(epoch) / rows
        with np.errstate(all="ignore"):
            for g_batch, c_batch in zip(g, c):
                w = w - step * (g_batch @ w - c_batch)
        return finite(w, epoch)

    # -- one batch of all rows: the moments never change, so one pass serves all epochs

    def full_batch(self, w: np.ndarray) -> np.ndarray:
        started = time.perf_counter()
        n = self.n_features
        if n <= V.UNROLL:
            found = S.narrow_moments(self.examples, n).toArrow()
            g, c = S.narrow_arrays({k: found.column(k).to_numpy() for k in found.column_names}, n)
        else:
            sums = S.symmetric()(S.wide_moments(self.examples, n, tasks=self.examples.rdd.getNumPartitions()).toArrow(), n)
            g, c = sums[None, :n, :n], sums[None, :n, n]
        self._timed(self.epochs, "gradient", started)
        for epoch in range(1, self.epochs + 1):
            w = self._descend(w, epoch, g, c, self.n_rows)
        return w

    # -- fold

    def fold(self, w: np.ndarray) -> np.ndarray:
        if self.n_features > V.UNROLL:
            return self._fold_wide(w)
        need = _moment_bytes(self.num_batches, self.n_features)
        if need > DRIVER_BYTES:
            raise ValueError("the batch moments do not fit the driver; use the blocks strategy")
        at_once = max(1, min(DRIVER_BYTES // need, epochs_per_pass(self._bits())))
        every = list(range(1, self.epochs + 1))
        if not self.shuffle:
            g, c = self._moments_of([1])[1]
            for epoch in every:
                w = self._descend(w, epoch, g, c, self.batch_size)
            return w
        for epochs in _chunks(every, at_once):
            found = self._moments_of(epochs)
            for epoch in epochs:
                w = self._descend(w, epoch, *found[epoch], self.batch_size)
        return w

    def _moments_of(self, epochs: Sequence[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        placed = self._batched(epochs)
        started = time.perf_counter()
        table = S.narrow_moments(placed, self.n_features, ["epoch", "batch"]).toArrow()
        table = table.sort_by([("epoch", "ascending"), ("batch", "ascending")])
        columns = {k: table.column(k).to_numpy() for k in table.column_names}
        if len(columns["rows"]) != len(epochs) * self.num_batches or (columns["rows"] != self.batch_size).any():
            raise ValueError("some batch is incomplete: row ids repeat or the data changed between passes")
        g, c = S.narrow_arrays(columns, self.n_features)
        self._timed(epochs[0], "gradient", started)
        n = self.num_batches
        return {e: (g[k * n : (k + 1) * n], c[k * n : (k + 1) * n]) for k, e in enumerate(epochs)}

    def _fold_wide(self, w: np.ndarray) -> np.ndarray:
        """Batches too large for one task: sums per task or per piece of a batch, whichever hands on less; one map per batch."""
        tasks = self.examples.rdd.getNumPartitions()
        for epochs in _chunks(range(1, self.epochs + 1), epochs_per_pass(self._bits())):
            batched, keys = self._batched(epochs), ["epoch", "batch"]
            if self.sums_by_task(tasks):
                sums = S.wide_moments(batched, self.n_features, keys, tasks)
            else:
                sums = S.moments_by_rows(batched, self.n_features, keys, self.batch_size)
            w = self._apply(w, M.moment_pieces(sums, self.n_features), self.num_batches, epochs)
        return w

    def sums_by_task(self, tasks: int) -> bool:
        """Whether a triangle per batch from each task is at most as much as the rows of the batch."""
        return tasks * (self.n_features + 1) <= 2 * self.batch_size

    # -- blocks

    def blocks(self, w: np.ndarray) -> np.ndarray:
        row_bytes = (self.n_features + 1) * 8
        if self.batch_size * row_bytes > LARGEST_BLOCK_BYTES:
            raise ValueError("a batch does not fit a task; use the fold strategy")
        end = self.num_batches * self.batch_size
        rows = self._rows_per_block(row_bytes)
        # about eight buckets per block let the blocks come out even
        bits = min(MOST_BITS, max(FEW_BITS, math.ceil(math.log2(8 * self.n_rows / rows))))
        at_once = max(1, min(SHUFFLED_BYTES // (end * row_bytes), epochs_per_pass(bits)))
        for epochs in _chunks(range(1, self.epochs + 1), at_once):
            if self.shuffle:
                order = self._order_of(epochs, bits)
                placed, most = assign_runs(self.examples, order, rows, end), rows + int(order.counts.max())
            else:
                placed = self._in_row_order(epochs, rows, "block").withColumn("first_pos", F.col("block") * rows)
                placed, most = placed.withColumn("order_key", F.col("row_id")), rows
            rates = {e: self.rate(e) for e in epochs}
            found = M.block_pieces(placed, self.n_features, self.batch_size, self.num_batches, rates, most)
            w = self._apply(w, found, 3 * -(-self.n_rows // rows), epochs)
        return w

    def _rows_per_block(self, row_bytes: int) -> int:
        """Enough rows to outweigh the map of a block, enough blocks to use the cluster, and small enough for a task."""
        limit = max(BLOCK_BYTES, min(LARGEST_BLOCK_BYTES, self.n_rows * row_bytes // MANY_BLOCKS))
        cores = self.examples.sparkSession.sparkContext.defaultParallelism
        to_fill = math.ceil(self.n_rows * self.epochs / (4 * cores))
        to_pay = max(4 * (self.n_features + 1), 2 * self.batch_size)
        return int(min(limit // row_bytes, max(to_fill, to_pay), self.n_rows))

    def _apply(self, w: np.ndarray, pieces: DataFrame, count: int, epochs: Sequence[int]) -> np.ndarray:
        """Compose the pieces of each epoch and move the weights through them in order."""
        started = time.perf_counter()
        n, b, rates = self.n_features, self.batch_size, {e: self.rate(e) for e in epochs}
        table = M.compose_until(pieces, n, b, self.num_batches, rates, count, DRIVER_BYTES).toArrow()
        self._timed(epochs[0], "gradient", started)
        for epoch, moved in M.apply_pieces(w, table, n, b, rates):
            w = finite(moved, epoch)
        return w

    # -- steps

    def _one_block(self) -> bool:
        return fits_one_task(self.n_rows, self.n_features)

    def steps(self, w: np.ndarray) -> np.ndarray:
        """Blocks of consecutive batches, laid down for some epochs at a time; the weights go from one to the next."""
        if self._one_block():
            return self._in_one_task(w)
        row_bytes, end = (self.n_features + 1) * 8, self.num_batches * self.batch_size
        if self.batch_size * row_bytes > BLOCK_BYTES and self.batch_size < GRAM_ROWS // 2:
            return self._sliced_steps(w)
        rows = max(1, BLOCK_BYTES // row_bytes)
        bits = min(MOST_BITS, max(FEW_BITS, math.ceil(math.log2(8 * self.n_rows / rows))))
        per_epoch = -(-self.n_rows // rows) + 1
        at_once = max(1, min(STORED_BYTES // (end * row_bytes), epochs_per_pass(bits)))
        for epochs in _chunks(range(1, self.epochs + 1), at_once):
            if self.shuffle:
                placed = assign_runs(self.examples, self._order_of(epochs, bits), rows, end)
            else:
                placed = self._in_row_order(epochs, rows, "block").withColumn("first_pos", F.col("block") * rows).withColumn("order_key", F.col("row_id"))
            started = time.perf_counter()
            first = epochs[0]
            held = T.stored_blocks(placed, self.n_features, lambda epoch, block: (epoch - first) * per_epoch + block, per_epoch * len(epochs))
            try:
                self._timed(first, "shuffle", started)
                pending = np.zeros(self.n_features)
                for epoch in epochs:
                    started = time.perf_counter()
                    for block in range(per_epoch):
                        w, pending = T.step_through(held, (epoch - first) * per_epoch + block, w, pending, self.batch_size, end, self.rate(epoch))
                    w = finite(w, epoch)
                    self._timed(epoch, "gradient", started)
            finally:
                held.discard()
        return w

    def _in_one_task(self, w: np.ndarray) -> np.ndarray:
        rates = [self.rate(e) for e in range(1, self.epochs + 1)]
        (found,) = T.all_epochs(self.examples, [T.Setting(self.batch_size, w)], rates, self.seed, self.shuffle)
        if found.rows != self.n_rows:
            raise ValueError("the data changed while it was read")
        self.phases.append((1, "transfer", found.read))
        for epoch, (shuffled, stepped) in enumerate(zip(found.shuffle, found.gradient), 1):
            self.phases += [(epoch, "shuffle", shuffled), (epoch, "gradient", stepped)]
        return finite(found.weights, found.epoch)

    def _sliced_steps(self, w: np.ndarray) -> np.ndarray:
        """Blocks of whole batches, cut by columns; a block takes two jobs however many batches it holds."""
        n, b = self.n_features, self.batch_size
        each = GRAM_ROWS // b
        width = max(1, BLOCK_BYTES // (8 * each * b))
        blocks, end = -(-self.num_batches // each), self.num_batches * b
        at_once = max(1, min(STORED_BYTES // (end * (n + 1) * 8), epochs_per_pass(self._bits())))
        for epochs in _chunks(range(1, self.epochs + 1), at_once):
            first = epochs[0]
            if self.shuffle:
                placed = assign_units(self.examples, self._order_of(epochs, self._bits()), each * b, end, unit="block", keep_key=True)
            else:
                placed = self._in_row_order(epochs, each * b, "block").where(F.col("row_id") < end).withColumn("order_key", F.col("row_id"))
            started = time.perf_counter()
            stored = T.sliced_blocks(placed, n, width, lambda epoch, block: (epoch - first) * blocks + block, blocks * len(epochs))
            try:
                self._timed(first, "shuffle", started)
                for epoch in epochs:
                    started = time.perf_counter()
                    for block in range(blocks):
                        w = T.step_over(stored, (epoch - first) * blocks + block, w, b, self.rate(epoch))
                    w = finite(w, epoch)
                    self._timed(epoch, "gradient", started)
            finally:
                discard(stored.grams)
                stored.chunks.discard()
        return w

    # -- loop

    def loop(self, w: np.ndarray) -> np.ndarray:
        """One gradient job per batch.

        Rows stay where they are and are sorted by batch inside each partition, so a batch is spread over all tasks and the
        cached column chunks of other batches are skipped by their minimum and maximum.
        """
        tasks = None
        for epoch in range(1, self.epochs + 1):
            held = None
            if self.batch_size != 0:
                placed = self._batched([epoch]).select("batch", "features", "label")
                held = placed.sortWithinPartitions("batch").persist(StorageLevel.MEMORY_AND_DISK)
            started = time.perf_counter()
            try:
                for batch in range(self.num_batches):
                    rows = self.examples if held is None else held.where(F.col("batch") == batch)
                    tasks = tasks or rows.rdd.getNumPartitions()
                    gradient = self._gradient_sum(rows, w, tasks) / (self.batch_size or self.n_rows)
                    w = finite(w - self.rate(epoch) * gradient, epoch)
            finally:
                if held is not None:
                    held.unpersist()
            self._timed(epoch, "gradient", started)
        return w

    def _gradient_sum(self, rows: DataFrame, w: np.ndarray, tasks: int) -> np.ndarray:
        """Sum of the row gradients: each task adds up its rows; the few partial sums meet on the driver or in a shuffle."""
        n = self.n_features
        numbers = rows.select("features", F.col("label").cast("double").alias("label"))
        parts = numbers.mapInArrow(_partial_gradient(w, n), "part array<double>")
        if tasks * n * 8 <= DRIVER_BYTES:
            return np.sum([p.values.to_numpy() for p in parts.toArrow().column("part")], axis=0, initial=0.0)
        return np.array(parts.agg(V.vector_sum(F.col("part"))).first()[0])


def _partial_gradient(w: np.ndarray, n: int):
    def sums(tables):
        import numpy as np
        import pyarrow as pa

        held = np.zeros(n)
        for table in tables:
            if table.num_rows:
                entries = table.column("features").flatten()
                refuse_nulls(entries, table.column("label"))
                flat = entries.to_numpy(zero_copy_only=False)
                if flat.size != table.num_rows * n:
                    raise ValueError(f"every row must hold {n} features")
                x = flat.reshape(table.num_rows, n)
                held += (x @ w - table.column("label").to_numpy(zero_copy_only=False)) @ x
        yield pa.RecordBatch.from_arrays([pa.array([held], type=pa.list_(pa.float64()))], names=["part"])

    return sums


def finite(w: np.ndarray, epoch: int) -> np.ndarray:
    if not np.isfinite(w).all():
        raise FloatingPointError(f"the weights left the range of numbers in epoch {epoch}; use a smaller learning rate")
    return w
