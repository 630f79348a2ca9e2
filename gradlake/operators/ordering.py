"""Exact random order of a table, batch assignment and gathers, without a global sort.

Each row has a random key per epoch. The leading bits of the key split the rows into equally filled, ordered buckets, so

* the position of a row is the number of rows in earlier buckets plus its rank inside its own small bucket,
* the row that starts one of few batches is found by ranking only the buckets in which a batch starts. Every other row gets its batch
  by comparing its key with those few cut keys; the table itself is neither shuffled nor sorted for that, and
* of many batches, small against a bucket, each row takes its own from its position. Rows move once, to their buckets, and no key
  leaves the executors.

Only bucket counts and a bounded number of cut keys pass through the driver, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradlake.functions.names import natural_key
from gradlake.functions.seeded import KEY_BITS, order_key, order_words

# A task counts its own rows per bucket first, so the buckets must stay few against the rows of a task.
FEW_BITS = 12
MOST_BITS = 20
BUCKET_ROWS = 2**20  # rows that a bucket should hold at most
MAX_BUCKETS = 2**20  # buckets of all epochs measured together
MAX_BROADCAST_ENTRIES = 2**20  # buckets plus cuts, about 100 MB
MOST_CUTS = 2**16  # units of all epochs up to which rows are held against cut keys; beyond, rows are ranked
STRETCH_ROWS = 2**20  # positions of a stored order that lie in one folder
LOWEST, HIGHEST = (-1, 0), (2**KEY_BITS, 0)  # around every key and id


@dataclass(frozen=True)
class EpochOrder:
    """Number of rows in each key bucket, for each epoch."""

    seed: int
    epochs: tuple[int, ...]
    bits: int
    counts: np.ndarray  # epochs x buckets

    @property
    def rows(self) -> int:
        return int(self.counts[0].sum())

    @property
    def starts(self) -> np.ndarray:
        """Position of the first row of each bucket."""
        return np.cumsum(self.counts, axis=1) - self.counts

    def per_bucket(self) -> dict[str, np.ndarray]:
        """The keys of a table with one row per epoch and bucket."""
        buckets = self.counts.shape[1]
        return {
            "epoch": np.repeat(np.array(self.epochs, dtype=np.int32), buckets),
            "bucket": np.tile(np.arange(buckets, dtype=np.int32), len(self.epochs)),
        }

    def of(self, epochs: Sequence[int]) -> EpochOrder:
        """The part for some of the epochs."""
        lines = [self.epochs.index(e) for e in epochs]
        return EpochOrder(self.seed, tuple(epochs), self.bits, self.counts[lines])


def with_keys(df: DataFrame, epochs: Sequence[int], seed: int, bits: int, row_id: str = "row_id") -> DataFrame:
    """Repeat every row once per epoch and add its ``order_key`` and ``bucket``, the leading bits of the key."""
    wanted = F.array(*[F.lit(int(e)) for e in epochs])
    keyed = order_words(df, row_id, seed).withColumn("epoch", F.explode(wanted)).withColumn("order_key", order_key(F.col("epoch")))
    # never null, and declared so: otherwise each join on the bucket computes the key once more to filter out nulls
    leading = F.coalesce(F.shiftright("order_key", KEY_BITS - bits).cast("int"), F.lit(0))
    return keyed.withColumn("bucket", leading).drop("_high", "_low")


def default_bits(rows: int, units: int = 1) -> int:
    """Enough buckets that one holds at most some million rows, and few cuts where rows are held against cuts."""
    bits = max(FEW_BITS, min(MOST_BITS, (max(rows, 1) - 1).bit_length() - BUCKET_ROWS.bit_length() + 1))
    return max(bits, min(MOST_BITS - 2, units.bit_length() + 2)) if units <= MOST_CUTS else bits


def epochs_per_pass(bits: int = FEW_BITS) -> int:
    """How many epochs may be measured in one pass."""
    return max(1, MAX_BUCKETS // 2**bits)


def measure_order(
    df: DataFrame, epochs: Sequence[int], seed: int = 42, row_id: str = "row_id", bits: int | None = None
) -> EpochOrder:
    """Count the rows of each bucket. Reads the id column only.

    First few buckets are counted; only where one of them holds more rows than ``BUCKET_ROWS`` each is split further. Epochs whose buckets are
    too many for one pass are counted in several, ``epochs_per_pass`` at a time.
    """
    epochs = tuple(int(e) for e in epochs)
    if not epochs:
        raise ValueError("at least one epoch is needed")
    used = bits or FEW_BITS
    at_once = epochs_per_pass(used)
    if len(epochs) > at_once:
        parts = [measure_order(df, epochs[i : i + at_once], seed, row_id, used) for i in range(0, len(epochs), at_once)]
        order = EpochOrder(seed, epochs, used, np.concatenate([p.counts for p in parts]))
        if bits is None and default_bits(order.rows) > used:
            return measure_order(df, epochs, seed, row_id, default_bits(order.rows))
        return order
    counted = with_keys(df.select(row_id), epochs, seed, used, row_id).groupBy("epoch", "bucket").agg(F.count("*").alias("n"))
    found = counted.toArrow()
    counts = np.zeros((len(epochs), 2**used), dtype=np.int64)
    line = np.zeros(max(epochs) + 1, dtype=np.int64)
    line[list(epochs)] = np.arange(len(epochs))
    counts[line[found.column("epoch").to_numpy()], found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    order = EpochOrder(seed, epochs, used, counts)
    if bits is None and default_bits(order.rows) > used:
        return measure_order(df, epochs, seed, row_id, default_bits(order.rows))
    _check_fill(order)
    return order


def _check_fill(order: EpochOrder) -> None:
    """Distinct ids fill the buckets evenly, so an over-full bucket proves that ids repeat."""
    expected = order.rows / order.counts.shape[1]
    if order.counts.max(initial=0) > expected + 12 * np.sqrt(expected) + 40:
        raise ValueError("row ids repeat: a random order needs one id per row (see with_row_id)")


def _lookup(spark: SparkSession, columns: dict, types: dict[str, pa.DataType]) -> DataFrame:
    kinds = {"epoch": pa.int32(), "bucket": pa.int32()} | types
    return spark.createDataFrame(pa.table({name: pa.array(values, type=kinds[name]) for name, values in columns.items()}))


def _attach(df: DataFrame, lookup: DataFrame, entries: int) -> DataFrame:
    """Join the per-bucket table: broadcast while it is small, otherwise an ordinary equi-join on evenly filled buckets."""
    side = F.broadcast(lookup) if entries <= MAX_BROADCAST_ENTRIES else lookup
    return df.join(side, ["epoch", "bucket"])


def epoch_permutation(
    df: DataFrame, epochs: Sequence[int] = (1,), seed: int = 42, row_id: str = "row_id", order: EpochOrder | None = None, keep_key: bool = False
) -> DataFrame:
    """Uniform random permutation of all rows for each epoch: ``df`` plus ``epoch`` and ``pos`` (0-based); with ``keep_key`` also ``order_key``."""
    order = order or measure_order(df, epochs, seed, row_id)
    starts = order.starts.ravel()
    lookup = _lookup(df.sparkSession, order.per_bucket() | {"first_pos": starts}, {"first_pos": pa.int64()})
    keyed = _attach(with_keys(df, order.epochs, order.seed, order.bits, row_id), lookup, len(starts))
    return keyed.withColumn("pos", F.col("first_pos") + _rank(row_id)).drop(*["order_key"] * (not keep_key), "bucket", "first_pos")


def _rank(row_id: str) -> Column:
    """0-based rank of a row inside its bucket; equal neighbours are an error."""
    inside = Window.partitionBy("epoch", "bucket").orderBy("order_key", row_id)
    repeated = F.lag(row_id).over(inside) == F.col(row_id)
    rank = F.row_number().over(inside).cast("bigint") - 1
    return F.when(repeated, F.raise_error(F.lit("row ids repeat")).cast("bigint")).otherwise(rank)


def _cuts(order: EpochOrder, unit_rows: int, end: int) -> dict[tuple[int, int], list[int]]:
    """``(epoch, bucket)`` -> ranks inside the bucket at which a unit (or the skipped tail) starts."""
    cuts: dict[tuple[int, int], list[int]] = {}
    for epoch, counts, starts in zip(order.epochs, order.counts, order.starts):
        positions = np.append(np.arange(unit_rows, end, unit_rows, dtype=np.int64), end)
        positions = positions[positions < order.rows]
        filled = np.flatnonzero(counts)
        buckets = filled[np.searchsorted(starts[filled], positions, side="right") - 1]
        ranks = positions - starts[buckets]
        for bucket, rank in zip(buckets[ranks > 0].tolist(), ranks[ranks > 0].tolist()):
            cuts.setdefault((epoch, bucket), []).append(rank)
    return cuts


def _cut_keys(df: DataFrame, order: EpochOrder, cuts: dict[tuple[int, int], list[int]], row_id: str) -> dict[tuple[int, int], list]:
    """Key and id of the rows at the given ranks. Ranks only the buckets that hold a cut, and reads the id column only."""
    if not cuts:
        return {}
    lookup = _lookup(
        df.sparkSession,
        {"epoch": [e for e, _ in cuts], "bucket": [b for _, b in cuts], "ranks": list(cuts.values())},
        {"ranks": pa.list_(pa.int64())},
    )
    entries = len(cuts) + sum(len(ranks) for ranks in cuts.values())
    keyed = _attach(with_keys(df.select(row_id), order.epochs, order.seed, order.bits, row_id), lookup, entries)
    ranked = keyed.withColumn("rank", _rank(row_id)).where(F.array_contains("ranks", F.col("rank")))
    found = ranked.select("epoch", "bucket", "order_key", row_id).toArrow()
    keys: dict[tuple[int, int], list] = {}
    for e, b, k, r in zip(*[c.to_pylist() for c in found.columns]):
        keys.setdefault((e, b), []).append((k, r))
    return {place: sorted(ks) for place, ks in keys.items()}


def assign_units(
    df: DataFrame, order: EpochOrder, unit_rows: int, end: int, row_id: str = "row_id", unit: str = "batch", keep_key: bool = False, ranked: bool | None = None
) -> DataFrame:
    """Cut the first ``end`` rows of the random order into consecutive units of ``unit_rows`` rows.

    Adds ``epoch`` and the unit number, and with ``keep_key`` the ``order_key``; leaves out the rows after position ``end``.
    """
    units = -(-end // unit_rows)
    if units * len(order.epochs) > MOST_CUTS if ranked is None else ranked:
        ranked = epoch_permutation(df, row_id=row_id, order=order, keep_key=keep_key).where(F.col("pos") < end)
        return ranked.withColumn(unit, F.call_function("div", F.col("pos"), F.lit(unit_rows).cast("bigint"))).drop("pos")
    keys = _cut_keys(df, order, _cuts(order, unit_rows, end), row_id)
    firsts = np.where(order.starts < end, order.starts // unit_rows, units).ravel()
    wanted = ((order.counts.ravel() > 0) & (firsts < units)).nonzero()[0]
    # a bucket with cuts has one line per interval between them: low <= (key, id) < high
    lines = order.per_bucket() | {"unit": firsts}
    lines = {name: values[wanted].tolist() for name, values in lines.items()} | {
        "low": [LOWEST] * len(wanted),
        "high": [HIGHEST] * len(wanted),
    }
    if keys:
        at = {place: i for i, place in enumerate(zip(lines["epoch"], lines["bucket"]))}
        for (epoch, bucket), found in keys.items():
            i = at[epoch, bucket]
            lines["high"][i] = found[0]
            first = lines["unit"][i]
            for k, (low, high) in enumerate(zip(found, [*found[1:], HIGHEST]), 1):
                if first + k < units:
                    for name, value in zip(lines, (epoch, bucket, first + k, low, high)):
                        lines[name].append(value)
    low, high = lines.pop("low"), lines.pop("high")
    lines |= {"low_key": [k for k, _ in low], "low_id": [r for _, r in low]}
    lines |= {"high_key": [k for k, _ in high], "high_id": [r for _, r in high]}
    lookup = _lookup(df.sparkSession, lines, dict.fromkeys(lines, pa.int64()) | {"epoch": pa.int32(), "bucket": pa.int32()})
    keyed = with_keys(df, order.epochs, order.seed, order.bits, row_id)
    placed = _attach(keyed, lookup.withColumnRenamed("unit", unit), len(lines["unit"]))
    key, r = F.col("order_key"), F.col(row_id)
    after_low = (key > F.col("low_key")) | ((key == F.col("low_key")) & (r >= F.col("low_id")))
    before_high = (key < F.col("high_key")) | ((key == F.col("high_key")) & (r < F.col("high_id")))
    return placed.where(after_low & before_high).drop(*["order_key"] * (not keep_key), "bucket", "low_key", "low_id", "high_key", "high_id")


def assign_runs(df: DataFrame, order: EpochOrder, rows: int, end: int, row_id: str = "row_id") -> DataFrame:
    """Split the random order into consecutive runs of whole buckets, of about ``rows`` rows each.

    Adds ``epoch``, ``order_key``, the number of the run as ``block`` and the position of its first row as ``first_pos``.
    Buckets that start at or after position ``end`` are left out. Nothing is ranked and no key passes through the driver.
    """
    starts = order.starts
    blocks = starts // rows
    # a run starts at its first bucket
    opens = np.concatenate([np.ones((len(starts), 1), dtype=bool), blocks[:, 1:] != blocks[:, :-1]], axis=1)
    first = np.maximum.accumulate(np.where(opens, starts, 0), axis=1)
    wanted = ((starts < end) & (order.counts > 0)).ravel()
    columns = order.per_bucket() | {"block": blocks.ravel(), "first_pos": first.ravel()}
    lookup = _lookup(df.sparkSession, {k: v[wanted] for k, v in columns.items()}, {"block": pa.int64(), "first_pos": pa.int64()})
    keyed = with_keys(df, order.epochs, order.seed, order.bits, row_id)
    return _attach(keyed, lookup, int(wanted.sum())).drop("bucket")


def number_of_batches(rows: int, batch_size: int) -> int:
    """Full batches in ``rows`` rows; the remainder of an epoch is skipped."""
    if batch_size < 0:
        raise ValueError("the batch size must not be negative")
    if batch_size == 0:
        return 1
    if batch_size > rows:
        raise ValueError(f"batch size {batch_size} is larger than the {rows} rows of the data set")
    return rows // batch_size


def assign_batches(
    df: DataFrame,
    batch_size: int,
    epochs: Sequence[int] = (1,),
    seed: int = 42,
    row_id: str = "row_id",
    order: EpochOrder | None = None,
    ranked: bool | None = None,
) -> DataFrame:
    """Random batches of exactly ``batch_size`` rows per epoch; 0 means one batch of all rows.

    ``ranked`` says whether rows move to their buckets and take their batch from their position, or stay and are held against cut keys; by
    default that depends on the number of batches.
    """
    if batch_size == 0:
        wanted = F.array(*[F.lit(int(e)) for e in epochs])
        return df.withColumn("epoch", F.explode(wanted)).withColumn("batch", F.lit(0).cast("bigint"))
    order = order or measure_order(df, epochs, seed, row_id)
    batches = number_of_batches(order.rows, batch_size)
    return assign_units(df, order, batch_size, batches * batch_size, row_id, ranked=ranked)


def permute(examples: DataFrame, order: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Gather: row ``pos`` of the result is the row of ``examples`` that ``order(pos, row_id)`` names."""
    return order.join(examples, row_id)


def batch_rows(examples: DataFrame, order: DataFrame, batch_size: int, batch: int, row_id: str = "row_id") -> DataFrame:
    """The examples of one batch of a given order, with their ``slot`` in the batch."""
    first = batch * batch_size
    chosen = order.where(F.col("pos").between(first, first + batch_size - 1))
    return permute(examples, chosen.withColumn("slot", F.col("pos") - first), row_id)


@dataclass(frozen=True)
class StoredOrder:
    """An order ``(epoch, pos, row_id)`` on disk, one folder for each epoch and stretch of ``stretch_rows`` positions."""

    spark: SparkSession
    path: str
    stretch_rows: int

    def between(self, first: int, last: int, epoch: int = 1) -> DataFrame:
        """``pos`` and ``row_id`` of the positions from ``first`` to ``last``; reads the stretches that hold them and no other."""
        n = self.stretch_rows
        table = self.spark.read.schema("pos bigint, row_id bigint, epoch int, stretch bigint").parquet(self.path)
        held = table.where((F.col("epoch") == epoch) & F.col("stretch").between(first // n, last // n))
        return held.where(F.col("pos").between(first, last)).select("pos", "row_id")


def store_order(order: DataFrame, path: str, stretch_rows: int = STRETCH_ROWS, row_id: str = "row_id") -> StoredOrder:
    """Write ``order(epoch, pos, row id)`` so that a batch is found without ranking or scanning the whole table again.

    A stretch is sorted by position in one task; ``stretch_rows`` bounds it.
    """
    if stretch_rows < 1:
        raise ValueError("a stretch holds at least one row")
    stretch = F.call_function("div", F.col("pos"), F.lit(stretch_rows).cast("bigint")).alias("stretch")
    rows = order.select("pos", F.col(row_id).cast("bigint").alias("row_id"), F.col("epoch").cast("int").alias("epoch"), stretch)
    rows.repartition("epoch", "stretch").sortWithinPartitions("epoch", "stretch", "pos").write.partitionBy("epoch", "stretch").parquet(path)
    return StoredOrder(order.sparkSession, path, stretch_rows)


def stored_batch(examples: DataFrame, stored: StoredOrder, batch_size: int, batch: int, epoch: int = 1, row_id: str = "row_id") -> DataFrame:
    """The examples of one batch of a stored order, with their ``pos`` and their ``slot`` in the batch."""
    first = batch * batch_size
    chosen = stored.between(first, first + batch_size - 1, epoch).withColumnRenamed("row_id", row_id)
    return permute(examples, chosen.withColumn("slot", F.col("pos") - first), row_id)


def prefix(df: DataFrame, rows: int, row_id: str = "row_id") -> DataFrame:
    """The first ``rows`` rows of a table with dense ids."""
    return df.where(F.col(row_id) < rows)


def natural_order(df: DataFrame, name: str, *ties: str) -> DataFrame:
    """Sort names as people expect, numbers by value and text as text (a range-partitioned sort).

    ``ties`` orders rows of the same name and lets the sort split a name that very many rows share.
    """
    return df.orderBy(natural_key(F.col(name)), F.col(name), *ties)
