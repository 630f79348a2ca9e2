"""What the operators of this subpackage share: picking columns, reading tables, and walking texts batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """The columns ``names``, and ``renamed`` ones as new name = old name; nothing else.

    A column is found by its exact spelling first, so further columns that differ in case only, or repeat a name, do no harm.
    """
    places = {f"c{i}": name for i, name in enumerate(df.columns)}

    def place(name: str) -> str:
        found = [c for c, n in places.items() if n == name] or [c for c, n in places.items() if n.lower() == name.lower()]
        if not found:
            raise ValueError(f"no column {name} among {df.columns}")
        return found[0]

    wanted = {name: name for name in names} | renamed
    return df.toDF(*places).select(*(F.col(place(old)).alias(new) for new, old in wanted.items()))


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``function`` to every Arrow batch; tasks keep one batch in memory at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose sizes add up to ``most``; a larger single item stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


#: Bytes of text that a task takes apart at a time; a longer single text stands alone.
PART_BYTES = 4 << 20


def parts(batches: Iterator[pa.RecordBatch], *places: int, most: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, by the bytes in the binary columns ``places``: what a task builds from texts is many times their size."""
    for batch in batches:
        sizes = [0] * batch.num_rows
        for place in places:
            sizes = [a + (b or 0) for a, b in zip(sizes, pc.binary_length(batch.column(place)).to_pylist(), strict=True)]
        for start, end in slices(sizes, most):
            yield batch.slice(start, end - start)


#: For DuckDB: ``crc_table``, the 256 steps of crc32 for one byte, made from the polynomial.
CRC32_SQL = """
crc_table AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i)))"""


def crc32_sql(source: str, key: str) -> str:
    """For DuckDB: the rows of ``source`` with ``h``, the crc32 of the text ``key`` in UTF-8; ``CRC32_SQL`` comes before it."""
    return f"""
  SELECT * EXCLUDE (hexes, t), xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(hexes), 2), lambda i: ('0x' || substr(hexes, i, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295::BIGINT) AS h
  FROM (SELECT *, hex(encode({key})) AS hexes FROM {source}) CROSS JOIN crc_table"""
