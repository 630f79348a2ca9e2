"""Header-less CSV tables of numbers: feature columns first, label last."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradlake.functions import vectors as V
from gradlake.session import materialise

BYTES_PER_VALUE = 4  # the size report counts single-precision values
MEGABYTE = 1024 * 1024


def csv_schema(n_features: int) -> T.StructType:
    fields = [T.StructField(f"x{i}", T.DoubleType()) for i in range(n_features)]
    return T.StructType([*fields, T.StructField("label", T.DoubleType())])


def parsed_columns(n_features: int) -> list:
    """``features`` and ``label`` of a parsed line; an empty cell is an error and never a silent zero."""
    names = [f"x{i}" for i in range(n_features)]
    present = [F.coalesce(F.col(c), F.raise_error(F.lit(f"empty cell in column {c}")).cast("double")) for c in [*names, "label"]]
    return [F.array(*present[:-1]).alias("features"), present[-1].alias("label")]


def csv_reader(reader, n_features: int):
    """Options shared by the batch and the streaming reader. A line with another number of cells fails the job."""
    return reader.schema(csv_schema(n_features)).option("header", False).option("mode", "FAILFAST").option("columnPruning", False)


def read_examples_csv(
    spark: SparkSession, path: str, n_features: int, n_rows: int | None = None, row_ids: bool = True, store: str | None = None
) -> DataFrame:
    """Read ``examples(row_id, features, label)``; the row id is the 0-based line number over all files, in the order of their paths.

    The file has no key, so the ids are fixed by writing the parsed table once: to ``store``, or to the shared folder. ``discard`` of
    :mod:`gradlake.session` deletes that copy when the examples are no longer read. ``row_ids=False`` skips it and leaves the ids out. ``n_rows`` is
    held against the lines that are read; with ids they are counted by the pass that writes them.
    """
    lines = csv_reader(spark.read, n_features).csv(path)
    if not row_ids:
        examples = lines.select(*parsed_columns(n_features))
        if n_rows is not None:
            check_shape(examples, n_rows, n_features)
        return examples
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")]
    parsed, figures = observed(lines.select(*parsed_columns(n_features), *place))
    examples = _numbered(parsed, ["_file", "_start"], store)
    if n_rows is not None:
        check_figures(figures.get, n_rows, n_features)
    return _keep_path(examples.select("row_id", "features", "label"), examples)


def with_row_id(df: DataFrame, store: str | None = None) -> DataFrame:
    """Add dense 0-based ``row_id`` in the present order of the rows, after writing the table once (to ``store``, or to the shared folder)."""
    return _numbered(df, [], store)


def _keep_path(df: DataFrame, stored: DataFrame) -> DataFrame:
    df.written_to = stored.written_to
    return df


def _numbered(df: DataFrame, parts: list[str], store: str | None) -> DataFrame:
    """Number the rows by ``parts`` and their order inside a task.

    Every task marks its rows with increasing numbers, and the count of each part of a file gives the number its rows start at. These counts
    are added up on the executors: inside a file, inside each range of files, and over the ranges.
    """
    marked = df.withColumn("_mark", F.monotonically_increasing_id())
    if not parts:
        marked, parts = marked.withColumn("_part", F.shiftright("_mark", 33)), ["_part"]
    # one number per part keeps the join key short
    stored = materialise(marked.withColumn("_key", F.xxhash64(*parts)), "rows", store)
    counted = stored.groupBy("_key", *parts).agg(F.count("*").alias("_n"), F.min("_mark").alias("_least"))
    starts = prefix_sums(counted, parts[0], parts[1:], "_n", "_before")
    same = F.when(F.count("*") > 1, F.raise_error(F.lit("two parts of the input share a key; split the files differently")).cast("bigint"))
    shifts = starts.groupBy("_key").agg(same.otherwise(F.min(F.col("_before") - F.col("_least"))).alias("_shift"))
    numbered = stored.join(shifts, "_key").withColumn("row_id", F.col("_mark") + F.col("_shift")).drop("_key", "_mark", "_shift", *parts)
    return _keep_path(numbered, stored)


def prefix_sums(df: DataFrame, group: str, inside: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``, the sum of ``value`` over all rows before a row in the order of ``group`` and then ``inside``.

    Three levels, none of which gathers more than the rows of one group, one range of groups, or one number per range.
    """
    spark = df.sparkSession
    order = [F.col(c) for c in inside] or [F.col(group)]
    before = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(group).agg(F.sum(value).alias("_total"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = totals.repartitionByRange(ranges, group).sortWithinPartitions(group).withColumn("_range", F.spark_partition_id())
    # one pass over each range; its rows are sorted already
    kind = df.schema[group].dataType.simpleString()

    def run(tables):
        import numpy as np
        import pyarrow as pa

        so_far = 0
        for table in tables:
            if table.num_rows:
                sums = so_far + np.cumsum(table.column("_total").to_numpy())
                columns = [table.column(group), table.column("_range"), pa.array(sums - table.column("_total").to_numpy()), table.column("_total")]
                so_far = int(sums[-1])
                yield pa.RecordBatch.from_arrays(columns, ["_group", "_range", "_earlier", "_total"])

    summed = ranged.select(group, "_range", "_total").mapInArrow(run, f"_group {kind}, _range int, _earlier bigint, _total bigint").persist()
    whole = summed.groupBy("_range").agg(F.sum("_total").alias("_sum"))
    base = whole.select("_range", F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    groups = summed.join(base, "_range").select("_group", (F.col("_earlier") + F.col("_base")).alias("_first"))
    own = df.withColumn("_inside", F.coalesce(F.sum(value).over(before), F.lit(0)))
    return own.join(groups, F.col(group).eqNullSafe(F.col("_group"))).withColumn(name, F.col("_first") + F.col("_inside")).drop("_inside", "_first", "_group")


def write_examples_csv(df: DataFrame, path: str, n_features: int) -> None:
    """Write ``features`` and ``label`` as header-less CSV, one file per task. A null, and a row of another width, are errors."""
    features = F.col("features")
    cells = [V.of_width(V.required(x, "features"), features, n_features).alias(f"x{i}") for i, x in enumerate(V.entries(features, n_features))]
    df.select(*cells, V.required(F.col("label").cast("double"), "label").alias("label")).write.option("header", False).csv(path)


def shape(examples: DataFrame) -> DataFrame:
    """One row: ``n_rows, min_features, max_features``."""
    width = F.size("features")
    return examples.agg(
        F.count("*").alias("n_rows"), F.min(width).cast("bigint").alias("min_features"), F.max(width).cast("bigint").alias("max_features")
    )


def shape_figures(features: str = "features") -> list:
    """The aggregates that say what :func:`shape` and :func:`data_size_mb` say."""
    width = F.size(features)
    cells = F.coalesce(F.sum(width.cast("bigint")), F.lit(0).cast("bigint"))
    size = (cells * BYTES_PER_VALUE / F.lit(float(MEGABYTE))).alias("size_mb")
    return [F.count("*").alias("n_rows"), F.min(width).cast("bigint").alias("min_features"), F.max(width).cast("bigint").alias("max_features"), size]


def observed(examples: DataFrame) -> tuple[DataFrame, Observation]:
    """The examples, and their shape and size as whatever pass first reads all of them finds it; no scan is made for them.

    The second is an ``Observation`` whose ``get`` holds ``n_rows``, ``min_features``, ``max_features`` and ``size_mb`` after that pass.
    """
    figures = Observation()
    return examples.observe(figures, *shape_figures()), figures


def check_figures(found: dict, n_rows: int, n_features: int) -> None:
    """Raise unless the figures of :func:`observed` are ``n_rows`` rows of ``n_features`` features each."""
    if (found["n_rows"], found["min_features"], found["max_features"]) != (n_rows, n_features, n_features):
        raise ValueError(
            f"expected {n_rows} rows of {n_features} features, found {found['n_rows']} rows "
            f"of {found['min_features']} to {found['max_features']}"
        )


def check_shape(examples: DataFrame, n_rows: int, n_features: int) -> None:
    """Raise unless there are ``n_rows`` rows of ``n_features`` features each."""
    check_figures(shape(examples).first().asDict(), n_rows, n_features)


def data_size_mb(examples: DataFrame) -> DataFrame:
    """One row: size of the feature matrix in MB, at four bytes per value."""
    cells = F.sum(F.size("features").cast("bigint"))
    return examples.agg((cells * BYTES_PER_VALUE / F.lit(float(MEGABYTE))).alias("size_mb"))
