"""Plans that must hold at scale."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from gradlake.operators import linear, matrix, ordering
from gradlake.plans import moments

W = [1.0, 2.0, 3.0]


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "examples")
    rows = spark.range(5000).select(
        F.col("id").alias("row_id"), F.array(F.lit(1.0), F.col("id") / 10, F.col("id") / 7).alias("features"), (F.col("id") * 1.0).alias("label"), F.lit("x").alias("other")
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_row_wise_operators_do_not_shuffle(stored):
    for df in (
        stored.select(linear.residual(W)),
        linear.with_gradient(stored, W),
        matrix.to_long(stored),
        matrix.row_sums(stored),
        matrix.scale_rows(stored, F.col("label")),
    ):
        assert "Exchange" not in plan(df)


def test_unused_columns_are_not_read(stored):
    text = plan(linear.mean_abs_error(stored, W))
    assert "other" not in text.split("ReadSchema")[1].splitlines()[0]
    keys = plan(ordering.with_keys(stored.select("row_id"), (1,), 42, 12).groupBy("bucket").count())
    assert "struct<row_id:bigint>" in keys


def test_aggregates_reduce_before_the_shuffle(stored):
    for df in (
        matrix.column_sums(stored, 3),
        matrix.column_sums(stored),
        linear.total_loss(stored, W),
        moments.narrow_moments(ordering.assign_batches(stored, 500), 3, ["epoch", "batch"]),
    ):
        assert "partial_" in plan(df).split("Exchange")[1] or "partial_" in plan(df)


def test_batches_need_no_sort_or_shuffle_of_the_table(stored):
    text = plan(ordering.assign_batches(stored, 500))
    assert "Window" not in text and "Sort" not in text
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    assert "lambda" not in text


def test_windows_are_partitioned(stored):
    text = plan(ordering.epoch_permutation(stored.select("row_id")))
    assert "Window" in text and "SinglePartition" not in text


def test_prefix_reaches_the_scan(stored):
    assert "LessThan(row_id,100)" in plan(ordering.prefix(stored, 100))


def test_weights_travel_without_a_join(spark, stored):
    weights = spark.createDataFrame([(W,)], "w array<double>")
    text = plan(linear.predict_with_table(stored, weights))
    assert "Subquery" in text and "Join" not in text
