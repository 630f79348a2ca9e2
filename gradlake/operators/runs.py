"""Compare and summarise run records ``runs(param_value, codepath, ...measures...)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def one_per_setting(runs: DataFrame, measure: str, param: str) -> DataFrame:
    """``param`` and the measure, failing when a setting has more than one run.

    The check is an aggregate, so a setting that was run very often stays one row and is never paired with itself.
    """
    message = F.lit("more than one run for the same setting")
    only = F.when(F.count("*") > 1, F.raise_error(message).cast("double")).otherwise(F.max(F.col(measure).cast("double")))
    return runs.groupBy(param).agg(only.alias(measure))


def compare_runs(a: DataFrame, b: DataFrame, measure: str, param: str = "param_value", common_only: bool = False) -> DataFrame:
    """One measure of two sets of runs side by side, by parameter.

    A setting that only one side has is an error; ``common_only`` leaves such settings out instead.
    """
    left = one_per_setting(a, measure, param).select(F.col(param).alias("p"), F.col(measure).alias("x"), F.lit(True).alias("in_a"))
    right = one_per_setting(b, measure, param).select(F.col(param).alias("q"), F.col(measure).alias("y"), F.lit(True).alias("in_b"))
    names = [F.col("x").alias(f"{measure}_a"), F.col("y").alias(f"{measure}_b")]
    if common_only:
        return left.join(right, F.col("p") == F.col("q")).select(F.col("p").alias(param), *names)
    joined = left.join(right, F.col("p").eqNullSafe(F.col("q")), "full_outer")
    alone = F.col("in_a").isNull() | F.col("in_b").isNull()
    kind = a.schema[param].dataType
    setting = F.when(alone, F.raise_error(F.lit("the runs hold different settings")).cast(kind)).otherwise(F.col("p"))
    return joined.select(setting.alias(param), *names)


def compare_measures(a: DataFrame, b: DataFrame, measures: Sequence[str], param: str = "param_value", common_only: bool = False) -> DataFrame:
    """Several measures of two sets of runs side by side: ``param``, ``measure``, ``a``, ``b`` and ``speedup`` (b by a, null where a is zero).

    Each set is read once, whatever the number of measures. More than one run of a setting, and unless ``common_only`` a setting that only one set
    has, are errors.
    """

    def series(runs: DataFrame, name: str) -> DataFrame:
        twice = F.when(F.count("*") > 1, F.raise_error(F.lit("more than one run for the same setting")).cast("double"))
        rows = runs.groupBy(param).agg(*[twice.otherwise(F.max(F.col(m).cast("double"))).alias(m) for m in measures])
        return rows.unpivot([param], list(measures), "measure", name)

    left, right = series(a, "a").withColumn("_a", F.lit(True)), series(b, "b").withColumn("_b", F.lit(True))
    right = right.select(F.col(param).alias("_param"), F.col("measure").alias("_measure"), "b", "_b")
    same = F.col(param).eqNullSafe(F.col("_param")) & (F.col("measure") == F.col("_measure"))
    joined = left.join(right, same, "inner" if common_only else "full_outer")
    setting = F.col(param)
    if not common_only:
        alone = F.col("_a").isNull() | F.col("_b").isNull()
        setting = F.when(alone, F.raise_error(F.lit("the runs hold different settings")).cast(a.schema[param].dataType)).otherwise(setting)
    return joined.select(setting.alias(param), "measure", "a", "b", F.try_divide("b", "a").alias("speedup"))


def unmatched_settings(a: DataFrame, b: DataFrame, param: str = "param_value") -> DataFrame:
    """Parameter settings that only one of two sets of runs holds, with the ``side`` that has them."""
    left = a.select(param).distinct().withColumn("_a", F.lit(True))
    right = b.select(param).distinct().withColumn("_b", F.lit(True))
    joined = left.join(right, param, "full_outer")
    side = F.when(F.col("_b").isNull(), "a").when(F.col("_a").isNull(), "b")
    return joined.select(param, side.alias("side")).where(F.col("side").isNotNull())


def only_in(a: DataFrame, b: DataFrame, param: str = "param_value") -> DataFrame:
    """Parameter settings of ``a`` that ``b`` lacks."""
    return a.select(param).distinct().join(b.select(param).distinct(), param, "left_anti")


def require_same_settings(a: DataFrame, b: DataFrame, param: str = "param_value") -> None:
    """Raise when two sets of runs differ in their parameter settings."""
    missing = unmatched_settings(a, b, param).take(1)
    if missing:
        raise ValueError(f"the runs hold different settings, for example {missing[0][param]} only in {missing[0]['side']}")


def speedup(a: DataFrame, b: DataFrame, measure: str, param: str = "param_value") -> DataFrame:
    """How many times larger the measure is in ``b`` than in ``a``, by parameter."""
    both = compare_runs(a, b, measure, param)
    ratio = F.try_divide(F.col(f"{measure}_b"), F.col(f"{measure}_a"))
    return both.withColumn("speedup", ratio)


def measure_series(runs: DataFrame, measures: Sequence[str], keys: Sequence[str] = ("param_value",)) -> DataFrame:
    """Long series ``keys, measure, value``, in the order of the keys."""
    values = [F.col(m).cast("double").alias(m) for m in measures]
    long = runs.select(*keys, *values).unpivot(list(keys), list(measures), "measure", "value")
    return long.orderBy("measure", *keys)


def scaling_factor(runs: DataFrame, measure: str, param: str = "param_value", path: str = "codepath") -> DataFrame:
    """Growth of a measure and of the parameter since the smallest setting of each code path.

    The smallest setting is found by an aggregate and joined back, so a code path with many runs is never one window.
    """
    first = runs.groupBy(path).agg(F.min(F.struct(param, measure)).alias("_first"))
    joined = runs.join(first, path)
    return joined.select(
        path,
        param,
        F.try_divide(F.col(param).cast("double"), F.col(f"_first.{param}").cast("double")).alias("param_growth"),
        F.try_divide(F.col(measure).cast("double"), F.col(f"_first.{measure}").cast("double")).alias("measure_growth"),
    )


def phase_totals(metrics: DataFrame, run: str = "run_id", phase: str = "phase", millis: str = "millis") -> DataFrame:
    """Time per run and phase, each measurement counted once."""
    return metrics.groupBy(run, phase).agg(F.sum(millis).alias("total_millis"))
