"""Train many settings, side by side or one after another, and collect run records."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradlake.operators import linear
from gradlake.operators.ordering import measure_order, number_of_batches, prefix
from gradlake.plans.fit import STEPS_OF_A_TASK, FitResult, finite, fit, fits_one_task, initial_weights, learning_rate, refuse_repeated_ids, run_record
from gradlake.plans.steps import Setting, all_epochs
from gradlake.sources.runs import MEASURES

PARAMETERS = ("samples", "features", "batch")
SWEEP_SCHEMA = "param_name string, param_value bigint, codepath string, " + ", ".join(f"{m} double" for m in MEASURES)


def sweep(
    data: DataFrame | Callable[[int], DataFrame],
    param: str,
    values: Sequence[int],
    *,
    lr: float = 0.01,
    epochs: int = 10,
    batch_size: int | None = None,
    seed: int = 42,
    **options,
) -> DataFrame:
    """``runs(param_name, param_value, codepath, ...measures...)`` for each value of ``samples``, ``features`` or ``batch``.

    ``data`` is one data set, of which a sweep over samples takes the rows with smaller ids and one over features the first features, or a
    function from a value to its data set. On one data set that a task can hold, all settings are trained and scored side by side, one task
    each, from a single scan. Otherwise the settings follow one another; a batch sweep then measures the random order once and scores all in one pass.
    """
    if param not in PARAMETERS:
        raise ValueError(f"the parameter must be one of {PARAMETERS}")
    if not values:
        raise ValueError("a sweep needs at least one value")
    if param == "batch":
        if batch_size is not None:
            raise ValueError("a batch sweep takes its batch sizes from the values")
        if callable(data):
            raise ValueError("a batch sweep runs on one data set")
    else:
        if batch_size is None:
            raise ValueError(f"a sweep over {param} needs a batch size")
        if data is None:
            raise ValueError(f"a sweep over {param} needs a data set, or a function from a value to one")
    values = [int(v) for v in values]
    if isinstance(data, DataFrame):
        runs = _side_by_side(data, param, values, lr, epochs, batch_size, seed, options) or _one_by_one(data, param, values, lr, epochs, batch_size, seed, options)
        spark = data.sparkSession
    else:
        runs = []
        for value in values:
            examples = data(value)
            result, ready = _timed_fit(examples, lr, epochs, batch_size, seed, options)
            runs.append((value, result, mean_abs_errors(examples, [result.weights])[0], ready))
        spark = examples.sparkSession
    lines = []
    for value, result, error, ready in runs:
        record = run_record(result, error, ready)
        lines.append((param, value, result.strategy, *[record[m] for m in MEASURES]))
    return spark.createDataFrame(lines, SWEEP_SCHEMA)


Runs = list[tuple[int, FitResult, float, float]]


def first_features(examples: DataFrame, n: int) -> DataFrame:
    """The examples with their first ``n`` features; fewer are an error."""
    enough = F.when(F.size("features") >= n, F.slice("features", 1, n)).otherwise(F.raise_error(F.lit(f"every row must hold {n} features")).cast("array<double>"))
    return examples.withColumn("features", enough)


def _side_by_side(data: DataFrame, param: str, values: list[int], lr: float, epochs: int, batch_size: int | None, seed: int, options: dict) -> Runs | None:
    """All settings in one job, or None where the table is too large for a task or the options ask for something else."""
    if options.keys() - {"w0", "decay_power", "shuffle"}:
        return None
    n_rows, width = data.agg(F.count("*"), F.max(F.size("features"))).first()
    if not n_rows:
        raise ValueError("the data set is empty")
    taken = {v: min(v, n_rows) if param == "samples" else n_rows for v in values}
    sizes = {v: v if param == "batch" else batch_size for v in values}
    if not fits_one_task(n_rows, width) or any(not sizes[v] or taken[v] // sizes[v] * epochs > STEPS_OF_A_TASK for v in values):
        return None
    start = options.get("w0")
    settings = []
    for v in values:
        n = v if param == "features" else width
        number_of_batches(taken[v], sizes[v])
        w0 = np.asarray(initial_weights(n, seed) if start is None else start[:n], dtype=np.float64)
        if n > width or w0.shape != (n,):
            raise ValueError(f"{n} features need as many in the data set and as many initial weights")
        settings.append(Setting(sizes[v], w0, v if param == "samples" else None))
    table = first_features(data, max(len(s.w0) for s in settings)) if param == "features" else data
    rates = [learning_rate(lr, e, options.get("decay_power", 0.25)) for e in range(1, epochs + 1)]
    runs: Runs = []
    for v, s, found in zip(values, settings, all_epochs(table, settings, rates, seed, options.get("shuffle", True))):
        finite(found.weights, found.epoch)
        phases = [(1, "transfer", found.read)]
        for epoch, (shuffled, stepped) in enumerate(zip(found.shuffle, found.gradient), 1):
            phases += [(epoch, "shuffle", shuffled), (epoch, "gradient", stepped)]
        phases.append((epochs, "total", sum(ms for _, name, ms in phases if name != "transfer")))
        result = FitResult(found.weights.tolist(), found.rows, len(s.w0), s.batch_size, number_of_batches(found.rows, s.batch_size), epochs, "steps", phases)
        runs.append((v, result, found.error, 0.0))
    return runs


def _one_by_one(data: DataFrame, param: str, values: list[int], lr: float, epochs: int, batch_size: int | None, seed: int, options: dict) -> Runs:
    if param != "batch":
        runs = []
        for value in values:
            examples = prefix(data, value) if param == "samples" else first_features(data, value)
            own = options | ({"w0": options["w0"][:value]} if param == "features" and options.get("w0") is not None else {})
            result, ready = _timed_fit(examples, lr, epochs, batch_size, seed, own)
            runs.append((value, result, mean_abs_errors(examples, [result.weights])[0], ready))
        return runs
    order = None
    if options.get("shuffle", True) and any(v != 0 for v in values):
        refuse_repeated_ids(data)
        order = measure_order(data, range(1, epochs + 1), seed)
    results = []
    for value in values:
        shared = order if value != 0 else None
        results.append(_timed_fit(data, lr, epochs, value, seed, options | {"order": shared}))
    errors = mean_abs_errors(data, [r.weights for r, _ in results])
    return [(v, r, e, ready) for v, (r, ready), e in zip(values, results, errors)]


def _timed_fit(examples: DataFrame, lr: float, epochs: int, batch_size: int, seed: int, options: dict) -> tuple[FitResult, float]:
    """The fit, and the milliseconds it spent before the first epoch."""
    started = time.perf_counter()
    result = fit(examples, lr, epochs, batch_size, seed=seed, **options)
    return result, 1000 * (time.perf_counter() - started) - result.millis("total")


def mean_abs_errors(examples: DataFrame, models: Sequence[Sequence[float]]) -> list[float]:
    """Mean absolute error of several weight vectors in one pass."""
    errors = [F.avg(F.abs(linear.residual(list(w)))).alias(f"e{i}") for i, w in enumerate(models)]
    return [float(e) for e in examples.agg(*errors).first()]
