"""Training: every strategy equals the plain sequential loop."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradlake.functions import seeded
from gradlake.plans import fit as P
from gradlake.plans import maps, moments, steps
from gradlake.plans import sweep as S
from gradlake.plans.sweep import sweep
from gradlake.sources.runs import read_runs
from tests.test_ordering import expected_order

RNG = np.random.default_rng(7)


def data(n, c):
    x = RNG.normal(size=(n, c))
    return x, x @ np.arange(1, c + 1) + 0.1 * RNG.normal(size=n)


def reference_loop(x, y, lr, epochs, b, shuffle=True, decay=0.25, w=None):
    """Batches one after another, rows in MD5 order."""
    n, c = x.shape
    w = np.zeros(c) if w is None else np.asarray(w, dtype=float)
    size = b or n
    for epoch in range(1, epochs + 1):
        order = expected_order(range(n), epoch) if shuffle and b else list(range(n))
        for k in range(n // size):
            rows = order[k * size : (k + 1) * size]
            w = w - lr / epoch**decay / size * (x[rows].T @ (x[rows] @ w - y[rows]))
    return w


@pytest.mark.parametrize("strategy", ["auto", "fold", "blocks", "steps", "loop"])
@pytest.mark.parametrize(("c", "b"), [(3, 90), (3, 0), (20, 75), (20, 0)])
def test_strategies_agree_with_the_loop(examples, strategy, c, b):
    x, y = data(400, c)
    found = P.fit(examples(x, y), 0.1, 2, b, w0=[0.0] * c, strategy=strategy)
    assert found.num_batches == (400 // b if b else 1)
    np.testing.assert_allclose(found.weights, reference_loop(x, y, 0.1, 2, b), rtol=1e-9, atol=1e-11)


@pytest.mark.parametrize("strategy", ["fold", "blocks", "steps", "loop"])
@pytest.mark.parametrize("b", [100, 300])
def test_row_order_and_skipped_tail(examples, strategy, b):
    x, y = data(700, 3)
    found = P.fit(examples(x, y), 0.1, 3, b, w0=[0.0] * 3, shuffle=False, strategy=strategy)
    np.testing.assert_allclose(found.weights, reference_loop(x, y, 0.1, 3, b, shuffle=False), rtol=1e-9)


def test_blocks_of_a_few_batches_and_tree(examples, monkeypatch):
    """Small limits force several blocks, a short last block and several levels of composition."""
    x, y = data(1000, 5)
    monkeypatch.setattr(P, "BLOCK_BYTES", 3 * 20 * 6 * 8)
    monkeypatch.setattr(P, "DRIVER_BYTES", 4 * 36 * 8)
    monkeypatch.setattr(maps, "GROUP_BYTES", 4 * 36 * 8)
    for b in (20, 33, 55, 150):
        for shuffle in (True, False):
            found = P.fit(examples(x, y), 0.1, 2, b, w0=[0.0] * 5, strategy="blocks", shuffle=shuffle)
            np.testing.assert_allclose(found.weights, reference_loop(x, y, 0.1, 2, b, shuffle), rtol=1e-9)


@pytest.mark.parametrize(("b", "shuffle", "stored"), [(33, True, 1), (55, True, 2**30), (150, True, 2**30), (33, False, 2**30)])
def test_steps_over_several_blocks(examples, monkeypatch, b, shuffle, stored):
    """Blocks of 90 rows: batches go on in the next block, the last block is short, epochs are laid down one or several at a time."""
    x, y = data(400, 5)
    monkeypatch.setattr(P, "BLOCK_BYTES", 90 * 6 * 8)
    monkeypatch.setattr(P, "WHOLE_BYTES", 0)
    monkeypatch.setattr(steps, "CHUNK_BYTES", 7 * 5 * 8)
    monkeypatch.setattr(P, "STORED_BYTES", stored)
    found = P.fit(examples(x, y), 0.1, 2, b, w0=[0.0] * 5, strategy="steps", shuffle=shuffle)
    np.testing.assert_allclose(found.weights, reference_loop(x, y, 0.1, 2, b, shuffle), rtol=1e-9)


@pytest.mark.parametrize(("b", "gram", "shuffle"), [(5, 12, True), (5, 30, False), (7, 16, True)])
def test_steps_over_slices_of_columns(examples, monkeypatch, b, gram, shuffle):
    """A batch is larger than a block, so blocks of several batches are cut by columns and stepped over by their Gram matrix."""
    x, y = data(53, 40)
    monkeypatch.setattr(P, "BLOCK_BYTES", b * 15 * 8)
    monkeypatch.setattr(P, "WHOLE_BYTES", 0)
    monkeypatch.setattr(P, "GRAM_ROWS", gram)
    monkeypatch.setattr(steps, "CHUNK_BYTES", 3 * 15 * 8)
    monkeypatch.setattr(P, "STORED_BYTES", 1 if gram == 12 else 2**30)
    found = P.fit(examples(x, y), 0.02, 2, b, w0=[0.0] * 40, strategy="steps", shuffle=shuffle)
    np.testing.assert_allclose(found.weights, reference_loop(x, y, 0.02, 2, b, shuffle), rtol=1e-9)


def test_epoch_keys_equal_the_columns(spark):
    rows = seeded.order_words(spark.range(500).withColumnRenamed("id", "row_id"), "row_id", 42)
    for epoch in (1, 2, 77, 10**6):
        found = rows.select("_high", "_low", seeded.order_key(F.lit(epoch)).alias("k")).toPandas()
        assert (steps.epoch_keys(found["_high"].to_numpy(), found["_low"].to_numpy(), epoch) == found["k"].to_numpy()).all()


def test_residuals_of_a_block_equal_its_batches():
    x, y = data(40, 6)
    w, step, b = np.ones(6), 0.01, 8
    want, at = [], w
    for k in range(0, 40, b):
        want.append(x[k : k + b] @ at - y[k : k + b])
        at = at - step * want[-1] @ x[k : k + b]
    found = steps.residuals(x @ w - y, x @ x.T, b, step)
    np.testing.assert_allclose(found, np.concatenate(want), rtol=1e-9)
    np.testing.assert_allclose(w - step * found @ x, at, rtol=1e-9)


def test_loop_sums_in_a_shuffle_when_the_tasks_are_many(examples, monkeypatch):
    x, y = data(200, 4)
    monkeypatch.setattr(P, "DRIVER_BYTES", 0)
    found = P.fit(examples(x, y), 0.1, 1, 50, w0=[0.0] * 4, strategy="loop")
    np.testing.assert_allclose(found.weights, reference_loop(x, y, 0.1, 1, 50), rtol=1e-9)


def test_one_epoch_at_a_time(examples, monkeypatch):
    x, y = data(300, 3)
    want = reference_loop(x, y, 0.1, 3, 50)
    monkeypatch.setattr(P, "DRIVER_BYTES", P._moment_bytes(6, 3))
    monkeypatch.setattr(P, "SHUFFLED_BYTES", 1)
    for strategy in ("fold", "blocks"):
        found = P.fit(examples(x, y), 0.1, 3, 50, w0=[0.0] * 3, strategy=strategy)
        np.testing.assert_allclose(found.weights, want, rtol=1e-9)


def test_large_tables_are_not_held(examples, monkeypatch):
    x, y = data(300, 3)
    monkeypatch.setattr(P, "SMALL_BYTES", 0)
    found = P.fit(examples(x, y), 0.1, 2, 50, w0=[0.0] * 3)
    np.testing.assert_allclose(found.weights, reference_loop(x, y, 0.1, 2, 50), rtol=1e-9)


def test_partial_sums_are_handed_on_when_full(examples, monkeypatch):
    x, y = data(400, 20)
    monkeypatch.setattr(moments, "PARTIAL_BYTES", 2 * 21 * 21 * 8)
    found = P.fit(examples(x, y), 0.1, 1, 50, w0=[0.0] * 20, strategy="fold")
    np.testing.assert_allclose(found.weights, reference_loop(x, y, 0.1, 1, 50), rtol=1e-9)


@pytest.mark.parametrize("pieces", [1, 3, 40])
def test_moments_of_pieces_equal_those_of_tasks(examples, monkeypatch, pieces):
    x, y = data(900, 5)
    rows = examples(x, y).selectExpr("*", "1 AS epoch", "row_id % 3 AS batch")
    monkeypatch.setattr(moments, "FAN_IN", 4)
    monkeypatch.setattr(moments, "ROWS_PER_PART", 300 / pieces / 6)
    want = {(r["batch"], r["i"]): r["part"] for r in moments.wide_moments(rows, 5, ["epoch", "batch"]).collect()}
    for found in (moments.moments_by_rows(rows, 5, ["epoch", "batch"], 300), moments.wide_moments(rows.repartition(20), 5, ["epoch", "batch"], 20)):
        found = {(r["batch"], r["i"]): r["part"] for r in found.collect()}
        assert found.keys() == want.keys() and len(found) == 18
        for key, part in found.items():
            np.testing.assert_allclose(part, want[key], rtol=1e-9)


def test_pieces_hand_on_little_more_than_the_rows(examples):
    """Rows once, and triangles of an eighth of them; a triangle from every task would be many times the rows."""
    n, c = 4000, 30
    x, y = data(n, c)
    seen = []
    rows = examples(x, y).selectExpr("*", "1 AS epoch", "row_id % 4 AS batch")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(moments, "tree_sum", lambda parts, keys, count: seen.append((parts, count)) or parts)
        moments.moments_by_rows(rows, c, ["epoch", "batch"], n // 4)
    ((parts, count),) = seen
    numbers = parts.selectExpr("sum(size(part))").first()[0]
    assert count == n // 4 // (4 * (c + 1)) and numbers <= 0.2 * n * (c + 1)
    assert not P._Run(None, c, 0.1, 1, n // 4, 0.25, 42, True, None).sums_by_task(1000)


@pytest.mark.parametrize("by_task", [True, False])
def test_wide_fold_both_ways(examples, monkeypatch, by_task):
    x, y = data(400, 20)
    monkeypatch.setattr(P._Run, "sums_by_task", lambda self, tasks: by_task)
    found = P.fit(examples(x, y), 0.1, 2, 150, w0=[0.0] * 20, strategy="fold")
    np.testing.assert_allclose(found.weights, reference_loop(x, y, 0.1, 2, 150), rtol=1e-9)


def test_decay_and_start(examples):
    x, y = data(200, 2)
    found = P.fit(examples(x, y), 0.2, 3, 50, w0=[1.0, -1.0], decay_power=0.5)
    np.testing.assert_allclose(found.weights, reference_loop(x, y, 0.2, 3, 50, decay=0.5, w=[1, -1]), rtol=1e-9)
    start = P.initial_weights(50, seed=3)
    assert start == P.initial_weights(50, seed=3) and start != P.initial_weights(50, seed=4)
    assert 0 <= min(start) and max(start) < 0.01


@pytest.mark.parametrize(
    ("n", "c", "b", "strategy"),
    [
        (10**7, 4, 1000, "fold"),
        (10**12, 4, 10**9, "fold"),
        (10**12, 4, 1000, "blocks"),
        (10**9, 100, 1000, "blocks"),
        (10**9, 100, 10**6, "fold"),
        (10**9, 5000, 1000, "steps"),
        (10**9, 10**6, 100, "steps"),
        (10**9, 10**6, 10**4, "loop"),
        (10**9, 1000, 0, "fold"),
        (10**9, 5000, 0, "loop"),
        (10**4, 200, 1000, "steps"),
        (10**6, 4, 1, "blocks"),
    ],
)
def test_choice_of_strategy(n, c, b, strategy):
    assert P.choose_strategy(n, c, b, 10) == strategy


def test_errors(examples):
    x, y = data(20, 2)
    rows = examples(x, y)
    with pytest.raises(ValueError, match="larger than"):
        P.fit(rows, 0.1, 1, 21)
    with pytest.raises(ValueError, match="initial weights"):
        P.fit(rows, 0.1, 1, 5, w0=[0.0])
    with pytest.raises(ValueError, match="strategy"):
        P.fit(rows, 0.1, 1, 5, strategy="other")
    with pytest.raises(ValueError, match="empty"):
        P.fit(rows.where("row_id < 0"), 0.1, 1, 5, n_features=2)
    with pytest.raises(FloatingPointError, match="epoch"):
        P.fit(rows, 1e200, 5, 5)
    with pytest.raises(ValueError, match="dense"):
        P.fit(rows.where("row_id > 3"), 0.1, 1, 5, shuffle=False)


@pytest.mark.parametrize(("c", "strategy"), [(2, "fold"), (20, "fold"), (20, "blocks"), (2, "blocks"), (2, "steps"), (20, "auto")])
def test_ragged_rows_fail(spark, c, strategy):
    rows = [(i, [1.0] * (c + (i == 7)), 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "row_id bigint, features array<double>, label double")
    with pytest.raises(Exception, match="features"):
        P.fit(df, 0.1, 1, 10, n_features=c, strategy=strategy)


@pytest.mark.parametrize("strategy", ["fold", "blocks", "steps"])
def test_repeated_ids_fail(examples, strategy):
    x, y = data(100, 2)
    rows = examples(x, y)
    with pytest.raises(Exception, match="row ids repeat"):
        P.fit(rows.union(rows), 0.1, 1, 3, strategy=strategy)


@pytest.mark.parametrize(("c", "b", "strategy"), [(2, 5, "fold"), (2, 5, "blocks"), (2, 5, "loop"), (2, 5, "steps"), (2, 0, "auto"), (20, 5, "fold"), (20, 0, "auto")])
def test_nulls_fail_in_every_strategy(spark, c, b, strategy):
    for bad in (([1.0] * c, None), ([1.0] * (c - 1) + [None], 1.0)):
        rows = [(i, [float(i)] * c, 1.0) for i in range(19)] + [(19, *bad)]
        with pytest.raises(Exception, match="label and features must not be null"):
            P.fit(spark.createDataFrame(rows, "row_id bigint, features array<double>, label double"), 1e-4, 1, b, strategy=strategy)


def test_run_record_counts_each_phase_once(spark, examples):
    x, y = data(200, 2)
    result, error = P.fit_and_score(examples(x, y), 0.1, 2, 50)
    record = P.run_record(result, error, 12.0)
    assert record["transfer_time"] == 12.0 + result.millis("transfer") > 12.0 and record["error"] == error
    assert record["shuffle_time"] + record["total_gradient_time"] <= record["gpu_time"]
    metrics = P.phase_metrics(spark, {"a": result})
    assert {r["phase"] for r in metrics.collect()} == {"transfer", "shuffle", "gradient", "total"}
    table = {r["feature_idx"]: r["w"] for r in P.weights_table(spark, result.weights).collect()}
    assert [table[j] for j in range(2)] == result.weights


def test_batch_sweep_equals_single_fits(examples):
    x, y = data(300, 3)
    rows = examples(x, y)
    found = {r["param_value"]: r["error"] for r in sweep(rows, "batch", [0, 50, 100], lr=0.1, epochs=2).collect()}
    for b, error in found.items():
        assert P.fit_and_score(rows, 0.1, 2, b)[1] == pytest.approx(error, rel=1e-9)


def test_sample_and_feature_sweeps(examples):
    x, y = data(300, 3)
    rows = examples(x, y)
    by_rows = sweep(lambda n: rows.where(f"row_id < {n}"), "samples", [100, 300], lr=0.1, epochs=1, batch_size=50).collect()
    assert [r["param_value"] for r in by_rows] == [100, 300]
    by_width = sweep(lambda c: examples(x[:, :c], y), "features", [1, 3], lr=0.1, epochs=1, batch_size=50).collect()
    assert by_width[0]["error"] > by_width[1]["error"]


@pytest.mark.parametrize(
    ("data_set", "param", "size"), [(None, "samples", 5), (None, "samples", None), (None, "features", None), (None, "batch", 10), (None, "other", 1)]
)
def test_sweep_arguments(data_set, param, size):
    with pytest.raises(ValueError):
        sweep(data_set, param, [1], batch_size=size)
    with pytest.raises(ValueError):
        sweep(data_set, "batch", [])


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 5), st.integers(1, 6), st.integers(0, 2**32 - 1))
def test_composed_maps_equal_steps(c, n, seed):
    rng = np.random.default_rng(seed)
    w = rng.normal(size=c)
    run, slow = np.eye(c + 1), w
    for _ in range(n):
        x, y = rng.normal(size=(8, c)), rng.normal(size=8)
        one = np.eye(c + 1)
        one[:c, :c] -= 0.01 * x.T @ x
        one[:c, c] = 0.01 * x.T @ y
        run, slow = one @ run, slow - 0.01 * x.T @ (x @ slow - y)
    np.testing.assert_allclose(run[:c, :c] @ w + run[:c, c], slow, rtol=1e-9, atol=1e-12)


@pytest.mark.parametrize("strategy", ["auto", "fold", "blocks", "steps", "loop"])
@pytest.mark.parametrize("b", [0, 500])
def test_a_few_repeated_ids_fail_in_every_strategy(spark, strategy, b):
    """Three repeats among 20,000 rows, far fewer than a bucket would show."""
    rows = spark.range(20_000).selectExpr("IF(id IN (77, 12345, 19999), id - 7, id) AS row_id", "array(1D, id / 20000D) AS features", "2D AS label")
    with pytest.raises(Exception, match="row ids repeat"):
        P.fit(rows, 0.1, 1, b, strategy=strategy, n_features=2)


def test_sweeps_share_one_scan(examples, monkeypatch):
    """All settings in one job, with the results of single fits."""
    x, y = data(300, 5)
    rows = examples(x, y)
    jobs = []
    monkeypatch.setattr(S, "all_epochs", lambda *a, **k: jobs.append(1) or steps.all_epochs(*a, **k))
    monkeypatch.setattr(S, "fit", None)
    by_rows = sweep(rows, "samples", [100, 211, 300], lr=0.1, epochs=2, batch_size=50, w0=[0.0] * 5).collect()
    by_width = sweep(rows, "features", [1, 3, 5], lr=0.1, epochs=2, batch_size=50, w0=[0.0] * 5).collect()
    by_size = sweep(rows, "batch", [50, 75], lr=0.1, epochs=2, w0=[0.0] * 5).collect()
    assert len(jobs) == 3
    for n, r in zip((100, 211, 300), by_rows):
        w = reference_loop(x[:n], y[:n], 0.1, 2, 50)
        assert (r["param_value"], r["error"]) == (n, pytest.approx(np.abs(x[:n] @ w - y[:n]).mean(), rel=1e-9))
    for n, r in zip((1, 3, 5), by_width):
        w = reference_loop(x[:, :n], y, 0.1, 2, 50)
        assert (r["param_value"], r["error"]) == (n, pytest.approx(np.abs(x[:, :n] @ w - y).mean(), rel=1e-9))
    for b, r in zip((50, 75), by_size):
        w = reference_loop(x, y, 0.1, 2, b)
        assert r["error"] == pytest.approx(np.abs(x @ w - y).mean(), rel=1e-9) and r["transfer_time"] > 0


def test_sweeps_of_large_tables_go_one_by_one(examples, monkeypatch):
    x, y = data(300, 5)
    rows = examples(x, y)
    options = {"lr": 0.1, "epochs": 2, "w0": [0.0] * 5}
    calls = [("samples", [100, 300], 50), ("features", [2, 5], 50), ("batch", [50, 0], None)]
    monkeypatch.setattr(S, "fits_one_task", lambda *a: False)
    slow = [sweep(rows, p, v, batch_size=b, **options).collect() for p, v, b in calls]
    monkeypatch.undo()
    for (p, v, b), want in zip(calls, slow):
        found = sweep(rows, p, v, batch_size=b, **options).collect()
        assert [r["error"] for r in found] == pytest.approx([r["error"] for r in want], rel=1e-9)


def test_train_and_record(spark, examples, tmp_path):
    x, y = data(200, 2)
    for _ in range(2):
        result, error, path = P.train_and_record(examples(x, y), 0.1, 2, 50, folder=str(tmp_path), name="run", parameter=200, read_millis=5.0)
    assert path.endswith("run-200-steps.json")
    (record,) = read_runs(spark, str(tmp_path)).collect()
    assert record["error"] == error and record["param_value"] == 200 and record["transfer_time"] > 5.0
    assert record["gpu_time"] == pytest.approx(result.millis("total"))
