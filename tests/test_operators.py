"""Vector functions, half precision, names, generation and run comparison."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradlake.functions import names
from gradlake.functions import vectors as V
from gradlake.functions.half import to_half
from gradlake.operators import generate as G
from gradlake.operators import linear, matrix
from gradlake.operators import runs as R
from gradlake.operators.ordering import assign_batches
from gradlake.plans.sweep import sweep
from gradlake.sources.examples import read_examples_csv
from gradlake.sources.runs import read_runs, write_sweep
from gradlake.sources.weights import read_weights_csv, weights_from_long

RNG = np.random.default_rng(11)


def test_half_precision_equals_numpy(spark):
    values = np.concatenate(
        [
            RNG.normal(size=400),
            np.exp(RNG.uniform(-25, 12, size=800)) * RNG.choice([-1, 1], size=800),
            [0.0, 1.0, -2.0, 65504.0, 65519.999, 65520.0, -70000.0, 2.0**-14, 2.0**-24, 2.0**-25, 2.0**-26, 2049.0, 2051.0, 0.1],
            2.0 ** np.arange(-24, 16),
        ]
    )
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    found = [r["h"] for r in df.withColumn("h", to_half(F.col("v"))).orderBy("i").collect()]
    with np.errstate(over="ignore"):
        np.testing.assert_array_equal(found, values.astype(np.float16).astype(float))


def test_vectors(examples):
    x = RNG.normal(size=(20, 30))
    df = examples(x, np.ones(20))
    w = list(RNG.normal(size=30))
    row = df.orderBy("row_id").select(
        V.dot(F.col("features"), w).alias("wide"),
        V.dot(F.slice("features", 1, 4), w[:4]).alias("narrow"),
        V.axpy(2.0, F.col("features"), F.col("features")).alias("axpy"),
        V.divide(F.col("features"), 4.0).alias("divided"),
        V.total(F.col("features")).alias("total"),
    ).first()
    assert row["wide"] == pytest.approx(x[0] @ w)
    assert row["narrow"] == pytest.approx(x[0, :4] @ w[:4])
    np.testing.assert_allclose(row["axpy"], 3 * x[0])
    np.testing.assert_allclose(row["divided"], x[0] / 4)
    assert row["total"] == pytest.approx(x[0].sum())
    with pytest.raises(ValueError):
        V.divide(F.col("features"), 0)


def test_long_form_and_back(spark, examples):
    x = RNG.normal(size=(30, 5))
    df = examples(x, np.ones(30))
    back = {r["row_id"]: r["features"] for r in matrix.from_long(matrix.to_long(df).repartition(7)).collect()}
    np.testing.assert_array_equal([back[i] for i in range(30)], x)
    ids = spark.range(20).select(
        matrix.cell_row(F.col("id"), 5).alias("r"), matrix.cell_col(F.col("id"), 5).alias("c"), "id"
    )
    assert [tuple(t) for t in ids.select("r", "c", matrix.linear_index(F.col("r"), F.col("c"), 5)).collect()] == [
        (i // 5, i % 5, i) for i in range(20)
    ]


def test_split_label_checks_the_length(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "record array<double>")
    assert tuple(matrix.split_label(df, "record", 2).first()) == ([1.0, 2.0], 3.0)
    with pytest.raises(Exception, match="a record must hold"):
        matrix.split_label(df, "record", 3).collect()


@pytest.mark.parametrize("c", [3, 40])
def test_batch_gradients(examples, c):
    x, y, w = RNG.normal(size=(60, c)), RNG.normal(size=60), list(RNG.normal(size=c))
    batched = assign_batches(examples(x, y), 20)
    rows = {k: [r["row_id"] for r in batched.where(F.col("batch") == k).collect()] for k in range(3)}
    for found in linear.batch_gradients(batched, w, 20).collect():
        i = rows[found["batch"]]
        np.testing.assert_allclose(found["gradient"], x[i].T @ (x[i] @ w - y[i]) / 20, rtol=1e-9)


def test_row_gradient_and_losses(examples):
    x, y, w = RNG.normal(size=(10, 3)), RNG.normal(size=10), [1.0, -2.0, 0.5]
    df = examples(x, y)
    resid = x @ w - y
    found = linear.with_gradient(df, w).orderBy("row_id").collect()
    np.testing.assert_allclose([r["gradient"] for r in found], x * resid[:, None], rtol=1e-12)
    assert linear.total_loss(df, w).first()[0] == pytest.approx(0.5 * (resid**2).sum())
    weights = df.sparkSession.createDataFrame([(w,)], "w array<double>")
    predicted = linear.predict_with_table(df, weights).orderBy("row_id").collect()
    np.testing.assert_allclose([r["prediction"] for r in predicted], x @ w, rtol=1e-12)


def test_names(spark):
    df = spark.createDataFrame([("a/b/run-x-250-fold.json",), ("plain",)], "p string")
    rows = df.select(names.file_stem(F.col("p")), names.numeric_suffix(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [("run-x-250-fold", 250), ("plain", None)]
    one = df.limit(1).select(names.run_parameter(F.col("p")), names.run_codepath(F.col("p"))).first()
    assert tuple(one) == (250, "fold")


@pytest.mark.parametrize("c", [3, 25])
def test_generated_data_follows_its_coefficients(spark, c):
    made, w = G.make_linear(spark, 2000, c, seed=5)
    assert linear.mean_abs_error(made, w).first()[0] < 1e-9
    x = np.array([r["features"] for r in made.select("features").collect()])
    assert abs(x.mean()) < 0.02 and abs(x.std() - 1) < 0.02
    again, _ = G.make_linear(spark, 1000, c, seed=5)
    assert again.exceptAll(made).count() == 0
    noisy, w = G.make_linear(spark, 2000, c, noise=2.0, seed=5)
    assert linear.mean_abs_error(noisy, w).first()[0] == pytest.approx(2 * np.sqrt(2 / np.pi), rel=0.1)


def test_families(spark, tmp_path):
    ids = spark.range(50).withColumnRenamed("id", "row_id")
    family = G.feature_family(ids, [2, 4], seed=1)
    small = G.generate_regression(ids, 2, seed=1)
    assert family.where("n_features = 2").select("row_id", "features", "label").exceptAll(small).count() == 0
    G.write_family(family, str(tmp_path / "f"), "n_features")
    assert spark.read.parquet(str(tmp_path / "f")).where("n_features = 4").count() == 50
    nested = G.nested_family(small, [10, 30]).groupBy("k").count().collect()
    assert sorted(map(tuple, nested)) == [(10, 10), (30, 30)]
    assert G.stepped_range(10, 30, 10) == [10, 20, 30]
    assert G.stepped_range(10, 25, 10) == [10, 20, 25]
    with pytest.raises(ValueError):
        G.stepped_range(10, 5, 1)
    stored = G.half_precision(small).first()["features"]
    np.testing.assert_array_equal(stored, np.array(stored).astype(np.float16).astype(float))


def runs(spark, times, path="fold"):
    return spark.createDataFrame([(p, path, t) for p, t in times.items()], "param_value bigint, codepath string, gpu_time double")


def test_compare_runs(spark):
    a, b = runs(spark, {200: 96.1, 1000: 272.9}), runs(spark, {200: 177.7, 1000: 571.1}, "plain")
    R.require_same_settings(a, b)
    found = {r["param_value"]: r["speedup"] for r in R.speedup(a, b, "gpu_time").collect()}
    assert round(found[200], 2) == 1.85 and round(found[1000], 2) == 2.09
    growth = {(r["codepath"], r["param_value"]): r for r in R.scaling_factor(a.union(b), "gpu_time").collect()}
    assert growth["fold", 1000]["param_growth"] == 5 and round(growth["fold", 1000]["measure_growth"], 2) == 2.84
    series = R.measure_series(a, ["gpu_time"]).collect()
    assert [(r["param_value"], r["value"]) for r in series] == [(200, 96.1), (1000, 272.9)]


def test_unmatched_settings(spark):
    a, b = runs(spark, {1: 1.0, 2: 1.0}), runs(spark, {2: 1.0, 3: 1.0})
    assert sorted(map(tuple, R.unmatched_settings(a, b).collect())) == [(1, "a"), (3, "b")]
    assert [tuple(r) for r in R.only_in(a, b).collect()] == [(1,)]
    with pytest.raises(ValueError, match="different settings"):
        R.require_same_settings(a, b)


@pytest.mark.parametrize("width", [4, 30])
def test_another_width_or_a_null_is_refused(spark, examples, width):
    w = [1.0] * width
    for n in (width - 1, width + 1):
        with pytest.raises(Exception, match="another width"):
            examples(np.ones((2, n)), np.ones(2)).select(V.dot(F.col("features"), w)).collect()
    for row in ((1, [None] + w[1:], 1.0), (1, w, None), (1, None, 1.0)):
        df = spark.createDataFrame([(0, w, 1.0), row], "row_id bigint, features array<double>, label double")
        for score in (linear.mean_abs_error, linear.total_loss):
            with pytest.raises(Exception, match="null|another width"):
                score(df, w).collect()


def test_one_sided_settings_are_refused(spark):
    a, b = runs(spark, {1: 1.0, 2: 1.0}), runs(spark, {2: 2.0, 3: 1.0})
    with pytest.raises(Exception, match="different settings"):
        R.compare_runs(a, b, "gpu_time").collect()
    assert [tuple(r) for r in R.compare_runs(a, b, "gpu_time", common_only=True).collect()] == [(2, 1.0, 2.0)]


def test_a_setting_that_ran_twice_is_refused(spark):
    a = runs(spark, {1: 1.0, 2: 1.0})
    with pytest.raises(Exception, match="more than one run"):
        R.compare_runs(a.union(a), a, "gpu_time").collect()


def test_data_sets_and_sweep_on_files(spark, tmp_path):
    """Generate a family, train on each member read back from its file, and read the run records."""
    ids = spark.range(200).withColumnRenamed("id", "row_id")
    G.write_feature_family(ids, [2, 3], f"{tmp_path}/features", seed=9)
    base, w = G.make_linear(spark, 300, 2, seed=9)
    G.write_nested_family(base, w, [100, 300], f"{tmp_path}/rows")
    assert weights_from_long(read_weights_csv(spark, f"{tmp_path}/rows_weights.csv", 2)).first()["w"] == w
    assert read_examples_csv(spark, f"{tmp_path}/rows-100.csv", 2, 100).count() == 100

    def member(size):
        return read_examples_csv(spark, f"{tmp_path}/features-{size}.csv", size, 200)

    swept = sweep(member, "features", [2, 3], lr=0.5, epochs=3, batch_size=20)
    write_sweep(swept, f"{tmp_path}/runs", "features")
    found = read_runs(spark, f"{tmp_path}/runs").orderBy("param_value").collect()
    assert [(r["run_id"], r["param_value"]) for r in found] == [("features-2-steps", 2), ("features-3-steps", 3)]
    assert [r["error"] for r in found] == [r["error"] for r in swept.orderBy("param_value").collect()]
    assert max(r["error"] for r in found) < 1.0


def test_partial_gradients_are_handed_on_when_full(examples, monkeypatch):
    rng = np.random.default_rng(3)
    x, y, w = rng.normal(size=(300, 20)), rng.normal(size=300), rng.normal(size=20)
    monkeypatch.setattr(linear, "PARTIAL_BYTES", 3 * 20 * 8)
    batched = examples(x, y).selectExpr("*", "int(row_id % 30) AS batch", "1 AS epoch")
    found = linear.batch_gradients(batched, w, 10, ("epoch", "batch"))
    assert found.schema["batch"].dataType.simpleString() == "int"
    for r in found.collect():
        mine = np.arange(300) % 30 == r["batch"]
        np.testing.assert_allclose(r["gradient"], (x[mine] @ w - y[mine]) @ x[mine] / 10, rtol=1e-9)


def test_vectors_of_two_widths_are_not_added(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0])], "x array<double>, y array<double>")
    with pytest.raises(Exception, match="another width"):
        df.select(V.axpy(1.0, F.col("x"), F.col("y"))).collect()


@pytest.mark.parametrize("c", [3, 16, 17, 40])
@pytest.mark.parametrize("bad", ["label", "entry", "vector", "short", "long"])
def test_nulls_and_widths_fail_alike_on_both_sides_of_sixteen(spark, c, bad):
    """Sums over columns and gradients refuse the same rows, whichever way they are computed."""
    row = {"label": ([1.0] * c, None), "entry": ([1.0] * (c - 1) + [None], 1.0), "vector": (None, 1.0), "short": ([1.0] * (c - 1), 1.0), "long": ([1.0] * (c + 1), 1.0)}[bad]
    rows = [(i, 0, [1.0] * c, 1.0) for i in range(5)] + [(5, 0, *row)]
    df = spark.createDataFrame(rows, "row_id bigint, batch bigint, features array<double>, label double")
    with pytest.raises(Exception, match="must not be null|another width|must hold"):
        linear.batch_gradients(df, [0.5] * c, 6).collect()
    if bad != "label":
        with pytest.raises(Exception, match="must not be null|another width"):
            matrix.column_sums(df, c).collect()
    if bad in ("entry", "vector"):
        with pytest.raises(Exception, match="must not be null"):
            matrix.column_sums(df).collect()
