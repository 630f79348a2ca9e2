"""Small fixtures with known results."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradlake.functions import vectors as V
from gradlake.operators import linear, matrix, ordering
from gradlake.plans.fit import fit, fit_and_score

I = np.arange(5)  # row numbers


def rows(value, label):
    return np.repeat(np.asarray(value, dtype=float)[:, None], 4, axis=1), np.asarray(label, dtype=float)


@pytest.fixture
def gemv(examples):
    return examples(*rows(I + 1, [4] * 5))


def by_row(df, column):
    return [r[column] for r in df.orderBy("row_id").collect()]


def test_residual_and_gemv(gemv):
    ones = [1.0] * 4
    found = gemv.select("row_id", linear.residual(ones).alias("r"), V.gemv(F.col("features"), ones, F.col("label"), 1.0, -1.0).alias("g"))
    assert by_row(found, "r") == [0, 4, 8, 12, 16]
    assert by_row(found, "g") == [0, 4, 8, 12, 16]


def test_mean_abs_error(gemv):
    assert linear.mean_abs_error(gemv, [1.0] * 4).first()[0] == 8.0


def test_permutation(spark, examples):
    data = examples(*rows(I + 1, I + 1))
    order = spark.createDataFrame(list(enumerate([4, 2, 0, 1, 3])), "pos bigint, row_id bigint")
    found = ordering.permute(data, order).orderBy("pos").collect()
    assert [r["label"] for r in found] == [5, 3, 1, 2, 4]
    assert [r["features"] for r in found] == [[v] * 4 for v in (5, 3, 1, 2, 4)]


def test_batch_rows(spark, examples):
    data = examples(*rows(I + 1, I + 1))
    order = spark.createDataFrame(list(enumerate([4, 2, 0, 1, 3])), "pos bigint, row_id bigint")
    found = ordering.batch_rows(data, order, 2, 1).orderBy("slot").collect()
    assert [(r["slot"], r["label"]) for r in found] == [(0, 1), (1, 2)]


@pytest.mark.parametrize("n_features", [4, None])
def test_column_sums(examples, n_features):
    data = examples([[1, 2, 3, 4]] * 5, [4] * 5)
    plain = matrix.column_sums(data, n_features).orderBy("feature_idx").collect()
    assert [r["total"] for r in plain] == [5, 10, 15, 20]
    halved = matrix.column_sums(data, n_features, 2.0).orderBy("feature_idx").collect()
    assert [r["total"] for r in halved] == [2.5, 5, 7.5, 10]


def test_scale_rows(spark, examples):
    data = examples(np.ones((5, 4)), I + 2)
    assert by_row(matrix.scale_rows(data, F.col("label")), "features") == [[v] * 4 for v in (2, 3, 4, 5, 6)]
    factors = data.select("row_id", F.col("label").alias("factor"))
    assert by_row(matrix.scale_rows_by(data, factors), "features") == [[v] * 4 for v in (2, 3, 4, 5, 6)]


# Points of the line y = 5 x, to six digits after the point.
LINE = """
43.4457419,217.228709 90.0074095,450.037048 13.5106955,67.553478 5.3953916,26.976958 80.7617418,403.808709
40.7864316,203.932158 29.3949916,146.974958 9.3738582,46.869291 90.1561667,450.780834 77.3071239,386.535619
40.5288684,202.644342 45.5173013,227.586507 81.7602161,408.801080 29.2237100,146.118550 31.2950763,156.475382
58.3645030,291.822515 12.3013775,61.506887 72.7899827,363.949913 79.6101487,398.050744 49.2106221,246.053111
45.0989323,225.494661 53.1973689,265.986844 22.0919823,110.459912 24.5433947,122.716974 25.6028628,128.014314
50.5077825,252.538913 78.7264163,393.632082 15.5397881,77.698941 41.2375135,206.187568 48.8146851,244.073426
72.9893780,364.946890 0.9254987,4.627494 97.0719130,485.359565 69.4718380,347.359190 83.9326422,419.663211
97.7036635,488.518318 5.6165925,28.082962 42.2004881,211.002441 50.1248248,250.624124 97.9553337,489.776669
"""


@pytest.fixture
def line(examples):
    points = np.array([[float(v) for v in pair.split(",")] for pair in LINE.split()])
    assert points.shape == (40, 2)
    return examples(points[:, :1], points[:, 1])


@pytest.mark.parametrize(
    ("lr", "epochs", "w", "error"),
    [
        (1e-5, 10, 1.04520168, 198.14471524655536),
        (1e-4, 10, 4.64754937, 17.658606991676162),
        (1e-4, 50, 4.99934684, 0.03272521219699329),
    ],
)
@pytest.mark.parametrize("strategy", ["auto", "steps", "loop"])
def test_line(line, lr, epochs, w, error, strategy):
    result, found = fit_and_score(line, lr, epochs, 0, w0=[0.0], strategy=strategy)
    assert result.weights[0] == pytest.approx(w, abs=1e-7)
    assert found == pytest.approx(error, rel=1e-9)


def test_line_from_default_start(line):
    """The usage example of a single batch: it converges from any start in [0, 0.01)."""
    result = fit(line, 1e-4, 60, 0)
    assert result.num_batches == 1
    assert result.weights[0] == pytest.approx(5.0, abs=1e-3)
