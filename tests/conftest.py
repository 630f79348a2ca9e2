import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gradlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("gradlake-tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def examples(spark):
    """Make a table of examples from NumPy arrays."""

    def make(x, y):
        rows = [(i, [float(v) for v in row], float(label)) for i, (row, label) in enumerate(zip(x, y))]
        return spark.createDataFrame(rows, "row_id bigint, features array<double>, label double")

    return make
