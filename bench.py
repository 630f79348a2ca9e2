"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores. Each query runs once to warm up the JVM and is
then timed; the value is the sum over all queries. Training entries time a whole fit from the Parquet file to the weights.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from gradlake.operators import ordering
from gradlake.plans.fit import fit, fit_and_score
from gradlake.session import discard, local_session, materialise
from workload import queries as Q

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def sized(spark, rows: int, features: int):
    """A stored table of so many rows and features of unit variance, drawn from the keys of the given orders."""
    ids = Q.narrow(spark, SF_DIR).select("row_id").where(F.col("row_id") < rows)
    entry = lambda j: (F.pmod(F.xxhash64("row_id", j), F.lit(2_000_001)) - 1_000_000) * (3**0.5 / 1e6)
    wide = ids.withColumn("features", F.transform(F.sequence(F.lit(1), F.lit(features)), entry))
    label = F.aggregate(F.transform("features", lambda x, j: x * (j + 1)), F.lit(0.0), lambda a, x: a + x)
    return materialise(wide.withColumn("label", label).repartition(8, "row_id"), "bench")


def main() -> None:
    spark = local_session("bench", CPUS, os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("ERROR")
    narrow, wide = Q.narrow(spark, SF_DIR), Q.wide(spark, SF_DIR)
    start = [0.0] * 3
    # the published sizes, as far as the given keys reach: rows, features, rate, epochs, batches of 1000
    published = [(100_000, 4, 0.01, 10), (10_000, 200, 0.1, 20), (10_000, 1000, 0.1, 20)]
    tables = {(n, c): sized(spark, n, c) for n, c, _, _ in published}
    runs = {
        f"sgd_{n // 1000}k_x_{c}_b1000_t{t}": lambda n=n, c=c, lr=lr, t=t: fit(tables[n, c], lr, t, 1000, w0=[0.0] * c) for n, c, lr, t in published
    }
    runs |= {
        "sgd_b1000_t10": lambda: fit(narrow, 0.2, 10, 1000, w0=start),
        "sgd_fold_b1000_t10": lambda: fit(narrow, 0.2, 10, 1000, w0=start, strategy="fold"),
        "sgd_fold_b100_t10": lambda: fit(narrow, 0.2, 10, 100, w0=start, strategy="fold"),
        "sgd_blocks_b100_t10": lambda: fit(narrow, 0.2, 10, 100, w0=start, strategy="blocks"),
        "gd_full_batch_t10": lambda: fit(narrow, 0.2, 10, 0, w0=start),
        "sgd_wide_b100_t10": lambda: fit(wide, 0.5, 10, 100),
        "sgd_wide_blocks_b100_t10": lambda: fit(wide, 0.5, 10, 100, strategy="blocks"),
        "sgd_loop_10_batches": lambda: fit(narrow, 0.2, 1, 15000, w0=start, strategy="loop"),
        "fit_and_score": lambda: fit_and_score(narrow, 0.2, 2, 100, w0=start),
        "assign_batches": lambda: noop(ordering.assign_batches(narrow, 1000)),
    }
    for name in (
        "epoch_permutation",
        "mean_abs_error",
        "mean_abs_error_narrow",
        "column_sums",
        "row_gradient",
        "batch_gradient",
        "permute_rows",
        "predict_long_join",
        "generate_regression",
        "half_precision",
        "phase_totals",
        "scaling_factor",
        "compare_runs_mismatch",
        "l1_norm",
    ):
        runs[name] = lambda query=Q.QUERIES[name]: noop(query(spark, SF_DIR))
    seconds = {}
    for name, run in runs.items():
        run()
        started = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - started, 3)
    discard(*tables.values())
    result = {"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds}
    print(json.dumps(result | {"sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": CPUS}))


if __name__ == "__main__":
    main()
