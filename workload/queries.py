"""One query per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.functions import vectors as V
from gradlake.functions.half import to_half
from gradlake.functions.names import file_stem, numeric_suffix, run_codepath, run_parameter
from gradlake.operators import generate, linear, matrix, ordering, runs
from gradlake.plans.fit import fit, fit_and_score, train_and_record
from gradlake.plans.sweep import sweep
from gradlake.session import fresh_path
from gradlake.sources import examples as sources
from gradlake.sources import runs as records
from gradlake.sources import weights as weight_files
from gradlake.streaming import stream_examples_csv

SEED = 42
W_NARROW = [0.5, 2.0, -1.0]
W_WIDE = [(j - 31.5) / 64 for j in range(64)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def six(column, name: str):
    return F.round(column, 6).alias(name)


def nine(column, name: str):
    """For quotients of prices, which end in a 5 at the seventh digit too often to be rounded at the sixth."""
    return F.round(column, 9).alias(name)


def narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three features from ``orders``; the exact solution is (0, 5, 3)."""
    part = (F.col("o_orderkey") % 97) / F.lit(97.0)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.array(F.lit(1.0), F.col("o_totalprice") / 500000, part).alias("features"),
        (F.col("o_totalprice") / 100000 + 3 * part).alias("label"),
    )


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64 features from ``embeddings``."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_id"), V.as_doubles(F.col("embedding")).alias("features"), F.col("label").cast("double").alias("label")
    )


def cells(df: DataFrame, vector: str = "features", *keys: str) -> DataFrame:
    return df.select("row_id", *keys, F.posexplode(vector).alias("col", "value")).select("row_id", *keys, "col", six(F.col("value"), "value"))


# -- sources and sinks


def _roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "gradlake-csv")
    sources.write_examples_csv(narrow(spark, sf_dir), path, 3)
    return sources.read_examples_csv(spark, path, 3)


def csv_roundtrip(spark, sf_dir):
    read = _roundtrip(spark, sf_dir)
    return read.select(*[nine(x, f"x{i}") for i, x in enumerate(V.entries(F.col("features"), 3))], nine(F.col("label"), "label"))


def csv_row_ids(spark, sf_dir):
    ids = _roundtrip(spark, sf_dir).agg(
        F.count("*").alias("n_rows"),
        F.min("row_id").alias("first_id"),
        F.max("row_id").alias("last_id"),
        F.count_distinct("row_id").alias("distinct_ids"),
    )
    return ids


def shape_check(spark, sf_dir):
    return sources.shape(wide(spark, sf_dir))


def data_size_mb(spark, sf_dir):
    return sources.data_size_mb(wide(spark, sf_dir)).select(six(F.col("size_mb"), "size_mb"))


def observed_figures(spark, sf_dir):
    """Shape and size, as the pass that scores the rows finds them on its way."""
    rows, figures = sources.observed(wide(spark, sf_dir))
    error = linear.mean_abs_error(rows, W_WIDE).first()[0]
    found = figures.get | {"size_mb": round(figures.get["size_mb"], 6), "mean_abs_error": round(error, 6)}
    return spark.createDataFrame([found], "n_rows bigint, min_features bigint, max_features bigint, size_mb double, mean_abs_error double")


def _order_records(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        price.alias("error"),
        (price / 2).alias("gpu_time"),
        (price / 4).alias("shuffle_time"),
        (price / 8).alias("total_gradient_time"),
        (price / 16).alias("transfer_time"),
    )


def run_record_json(spark, sf_dir):
    text = _order_records(spark, sf_dir).select("run_id", records.record_json().alias("json"))
    return text.select("run_id", *[six(F.get_json_object("json", f"$.{m}").cast("double"), m) for m in records.MEASURES])


def run_records_table(spark, sf_dir):
    path = fresh_path(spark, "gradlake-runs")
    records.write_runs(_order_records(spark, sf_dir), path)
    read = spark.read.schema("run_id bigint, " + records.RECORD_SCHEMA).json(path)
    return read.select("run_id", *[six(F.col(m), m) for m in records.MEASURES])


def run_records_folder(spark, sf_dir):
    """One record per kind of event, written under the name that carries its parameter, then read as a folder."""
    kinds = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.avg("value").alias("error"), F.count("*").alias("n"), F.max("value").alias("gpu_time"), F.min("value").alias("transfer_time")
    )
    folder = fresh_path(spark, "gradlake-records")
    for kind in kinds.collect():  # one row per kind of event, a handful
        record = {m: kind[m] for m in ("error", "gpu_time", "transfer_time")} | {"shuffle_time": 0.0, "total_gradient_time": 1.0}
        records.write_run(spark, record, folder, "events", kind["n"], kind["event_type"])
    return records.read_runs(spark, folder).select("codepath", "param_value", *[six(F.col(m), m) for m in records.MEASURES])


def events_json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", records.json_number(F.col("props"), "k").alias("k"))


def weights_unpivot(spark, sf_dir):
    long = weight_files.weights_to_long(wide(spark, sf_dir), "features", "row_id")
    return long.select("row_id", "feature_idx", six(F.col("w"), "w"))


def weights_csv_roundtrip(spark, sf_dir):
    """The column means of ``embeddings`` as a weight file: one CSV row of 64 numbers."""
    wide_rows = wide(spark, sf_dir)
    means = matrix.column_sums(wide_rows, None, 100.0).orderBy("feature_idx").collect()  # one row per feature
    path = fresh_path(spark, "gradlake-weights")
    weight_files.write_weights_csv(spark, [m["total"] for m in means], path)
    return weight_files.read_weights_csv(spark, path, len(means)).select("feature_idx", six(F.col("w"), "w"))


# -- projections and reshaping


def feature_label_split(spark, sf_dir):
    split = matrix.split_label(wide(spark, sf_dir).select("row_id", F.col("features").alias("record")), "record", 63)
    return cells(split.withColumn("label", six(F.col("label"), "label")), "features", "label")


def matrix_to_long(spark, sf_dir):
    return matrix.to_long(wide(spark, sf_dir)).select("row_id", "col", six(F.col("value"), "value"))


def linear_index_cells(spark, sf_dir):
    linear_id = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        matrix.cell_row(linear_id, 64).alias("cell_row"),
        matrix.cell_col(linear_id, 64).alias("cell_col"),
        matrix.linear_index(matrix.cell_row(linear_id, 64), F.lit(0), 64).alias("row_start"),
    )


def long_to_matrix(spark, sf_dir):
    rebuilt = matrix.from_long(matrix.to_long(wide(spark, sf_dir)))
    weighted = V.dot(F.col("features"), [float(j + 1) for j in range(64)])
    return rebuilt.select("row_id", F.size("features").alias("n"), six(F.col("features")[63], "last"), six(weighted, "weighted"))


def scale_rows(spark, sf_dir):
    return cells(matrix.scale_rows(wide(spark, sf_dir), F.col("label")))


def scale_vector(spark, sf_dir):
    return cells(wide(spark, sf_dir).withColumn("features", V.divide(F.col("features"), 7.0)))


def axpy(spark, sf_dir):
    return cells(wide(spark, sf_dir).withColumn("features", V.axpy(0.5, F.col("features"), F.reverse("features"))))


def gemv(spark, sf_dir):
    return wide(spark, sf_dir).select("row_id", six(V.gemv(F.col("features"), W_WIDE, F.col("label"), 2.0, -1.0), "value"))


# -- linear model, per row


def predict(spark, sf_dir):
    return wide(spark, sf_dir).select("row_id", six(linear.prediction(W_WIDE), "prediction"))


def predict_narrow(spark, sf_dir):
    return narrow(spark, sf_dir).select("row_id", nine(linear.prediction(W_NARROW), "prediction"))


def residual(spark, sf_dir):
    return wide(spark, sf_dir).select("row_id", six(linear.residual(W_WIDE), "residual"))


def batch_residual(spark, sf_dir):
    batched = ordering.assign_batches(wide(spark, sf_dir), 100, seed=SEED)
    return batched.select("batch", "row_id", six(linear.residual(W_WIDE), "residual"))


def row_gradient(spark, sf_dir):
    return cells(linear.with_gradient(wide(spark, sf_dir), W_WIDE), "gradient")


def half_squared_error(spark, sf_dir):
    return wide(spark, sf_dir).select("row_id", six(linear.half_squared_error(W_WIDE), "half_squared_error"))


# -- joins


def permute_rows(spark, sf_dir):
    rows = wide(spark, sf_dir)
    order = ordering.epoch_permutation(rows.select("row_id"), (1,), SEED).select("pos", "row_id")
    gathered = ordering.permute(rows, order)
    return gathered.select("pos", "row_id", "label", six(V.total(F.col("features")), "row_total"))


def scale_rows_join(spark, sf_dir):
    factors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), (F.col("label") + 0.5).alias("factor"))
    return cells(matrix.scale_rows_by(wide(spark, sf_dir), factors))


def batch_lookup(spark, sf_dir):
    rows = wide(spark, sf_dir)
    order = ordering.epoch_permutation(rows.select("row_id"), (1,), SEED).select("pos", "row_id")
    chosen = ordering.batch_rows(rows, order, 50, 3)
    return chosen.select("slot", "row_id", "label", six(V.total(F.col("features")), "row_total"))


def batch_lookup_stored(spark, sf_dir):
    """The batch of positions 50 to 99 from an order that is stored in stretches of 70."""
    rows = wide(spark, sf_dir)
    order = ordering.epoch_permutation(rows.select("row_id"), (1,), SEED)
    stored = ordering.store_order(order, fresh_path(spark, "gradlake-order"), 70)
    return ordering.stored_batch(rows, stored, 50, 1).select("slot", "row_id", "label", six(V.total(F.col("features")), "row_total"))


def predict_scalar_subquery(spark, sf_dir):
    rows = wide(spark, sf_dir)
    totals = matrix.column_sums(rows).withColumnRenamed("total", "w")
    predicted = linear.predict_with_table(rows, weight_files.weights_from_long(totals))
    return predicted.select("row_id", six(F.col("prediction"), "prediction"))


def predict_long_join(spark, sf_dir):
    rows = wide(spark, sf_dir)
    totals = matrix.column_sums(rows).withColumnRenamed("total", "w")
    predicted = linear.predict_long(matrix.to_long(rows), totals)
    return predicted.select("row_id", six(F.col("prediction"), "prediction"))


def _runs(spark, sf_dir):
    """Run records by quantity (the parameter) and return flag (the code path)."""
    return table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_quantity").cast("bigint").alias("param_value"), F.col("l_returnflag").alias("codepath")
    ).agg(
        F.avg(F.col("l_extendedprice") / 1000).alias("gpu_time"),
        F.avg("l_discount").alias("error"),
        F.avg("l_tax").alias("transfer_time"),
    )


def _path(spark, sf_dir, path):
    return _runs(spark, sf_dir).where(F.col("codepath") == path)


def compare_runs(spark, sf_dir):
    both = runs.compare_runs(_path(spark, sf_dir, "A"), _path(spark, sf_dir, "R"), "gpu_time")
    return both.select("param_value", six(F.col("gpu_time_a"), "gpu_time_a"), six(F.col("gpu_time_b"), "gpu_time_b"))


def _settings(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("param_value"))
    b = table(spark, sf_dir, "customer").select((F.col("c_custkey") + 7).alias("param_value"))
    return a, b


def compare_runs_mismatch(spark, sf_dir):
    return runs.unmatched_settings(*_settings(spark, sf_dir))


def settings_only_in_a(spark, sf_dir):
    a, b = _settings(spark, sf_dir)
    return runs.only_in(a, b)


def settings_only_in_b(spark, sf_dir):
    a, b = _settings(spark, sf_dir)
    return runs.only_in(b, a)


# -- aggregates


def column_sums(spark, sf_dir):
    return matrix.column_sums(wide(spark, sf_dir)).select("feature_idx", six(F.col("total"), "total"))


def column_sums_narrow(spark, sf_dir):
    return matrix.column_sums(narrow(spark, sf_dir), 3).select("feature_idx", six(F.col("total"), "total"))


def column_sums_scaled(spark, sf_dir):
    return matrix.column_sums(wide(spark, sf_dir), None, 2.0).select("feature_idx", six(F.col("total"), "total"))


def row_sums(spark, sf_dir):
    return matrix.row_sums(wide(spark, sf_dir)).select("row_id", six(F.col("total"), "total"))


def segment_sums(spark, sf_dir):
    """Sum by key over the linearised matrix: the key of a cell is the quotient of its linear index."""
    long = matrix.to_long(wide(spark, sf_dir))
    linear_cells = long.select(matrix.linear_index(F.col("row_id"), F.col("col"), 64).alias("linear"), "value")
    sums = matrix.segment_sums(linear_cells, matrix.cell_row(F.col("linear"), 64))
    return sums.select("segment", six(F.col("total"), "total"))


def mean_abs_error(spark, sf_dir):
    found = linear.mean_abs_error(wide(spark, sf_dir), W_WIDE)
    return found.select(six(F.col("mean_abs_error"), "mean_abs_error"))


def mean_abs_error_narrow(spark, sf_dir):
    found = linear.mean_abs_error(narrow(spark, sf_dir), W_NARROW)
    return found.select(six(F.col("mean_abs_error"), "mean_abs_error"))


def l1_norm(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_discount") - F.col("l_tax")).alias("v"))
    return matrix.l1_norm(rows, F.col("v")).select(six(F.col("l1_norm"), "l1_norm"))


def total_loss(spark, sf_dir):
    return linear.total_loss(narrow(spark, sf_dir), W_NARROW).select(six(F.col("total_loss"), "total_loss"))


def batch_gradient(spark, sf_dir):
    batched = ordering.assign_batches(narrow(spark, sf_dir), 100, seed=SEED)
    found = linear.batch_gradients(batched, W_NARROW, 100)
    return found.select("batch", *[six(g, f"g{i}") for i, g in enumerate(V.entries(F.col("gradient"), 3))])


def batch_gradient_wide(spark, sf_dir):
    batched = ordering.assign_batches(wide(spark, sf_dir), 50, seed=SEED)
    found = linear.batch_gradients(batched, W_WIDE, 50)
    return found.select("batch", F.posexplode("gradient").alias("feature_idx", "g")).select("batch", "feature_idx", six(F.col("g"), "g"))


def phase_totals(spark, sf_dir):
    totals = runs.phase_totals(table(spark, sf_dir, "events"), "user_id", "event_type", "value")
    return totals.select("user_id", "event_type", six(F.col("total_millis"), "total_millis"))


# -- order and batches


def epoch_permutation(spark, sf_dir):
    rows = narrow(spark, sf_dir).select("row_id")
    return ordering.epoch_permutation(rows, (1, 2), SEED).select(F.col("epoch").cast("bigint").alias("epoch"), "pos", "row_id")


def batch_assignment(spark, sf_dir):
    rows = narrow(spark, sf_dir).select("row_id")
    return ordering.assign_batches(rows, 700, (1, 2), SEED).select(F.col("epoch").cast("bigint").alias("epoch"), "batch", "row_id")


def batch_assignment_ranked(spark, sf_dir):
    """Batches of three rows, each row's from its own position."""
    rows = narrow(spark, sf_dir).select("row_id")
    return ordering.assign_batches(rows, 3, (1, 2), SEED, ranked=True).select(F.col("epoch").cast("bigint").alias("epoch"), "batch", "row_id")


def batch_sizes(spark, sf_dir):
    rows = narrow(spark, sf_dir).select("row_id")
    batched = ordering.assign_batches(rows, 128, (1, 2, 3), SEED)
    return batched.groupBy(F.col("epoch").cast("bigint").alias("epoch"), "batch").agg(F.count("*").alias("n_rows"))


def natural_sort(spark, sf_dir):
    """Customers by the number in their name, without its leading zeros; the position comes from the sorted table."""
    short = F.concat(F.lit("c"), numeric_suffix(F.col("c_name")).cast("string"), F.lit(".json"))
    named = table(spark, sf_dir, "customer").select("c_custkey", short.alias("name"))
    placed = sources.with_row_id(ordering.natural_order(named, "name", "c_custkey"))
    return placed.select("c_custkey", "name", F.col("row_id").alias("pos"))


def nested_subsets(spark, sf_dir):
    rows = narrow(spark, sf_dir)
    n = rows.count()
    family = generate.nested_family(rows, generate.stepped_range(n // 4, n, n // 4))
    return family.groupBy("k").agg(F.count("*").alias("n_rows"), six(F.sum("label"), "label_sum"))


# -- training


def _weights(result, **more):
    return {f"w{j}": round(v, 6) + 0.0 for j, v in enumerate(result.weights)} | more


def _one_row(spark, values: dict) -> DataFrame:
    schema = ", ".join(f"{name} double" for name in values)
    return spark.createDataFrame([tuple(float(v) for v in values.values())], schema)


def sgd_epoch(spark, sf_dir):
    return _one_row(spark, _weights(fit(narrow(spark, sf_dir), 0.5, 1, 100, w0=[0.0] * 3, seed=SEED, strategy="fold")))


def sgd_epoch_loop(spark, sf_dir):
    """Seven large batches, one job each."""
    rows = narrow(spark, sf_dir)
    return _one_row(spark, _weights(fit(rows, 0.5, 1, rows.count() // 7, w0=[0.0] * 3, seed=SEED, strategy="loop")))


def sgd_epoch_blocks(spark, sf_dir):
    return _one_row(spark, _weights(fit(narrow(spark, sf_dir), 0.5, 2, 100, w0=[0.0] * 3, seed=SEED, strategy="blocks")))


def sgd_fit(spark, sf_dir):
    return _one_row(spark, _weights(fit(narrow(spark, sf_dir), 0.2, 4, 400, w0=[0.0] * 3, seed=SEED, strategy="fold")))


def sgd_fit_wide(spark, sf_dir):
    result = fit(wide(spark, sf_dir), 0.5, 3, 40, w0=[0.0] * 64, seed=SEED, strategy="blocks")
    rows = [(j, round(v, 6) + 0.0) for j, v in enumerate(result.weights)]
    return spark.createDataFrame(rows, "feature_idx int, w double")


def sgd_fit_wide_fold(spark, sf_dir):
    """The same model from partial sums per task, as used when a batch is larger than a task."""
    result = fit(wide(spark, sf_dir), 0.5, 2, 125, w0=[0.0] * 64, seed=SEED, strategy="fold")
    rows = [(j, round(v, 6) + 0.0) for j, v in enumerate(result.weights)]
    return spark.createDataFrame(rows, "feature_idx int, w double")


def sgd_fit_wide_steps(spark, sf_dir):
    """The same model stepped through where its rows lie."""
    result = fit(wide(spark, sf_dir), 0.5, 4, 60, w0=[0.0] * 64, seed=SEED, strategy="steps")
    rows = [(j, round(v, 6) + 0.0) for j, v in enumerate(result.weights)]
    return spark.createDataFrame(rows, "feature_idx int, w double")


def gd_fit(spark, sf_dir):
    return _one_row(spark, _weights(fit(narrow(spark, sf_dir), 0.5, 10, 0, w0=[0.0] * 3, seed=SEED)))


def gd_fit_wide(spark, sf_dir):
    result = fit(wide(spark, sf_dir), 0.5, 5, 0, w0=[0.0] * 64, seed=SEED)
    rows = [(j, round(v, 6) + 0.0) for j, v in enumerate(result.weights)]
    return spark.createDataFrame(rows, "feature_idx int, w double")


def fit_and_score_query(spark, sf_dir):
    result, error = fit_and_score(narrow(spark, sf_dir), 0.2, 2, 100, w0=[0.0] * 3, seed=SEED)
    return _one_row(spark, _weights(result, mean_abs_error=round(error, 6) + 0.0))


def fit_record(spark, sf_dir):
    """Fit, score, record, and read the folder of records; the run is started twice, as after a failure."""
    rows, folder = narrow(spark, sf_dir), fresh_path(spark, "gradlake-records")
    for _ in range(2):
        train_and_record(rows, 0.2, 2, 100, w0=[0.0] * 3, seed=SEED, folder=folder, name="orders", parameter=100, codepath="spark")
    read = records.read_runs(spark, folder)
    positive = [(F.col(m) >= 0).alias(f"{m}_known") for m in ("gpu_time", "shuffle_time", "total_gradient_time", "transfer_time")]
    return read.select("run_id", "codepath", "param_value", six(F.col("error"), "error"), *positive)


# -- generation


def generate_regression(spark, sf_dir):
    made = generate.generate_regression(narrow(spark, sf_dir).select("row_id"), 3, 0.5, SEED)
    return made.select("row_id", *[six(x, f"x{i}") for i, x in enumerate(V.entries(F.col("features"), 3))], six(F.col("label"), "label"))


def generate_feature_sweep(spark, sf_dir):
    family = generate.feature_family(narrow(spark, sf_dir).select("row_id"), [2, 5, 8], seed=SEED)
    return family.groupBy("n_features").agg(
        F.count("*").alias("n_rows"),
        F.round(F.sum(V.total(F.col("features"))), 4).alias("feature_sum"),
        F.round(F.sum("label") / 1000, 4).alias("label_sum"),
    )


def half_precision(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        to_half(price / 10).alias("large"),
        to_half(-price / 500000).alias("unit"),
        to_half(price / 1e11).alias("tiny"),
    )


# -- experiment analytics


def sweep_batch_size(spark, sf_dir):
    found = sweep(narrow(spark, sf_dir), "batch", [250, 500, 1000], lr=0.2, epochs=2, seed=SEED, w0=[0.0] * 3)
    return found.select("param_name", "param_value", six(F.col("error"), "error"))


def sweep_samples(spark, sf_dir):
    """A quarter, a half and all of the rows, from one scan."""
    rows = narrow(spark, sf_dir)
    n = rows.count()
    found = sweep(rows, "samples", [n // 4, n // 2, n], lr=0.2, epochs=2, batch_size=100, seed=SEED, w0=[0.0] * 3)
    return found.select("param_name", "param_value", six(F.col("error"), "error"))


def sweep_features(spark, sf_dir):
    """The first 8, 16 and 64 features, from one scan."""
    found = sweep(wide(spark, sf_dir), "features", [8, 16, 64], lr=0.5, epochs=2, batch_size=60, seed=SEED, w0=[0.0] * 64)
    return found.select("param_name", "param_value", six(F.col("error"), "error"))


def parse_param(spark, sf_dir):
    brand = F.translate(F.col("p_brand"), "#", "-")
    name = F.concat(F.lit("results/"), brand, F.lit("-"), F.col("p_size").cast("string"), F.lit("-blas.json"))
    named = table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))
    return named.select("p_partkey", run_parameter(F.col("name")).alias("parameter"), run_codepath(F.col("name")).alias("path"))


def name_number(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", numeric_suffix(F.col("c_name")).alias("number"))


def file_stem_query(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", file_stem(F.col("url")).alias("stem"))


def compare_folders(spark, sf_dir):
    """Records of two code paths in two folders, one per line number, compared in one call."""
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag IN ('A', 'R')").groupBy("l_returnflag", "l_linenumber").agg(
        F.avg("l_extendedprice").alias("gpu_time"), F.avg("l_discount").alias("error"), F.avg("l_tax").alias("transfer_time")
    )
    folders = {flag: fresh_path(spark, "gradlake-records") for flag in "AR"}
    for r in lines.collect():  # one row per line number and flag, a handful
        record = {m: r[m] for m in ("gpu_time", "error", "transfer_time")} | {"shuffle_time": 0.0, "total_gradient_time": 1.0}
        records.write_run(spark, record, folders[r["l_returnflag"]], "lines", r["l_linenumber"], r["l_returnflag"].lower())
    found = records.compare_folders(spark, folders["A"], folders["R"])
    return found.select("param_value", "measure", *(six(F.col(c), c) for c in ("a", "b", "speedup")))


def measure_series(spark, sf_dir):
    series = runs.measure_series(_runs(spark, sf_dir), ["gpu_time", "error", "transfer_time"], ["codepath", "param_value"])
    return series.select("codepath", "param_value", "measure", six(F.col("value"), "value"))


def speedup(spark, sf_dir):
    found = runs.speedup(_path(spark, sf_dir, "A"), _path(spark, sf_dir, "R"), "gpu_time")
    return found.select("param_value", six(F.col("speedup"), "speedup"))


def scaling_factor(spark, sf_dir):
    found = runs.scaling_factor(_runs(spark, sf_dir), "gpu_time")
    return found.select(
        "codepath", "param_value", six(F.col("param_growth"), "param_growth"), six(F.col("measure_growth"), "measure_growth")
    )


def streaming_error(spark, sf_dir):
    """Mean absolute error over CSV files read as a stream."""
    path, checkpoint = fresh_path(spark, "gradlake-csv"), fresh_path(spark, "gradlake-stream")
    sources.write_examples_csv(narrow(spark, sf_dir), path, 3)
    error = linear.mean_abs_error(stream_examples_csv(spark, path, 3), W_NARROW)
    name = "error_" + checkpoint.rsplit("-", 1)[-1]
    writer = error.writeStream.format("memory").queryName(name).outputMode("complete")
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name).select(six(F.col("mean_abs_error"), "mean_abs_error"))


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "csv_row_ids": csv_row_ids,
    "shape_check": shape_check,
    "data_size_mb": data_size_mb,
    "observed_figures": observed_figures,
    "run_record_json": run_record_json,
    "run_records_table": run_records_table,
    "run_records_folder": run_records_folder,
    "events_json_field": events_json_field,
    "weights_unpivot": weights_unpivot,
    "weights_csv_roundtrip": weights_csv_roundtrip,
    "feature_label_split": feature_label_split,
    "matrix_to_long": matrix_to_long,
    "linear_index_cells": linear_index_cells,
    "long_to_matrix": long_to_matrix,
    "scale_rows": scale_rows,
    "scale_vector": scale_vector,
    "axpy": axpy,
    "gemv": gemv,
    "predict": predict,
    "predict_narrow": predict_narrow,
    "residual": residual,
    "batch_residual": batch_residual,
    "row_gradient": row_gradient,
    "half_squared_error": half_squared_error,
    "permute_rows": permute_rows,
    "scale_rows_join": scale_rows_join,
    "batch_lookup": batch_lookup,
    "batch_lookup_stored": batch_lookup_stored,
    "predict_scalar_subquery": predict_scalar_subquery,
    "predict_long_join": predict_long_join,
    "compare_runs": compare_runs,
    "compare_runs_mismatch": compare_runs_mismatch,
    "settings_only_in_a": settings_only_in_a,
    "settings_only_in_b": settings_only_in_b,
    "column_sums": column_sums,
    "column_sums_narrow": column_sums_narrow,
    "column_sums_scaled": column_sums_scaled,
    "row_sums": row_sums,
    "segment_sums": segment_sums,
    "mean_abs_error": mean_abs_error,
    "mean_abs_error_narrow": mean_abs_error_narrow,
    "l1_norm": l1_norm,
    "total_loss": total_loss,
    "batch_gradient": batch_gradient,
    "batch_gradient_wide": batch_gradient_wide,
    "phase_totals": phase_totals,
    "epoch_permutation": epoch_permutation,
    "batch_assignment": batch_assignment,
    "batch_assignment_ranked": batch_assignment_ranked,
    "batch_sizes": batch_sizes,
    "natural_sort": natural_sort,
    "nested_subsets": nested_subsets,
    "sgd_epoch": sgd_epoch,
    "sgd_epoch_loop": sgd_epoch_loop,
    "sgd_epoch_blocks": sgd_epoch_blocks,
    "sgd_fit": sgd_fit,
    "sgd_fit_wide": sgd_fit_wide,
    "sgd_fit_wide_fold": sgd_fit_wide_fold,
    "sgd_fit_wide_steps": sgd_fit_wide_steps,
    "gd_fit": gd_fit,
    "gd_fit_wide": gd_fit_wide,
    "fit_and_score": fit_and_score_query,
    "fit_record": fit_record,
    "generate_regression": generate_regression,
    "generate_feature_sweep": generate_feature_sweep,
    "half_precision": half_precision,
    "sweep_batch_size": sweep_batch_size,
    "sweep_samples": sweep_samples,
    "sweep_features": sweep_features,
    "parse_param": parse_param,
    "name_number": name_number,
    "file_stem": file_stem_query,
    "compare_folders": compare_folders,
    "measure_series": measure_series,
    "speedup": speedup,
    "scaling_factor": scaling_factor,
    "streaming_error": streaming_error,
}
