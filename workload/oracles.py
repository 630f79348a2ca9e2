"""The same results in plain SQL (DuckDB dialect), straight from the given tables."""

from __future__ import annotations

W_NARROW_SQL = "[0.5::DOUBLE, 2.0::DOUBLE, -1.0::DOUBLE]"
W_WIDE_SQL = "[((j - 31.5) / 64)::DOUBLE for j in range(64)]"

NARROW = """narrow AS (
    SELECT o_orderkey AS row_id, 1.0::DOUBLE AS x0, o_totalprice / 500000 AS x1, (o_orderkey % 97) / 97.0::DOUBLE AS x2,
           o_totalprice / 100000 + 3 * ((o_orderkey % 97) / 97.0::DOUBLE) AS label
    FROM orders)"""
WIDE = """wide AS (
    SELECT vec_id AS row_id, embedding::DOUBLE[] AS x, label::DOUBLE AS label FROM embeddings)"""
RUNS = """runs AS (
    SELECT l_quantity::BIGINT AS param_value, l_returnflag AS codepath, avg(l_extendedprice / 1000) AS gpu_time,
           avg(l_discount) AS error, avg(l_tax) AS transfer_time
    FROM lineitem GROUP BY ALL)"""
SETTINGS = """a AS (SELECT DISTINCT o_custkey AS param_value FROM orders),
b AS (SELECT DISTINCT c_custkey + 7 AS param_value FROM customer)"""


def six(expression: str, name: str, digits: int = 6) -> str:
    """Rounded, without negative zero."""
    return f"round({expression}, {digits}) + 0::DOUBLE AS {name}"


def cells(source: str, vector: str, keys: str = "") -> str:
    """One row per entry of a list column."""
    return f"""SELECT row_id, {keys} col, {six("value", "value")}
FROM (SELECT row_id, {keys} unnest(range(len({vector}))) AS col, unnest({vector}) AS value FROM {source})"""


def with_(parts: list[str], query: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)}\n{query}"


def positions(source: str, epochs: list[int]) -> str:
    """Every row at its place in the random order of each epoch."""
    words = ", ".join(f"('0x' || substr(md5('42:' || row_id), {at}, 15))::BIGINT AS {name}" for name, at in (("u", 1), ("v", 16)))
    high, low = (f"((({word} >> 30) * epoch + ({word} & 1073741823)) % 1073741789)" for word in ("u", "v"))
    return f"""drawn AS (SELECT *, {words} FROM {source}),
placed AS (
    SELECT * EXCLUDE (u, v), row_number() OVER (PARTITION BY epoch ORDER BY {high}, {low}, row_id) - 1 AS pos
    FROM drawn, (SELECT unnest({epochs})::BIGINT AS epoch))"""


def batches(size: int | str) -> str:
    """Full batches only."""
    return f"""batched AS (
    SELECT *, pos // {size} AS batch FROM placed WHERE pos // {size} < (SELECT max(pos) + 1 FROM placed) // {size})"""


def narrow_fit(lr: float, epochs: int, size: int | str) -> list[str]:
    """Common table expressions that fold the batches of all epochs in order; the last row of ``descent`` holds the weights."""
    numbers = list(range(1, epochs + 1))
    if size:
        rows = [NARROW, positions("narrow", numbers), batches(size)]
    else:
        rows = [NARROW, f"batched AS (SELECT *, 0 AS batch FROM narrow, (SELECT unnest({numbers})::BIGINT AS epoch))"]
    moments = ", ".join(f"sum(x{i} * x{j}) AS g{i}{j}" for i in range(3) for j in range(i, 3))
    moments += ", " + ", ".join(f"sum(x{i} * label) AS c{i}" for i in range(3))
    steps = f"""steps AS (
    SELECT row_number() OVER (ORDER BY epoch, batch) AS k, {lr}::DOUBLE / pow(epoch, 0.25) / n AS a, * EXCLUDE (epoch, batch, n)
    FROM (SELECT epoch, batch, count(*) AS n, {moments} FROM batched GROUP BY epoch, batch))"""
    update = ", ".join(
        f"d.w{i} - s.a * ({' + '.join(f's.g{min(i, j)}{max(i, j)} * d.w{j}' for j in range(3))} - s.c{i})" for i in range(3)
    )
    descent = f"""descent(k, w0, w1, w2) AS (
    SELECT 0::BIGINT, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE
    UNION ALL SELECT s.k, {update} FROM descent d JOIN steps s ON s.k = d.k + 1)"""
    return [*rows, steps, descent, "fitted AS (SELECT * FROM descent ORDER BY k DESC LIMIT 1)"]


def narrow_weights(lr: float, epochs: int, size: int | str) -> str:
    return with_(narrow_fit(lr, epochs, size), f"SELECT {', '.join(six(f'w{i}', f'w{i}') for i in range(3))} FROM fitted", True)


def wide_weights(lr: float, epochs: int, size: int) -> str:
    parts = wide_fit(lr, epochs, size)
    last = "SELECT unnest(range(64))::INTEGER AS feature_idx, unnest(w) AS w FROM (SELECT w FROM descent ORDER BY k DESC LIMIT 1)"
    return with_(parts, f"SELECT feature_idx, {six('w', 'w')} FROM ({last})", True)


def wide_fit(lr: float, epochs: int, size: int, n: int = 64) -> list[str]:
    """The rows of a batch as lists, and one scalar step per batch; the first ``n`` features."""
    numbers = list(range(1, epochs + 1))
    table = WIDE.replace("embedding::DOUBLE[] AS x", f"(embedding::DOUBLE[])[1:{n}] AS x")
    if size:
        rows = [table, positions("wide", numbers), batches(size)]
    else:
        rows = [table, f"batched AS (SELECT *, 0 AS batch FROM wide, (SELECT unnest({numbers})::BIGINT AS epoch))"]
    steps = f"""steps AS (
    SELECT row_number() OVER (ORDER BY epoch, batch) AS k, {lr}::DOUBLE / pow(epoch, 0.25) / n AS a, xs, ys
    FROM (SELECT epoch, batch, count(*) AS n, list(x ORDER BY row_id) AS xs, list(label ORDER BY row_id) AS ys
          FROM batched GROUP BY epoch, batch))"""
    resid = "[list_inner_product(s.xs[i], d.w) - s.ys[i] for i in range(1, len(s.ys) + 1)]"
    descent = f"""descent(k, w) AS (
    SELECT 0::BIGINT, [0::DOUBLE for j in range({n})]
    UNION ALL
    SELECT k, [w[j] - a * list_inner_product([x[j] for x in xs], r) for j in range(1, {n + 1})]
    FROM (SELECT s.k, d.w, s.a, s.xs, {resid} AS r FROM descent d JOIN steps s ON s.k = d.k + 1))"""
    return [*rows, steps, descent]


def scored(lr: float, epochs: int, size: int) -> str:
    error = "(SELECT avg(abs(n.x0 * f.w0 + n.x1 * f.w1 + n.x2 * f.w2 - n.label)) FROM narrow n, fitted f)"
    columns = ", ".join(six(f"w{i}", f"w{i}") for i in range(3))
    return with_(narrow_fit(lr, epochs, size), f"SELECT {columns}, {six(error, 'mean_abs_error')} FROM fitted", True)


def swept(lr: float, epochs: int, sizes: list[int]) -> str:
    parts = []
    for size in sizes:
        one = scored(lr, epochs, size)
        parts.append(f"SELECT 'batch' AS param_name, {size}::BIGINT AS param_value, mean_abs_error AS error FROM ({one})")
    return "\nUNION ALL\n".join(parts)


def swept_samples(lr: float, epochs: int, size: int, sizes: list[str]) -> str:
    parts = []
    for n in sizes:
        one = scored(lr, epochs, size).replace("FROM orders)", f"FROM orders WHERE o_orderkey < ({n}))", 1)
        parts.append(f"SELECT 'samples' AS param_name, ({n})::BIGINT AS param_value, mean_abs_error AS error FROM ({one})")
    return "\nUNION ALL\n".join(parts)


def swept_features(lr: float, epochs: int, size: int, widths: list[int]) -> str:
    parts = []
    for n in widths:
        last = "(SELECT w FROM descent ORDER BY k DESC LIMIT 1)"
        one = with_(wide_fit(lr, epochs, size, n), f"SELECT {six('avg(abs(list_inner_product(x, w) - label))', 'error')} FROM wide, {last}", True)
        parts.append(f"SELECT 'features' AS param_name, {n}::BIGINT AS param_value, error FROM ({one})")
    return "\nUNION ALL\n".join(parts)


def uniform(text: str, start: int) -> str:
    return f"((('0x' || substr(md5({text}), {start}, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"


def normal(text: str) -> str:
    return f"(sqrt(-2.0::DOUBLE * ln({uniform(text, 1)})) * cos(2.0::DOUBLE * pi() * {uniform(text, 9)}))"


def feature(row: str, j: str) -> str:
    return normal(f"'42:' || {row} || ':' || {j}")


def coefficient(j: str) -> str:
    return f"(100.0::DOUBLE * {uniform(f"'42:coef:' || {j}", 1)})"


def half(x: str) -> str:
    """Nearest half-precision number, through the exponent of the binary representation."""
    exponent = f"greatest(floor(log2(abs({x}))), -14)"
    step = f"pow(2.0::DOUBLE, {exponent} - 10)"
    rounded = f"(round_even({x} / {step}, 0) * {step})"
    return f"CASE WHEN abs({x}) >= 65520 THEN sign({x}) * 'inf'::DOUBLE ELSE {rounded} END"


MEASURES = {"error": 1, "gpu_time": 2, "shuffle_time": 4, "total_gradient_time": 8, "transfer_time": 16}
ORDER_RECORDS = f"""SELECT o_orderkey AS run_id, {', '.join(six(f'o_totalprice / {d}', m) for m, d in MEASURES.items())} FROM orders"""
WIDE_PREDICTION = f"list_inner_product(x, {W_WIDE_SQL})"
NARROW_PREDICTION = "(0.5::DOUBLE * x0 + 2.0::DOUBLE * x1 - x2)"
NARROW_COLUMNS = "unnest([0, 1, 2])::INTEGER AS feature_idx"
SUMS = "sums AS (SELECT i, sum(v) AS w FROM (SELECT unnest(range(64)) AS i, unnest(x) AS v FROM wide) GROUP BY i)"
STEM = r"regexp_replace(regexp_replace(url, '^.*/', ''), '\.[^.]*$', '')"

ORACLES = {
    "csv_roundtrip": with_([NARROW], f"SELECT {', '.join(six(c, c, 9) for c in ('x0', 'x1', 'x2', 'label'))} FROM narrow"),
    "csv_row_ids": """SELECT count(*) AS n_rows, 0::BIGINT AS first_id, count(*) - 1 AS last_id, count(*) AS distinct_ids
FROM orders""",
    "shape_check": """SELECT count(*) AS n_rows, min(len(embedding))::BIGINT AS min_features,
    max(len(embedding))::BIGINT AS max_features FROM embeddings""",
    "data_size_mb": f"SELECT {six('sum(len(embedding))::DOUBLE * 4 / 1048576', 'size_mb')} FROM embeddings",
    "observed_figures": with_([WIDE], f"""SELECT count(*) AS n_rows, min(len(x))::BIGINT AS min_features, max(len(x))::BIGINT AS max_features,
    {six('sum(len(x))::DOUBLE * 4 / 1048576', 'size_mb')}, {six(f'avg(abs({WIDE_PREDICTION} - label))', 'mean_abs_error')} FROM wide"""),
    "run_record_json": ORDER_RECORDS,
    "run_records_table": ORDER_RECORDS,
    "run_records_folder": f"""SELECT event_type AS codepath, count(*) AS param_value, {six('avg(value)', 'error')},
    {six('max(value)', 'gpu_time')}, 0::DOUBLE AS shuffle_time, 1::DOUBLE AS total_gradient_time,
    {six('min(value)', 'transfer_time')} FROM events GROUP BY event_type""",
    "events_json_field": "SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events",
    "weights_unpivot": with_(
        [WIDE], f"SELECT row_id, feature_idx, {six('w', 'w')} FROM (SELECT row_id, unnest(range(64))::INTEGER AS feature_idx, unnest(x) AS w FROM wide)"
    ),
    "weights_csv_roundtrip": with_([WIDE, SUMS], f"SELECT i::INTEGER AS feature_idx, {six('w / 100', 'w')} FROM sums"),
    "feature_label_split": with_(
        [WIDE, "split AS (SELECT row_id, x[1:63] AS f, round(x[64], 6) + 0::DOUBLE AS label FROM wide)"], cells("split", "f", "label,")
    ),
    "matrix_to_long": with_([WIDE], cells("wide", "x")),
    "linear_index_cells": """SELECT o_orderkey, o_orderkey // 64 AS cell_row, o_orderkey % 64 AS cell_col,
    (o_orderkey // 64) * 64 AS row_start FROM orders""",
    "long_to_matrix": with_(
        [WIDE],
        f"""SELECT row_id, len(x)::INTEGER AS n, {six('x[64]', 'last')},
    {six('list_inner_product(x, [(j + 1)::DOUBLE for j in range(64)])', 'weighted')} FROM wide""",
    ),
    "scale_rows": with_([WIDE, "scaled AS (SELECT row_id, [v * label for v in x] AS f FROM wide)"], cells("scaled", "f")),
    "scale_vector": with_([WIDE, "scaled AS (SELECT row_id, [v / 7.0::DOUBLE for v in x] AS f FROM wide)"], cells("scaled", "f")),
    "axpy": with_(
        [WIDE, "added AS (SELECT row_id, [0.5::DOUBLE * x[j] + x[65 - j] for j in range(1, 65)] AS f FROM wide)"], cells("added", "f")
    ),
    "gemv": with_([WIDE], f"SELECT row_id, {six(f'2 * {WIDE_PREDICTION} - label', 'value')} FROM wide"),
    "predict": with_([WIDE], f"SELECT row_id, {six(WIDE_PREDICTION, 'prediction')} FROM wide"),
    "predict_narrow": with_([NARROW], f"SELECT row_id, {six(NARROW_PREDICTION, 'prediction', 9)} FROM narrow"),
    "residual": with_([WIDE], f"SELECT row_id, {six(f'{WIDE_PREDICTION} - label', 'residual')} FROM wide"),
    "batch_residual": with_(
        [WIDE, positions("wide", [1]), batches(100)], f"SELECT batch, row_id, {six(f'{WIDE_PREDICTION} - label', 'residual')} FROM batched"
    ),
    "row_gradient": with_(
        [WIDE, f"graded AS (SELECT row_id, [v * ({WIDE_PREDICTION} - label) for v in x] AS f FROM wide)"], cells("graded", "f")
    ),
    "half_squared_error": with_(
        [WIDE], f"SELECT row_id, {six(f'0.5 * pow({WIDE_PREDICTION} - label, 2)', 'half_squared_error')} FROM wide"
    ),
    "permute_rows": with_([WIDE, positions("wide", [1])], f"SELECT pos, row_id, label, {six('list_sum(x)', 'row_total')} FROM placed"),
    "scale_rows_join": with_(
        [WIDE, "scaled AS (SELECT row_id, [v * (e.label + 0.5::DOUBLE) for v in x] AS f FROM wide JOIN embeddings e ON vec_id = row_id)"],
        cells("scaled", "f"),
    ),
    "batch_lookup": with_(
        [WIDE, positions("wide", [1])],
        f"SELECT pos - 150 AS slot, row_id, label, {six('list_sum(x)', 'row_total')} FROM placed WHERE pos BETWEEN 150 AND 199",
    ),
    "batch_lookup_stored": with_(
        [WIDE, positions("wide", [1])],
        f"SELECT pos - 50 AS slot, row_id, label, {six('list_sum(x)', 'row_total')} FROM placed WHERE pos BETWEEN 50 AND 99",
    ),
    "predict_scalar_subquery": with_(
        [WIDE, SUMS, "w AS (SELECT list(w ORDER BY i) AS w FROM sums)"],
        f"SELECT row_id, {six('list_inner_product(x, w)', 'prediction')} FROM wide, w",
    ),
    "predict_long_join": with_(
        [WIDE, SUMS, "cells AS (SELECT row_id, unnest(range(64)) AS i, unnest(x) AS v FROM wide)"],
        f"SELECT row_id, {six('sum(v * w)', 'prediction')} FROM cells JOIN sums USING (i) GROUP BY row_id",
    ),
    "compare_runs": with_(
        [RUNS],
        f"""SELECT param_value, {six('a.gpu_time', 'gpu_time_a')}, {six('b.gpu_time', 'gpu_time_b')}
FROM (FROM runs WHERE codepath = 'A') a JOIN (FROM runs WHERE codepath = 'R') b USING (param_value)""",
    ),
    "compare_runs_mismatch": with_(
        [SETTINGS],
        """SELECT coalesce(a.param_value, b.param_value) AS param_value, CASE WHEN b.param_value IS NULL THEN 'a' ELSE 'b' END AS side
FROM a FULL JOIN b ON a.param_value = b.param_value WHERE a.param_value IS NULL OR b.param_value IS NULL""",
    ),
    "settings_only_in_a": with_([SETTINGS], "SELECT param_value FROM a EXCEPT SELECT param_value FROM b"),
    "settings_only_in_b": with_([SETTINGS], "SELECT param_value FROM b EXCEPT SELECT param_value FROM a"),
    "column_sums": with_([WIDE, SUMS], f"SELECT i::INTEGER AS feature_idx, {six('w', 'total')} FROM sums"),
    "column_sums_narrow": with_(
        [NARROW, f"s AS (SELECT {NARROW_COLUMNS}, unnest([sum(x0), sum(x1), sum(x2)]) AS t FROM narrow)"],
        f"SELECT feature_idx, {six('t', 'total')} FROM s",
    ),
    "column_sums_scaled": with_([WIDE, SUMS], f"SELECT i::INTEGER AS feature_idx, {six('w / 2', 'total')} FROM sums"),
    "row_sums": with_([WIDE], f"SELECT row_id, {six('list_sum(x)', 'total')} FROM wide"),
    "segment_sums": with_([WIDE], f"SELECT row_id AS segment, {six('list_sum(x)', 'total')} FROM wide"),
    "mean_abs_error": with_([WIDE], f"SELECT {six(f'avg(abs({WIDE_PREDICTION} - label))', 'mean_abs_error')} FROM wide"),
    "mean_abs_error_narrow": with_([NARROW], f"SELECT {six(f'avg(abs({NARROW_PREDICTION} - label))', 'mean_abs_error')} FROM narrow"),
    "l1_norm": f"SELECT {six('sum(abs(l_discount - l_tax))', 'l1_norm')} FROM lineitem",
    "total_loss": with_([NARROW], f"SELECT {six(f'sum(0.5 * pow({NARROW_PREDICTION} - label, 2))', 'total_loss')} FROM narrow"),
    "batch_gradient": with_(
        [NARROW, positions("narrow", [1]), batches(100)],
        f"""SELECT batch, {', '.join(six(f'sum(({NARROW_PREDICTION} - label) * x{i}) / 100', f'g{i}') for i in range(3))}
FROM batched GROUP BY batch""",
    ),
    "batch_gradient_wide": with_(
        [WIDE, positions("wide", [1]), batches(50)],
        f"""SELECT batch, feature_idx, {six('sum(v * r) / 50', 'g')}
FROM (SELECT batch, {WIDE_PREDICTION} - label AS r, unnest(range(64))::INTEGER AS feature_idx, unnest(x) AS v FROM batched)
GROUP BY batch, feature_idx""",
    ),
    "phase_totals": f"SELECT user_id, event_type, {six('sum(value)', 'total_millis')} FROM events GROUP BY ALL",
    "epoch_permutation": with_([NARROW, positions("narrow", [1, 2])], "SELECT epoch, pos, row_id FROM placed"),
    "batch_assignment": with_([NARROW, positions("narrow", [1, 2]), batches(700)], "SELECT epoch, batch, row_id FROM batched"),
    "batch_assignment_ranked": with_([NARROW, positions("narrow", [1, 2]), batches(3)], "SELECT epoch, batch, row_id FROM batched"),
    "batch_sizes": with_(
        [NARROW, positions("narrow", [1, 2, 3]), batches(128)],
        "SELECT epoch, batch, count(*) AS n_rows FROM batched GROUP BY epoch, batch",
    ),
    "natural_sort": r"""SELECT c_custkey, 'c' || n || '.json' AS name, row_number() OVER (ORDER BY n) - 1 AS pos
FROM (SELECT c_custkey, regexp_extract(c_name, '([0-9]+)[^0-9]*$', 1)::BIGINT AS n FROM customer)""",
    "nested_subsets": with_(
        [
            NARROW,
            "n AS (SELECT count(*) AS n FROM narrow)",
            "sizes AS (SELECT DISTINCT k FROM (SELECT unnest(range(n // 4, n + 1, n // 4)) AS k FROM n UNION ALL SELECT n FROM n))",
        ],
        f"SELECT k, count(*) AS n_rows, {six('sum(label)', 'label_sum')} FROM narrow JOIN sizes ON row_id < k GROUP BY k",
    ),
    "sgd_epoch": narrow_weights(0.5, 1, 100),
    "sgd_epoch_loop": narrow_weights(0.5, 1, "(SELECT count(*) // 7 FROM orders)"),
    "sgd_epoch_blocks": narrow_weights(0.5, 2, 100),
    "sgd_fit": narrow_weights(0.2, 4, 400),
    "sgd_fit_wide": wide_weights(0.5, 3, 40),
    "sgd_fit_wide_fold": wide_weights(0.5, 2, 125),
    "sgd_fit_wide_steps": wide_weights(0.5, 4, 60),
    "gd_fit": narrow_weights(0.5, 10, 0),
    "gd_fit_wide": wide_weights(0.5, 5, 0),
    "fit_and_score": scored(0.2, 2, 100),
    "fit_record": f"""SELECT 'orders-100-spark' AS run_id, 'spark' AS codepath, 100::BIGINT AS param_value, mean_abs_error AS error, true AS gpu_time_known,
    true AS shuffle_time_known, true AS total_gradient_time_known, true AS transfer_time_known FROM ({scored(0.2, 2, 100)})""",
    "generate_regression": with_(
        [
            f"made AS (SELECT o_orderkey AS row_id, {', '.join(f'{feature("o_orderkey", str(j))} AS x{j}' for j in range(3))} FROM orders)",
            f"labelled AS (SELECT *, {' + '.join(f'x{j} * {coefficient(str(j))}' for j in range(3))}"
            f" + 0.5::DOUBLE * {normal("'42:noise:' || row_id")} AS label FROM made)",
        ],
        f"SELECT row_id, {', '.join(six(c, c) for c in ('x0', 'x1', 'x2', 'label'))} FROM labelled",
    ),
    "generate_feature_sweep": with_(
        [
            "grid AS (SELECT o_orderkey AS row_id, j FROM orders, (SELECT unnest(range(8)) AS j))",
            f"made AS (SELECT row_id, j, {feature('row_id', 'j')} AS x, {coefficient('j')} AS w FROM grid)",
            "sizes AS (SELECT unnest([2, 5, 8])::INTEGER AS n_features)",
        ],
        f"""SELECT n_features, count(DISTINCT row_id) AS n_rows, {six('sum(x)', 'feature_sum', 4)}, {six('sum(x * w) / 1000', 'label_sum', 4)}
FROM made JOIN sizes ON j < n_features GROUP BY n_features""",
    ),
    "half_precision": f"""SELECT o_orderkey, {half('(o_totalprice / 10)')} AS large, {half('(-o_totalprice / 500000)')} AS unit,
    {half('(o_totalprice / 1e11)')} AS tiny FROM orders""",
    "sweep_batch_size": swept(0.2, 2, [250, 500, 1000]),
    "sweep_samples": swept_samples(0.2, 2, 100, ["SELECT count(*) // 4 FROM orders", "SELECT count(*) // 2 FROM orders", "SELECT count(*) FROM orders"]),
    "sweep_features": swept_features(0.5, 2, 60, [8, 16, 64]),
    "parse_param": """SELECT p_partkey, p_size::BIGINT AS parameter, 'blas' AS path FROM part""",
    "name_number": r"SELECT c_custkey, regexp_extract(c_name, '([0-9]+)[^0-9]*$', 1)::BIGINT AS number FROM customer",
    "file_stem": f"SELECT page_id, {STEM} AS stem FROM pages",
    "compare_folders": f"""WITH means AS (
    SELECT l_linenumber::BIGINT AS param_value, l_returnflag AS flag, avg(l_extendedprice) AS gpu_time, avg(l_discount) AS error, avg(l_tax) AS transfer_time,
           0::DOUBLE AS shuffle_time, 1::DOUBLE AS total_gradient_time
    FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY ALL),
long AS (UNPIVOT means ON gpu_time, error, transfer_time, shuffle_time, total_gradient_time INTO NAME measure VALUE v)
SELECT a.param_value, a.measure, {six('a.v', 'a')}, {six('b.v', 'b')}, CASE WHEN a.v <> 0 THEN round(b.v / a.v, 6) + 0::DOUBLE END AS speedup
FROM (FROM long WHERE flag = 'A') a JOIN (FROM long WHERE flag = 'R') b USING (param_value, measure)""",
    "measure_series": with_(
        [RUNS],
        "\nUNION ALL\n".join(
            f"SELECT codepath, param_value, '{m}' AS measure, {six(m, 'value')} FROM runs" for m in ("gpu_time", "error", "transfer_time")
        ),
    ),
    "speedup": with_(
        [RUNS],
        f"""SELECT param_value, {six('b.gpu_time / a.gpu_time', 'speedup')}
FROM (FROM runs WHERE codepath = 'A') a JOIN (FROM runs WHERE codepath = 'R') b USING (param_value)""",
    ),
    "scaling_factor": with_(
        [RUNS],
        f"""SELECT codepath, param_value,
    {six('param_value / first_value(param_value) OVER (PARTITION BY codepath ORDER BY param_value)', 'param_growth')},
    {six('gpu_time / first_value(gpu_time) OVER (PARTITION BY codepath ORDER BY param_value)', 'measure_growth')} FROM runs""",
    ),
    "streaming_error": with_([NARROW], f"SELECT {six(f'avg(abs({NARROW_PREDICTION} - label))', 'mean_abs_error')} FROM narrow"),
}
