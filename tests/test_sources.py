"""CSV examples, weights, run records and their streams."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradlake.operators import linear
from gradlake.session import discard
from gradlake.sources import examples as E
from gradlake.sources import runs as R
from gradlake.sources import weights as W
from gradlake.streaming import stream_examples_csv, stream_runs


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_without_final_newline(spark, tmp_path):
    lines = [f"{3 * i + 1},{3 * i + 2},{3 * i + 3},{(i + 1) / 10}" for i in range(3)]
    path = write(tmp_path / "parse.csv", "\n".join(lines))
    found = E.read_examples_csv(spark, path, 3, 3).orderBy("row_id").collect()
    assert [tuple(r) for r in found] == [(i, [3 * i + 1, 3 * i + 2, 3 * i + 3], (i + 1) / 10) for i in range(3)]


@pytest.mark.parametrize("line", ["1,2,3,4", "1,2", "1,,3", "1,x,3"])
def test_bad_line_fails(spark, tmp_path, line):
    path = write(tmp_path / "bad.csv", f"1,2,3\n{line}\n4,5,6\n")
    with pytest.raises(Exception, match="(?i)malformed|empty cell"):
        E.read_examples_csv(spark, path, 2).collect()


def test_missing_file_fails(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path"):
        E.read_examples_csv(spark, str(tmp_path / "none.csv"), 2)


def test_wrong_shape_fails(spark, tmp_path):
    path = write(tmp_path / "a.csv", "1,2\n3,4\n")
    with pytest.raises(ValueError, match="expected 3 rows"):
        E.read_examples_csv(spark, path, 1, 3)


def test_row_ids_are_line_numbers_over_split_files(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    n = 0
    for name, rows in (("a.csv", 3000), ("b.csv", 10), ("c.csv", 1234)):
        write(folder / name, "".join(f"{n + i},{(n + i) * 2}\n" for i in range(rows)))
        n += rows
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        found = E.read_examples_csv(spark, str(folder), 1, n)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found.where(F.col("features")[0] != F.col("row_id")).count() == 0
    assert found.agg(F.max("row_id")).first()[0] == n - 1


def test_csv_roundtrip(spark, tmp_path, examples):
    rng = np.random.default_rng(1)
    data = examples(rng.normal(size=(50, 4)), rng.normal(size=50))
    E.write_examples_csv(data, str(tmp_path / "out"), 4)
    read = E.read_examples_csv(spark, str(tmp_path / "out"), 4, row_ids=False)
    assert sorted(map(tuple, read.collect())) == sorted((r["features"], r["label"]) for r in data.collect())


def test_with_row_id_keeps_the_order(spark):
    df = spark.range(0, 1000, 1, 7).orderBy(F.col("id").desc())
    found = E.with_row_id(df)
    assert found.where(F.col("row_id") != 999 - F.col("id")).count() == 0


def test_size_report(examples):
    assert E.data_size_mb(examples(np.ones((1024, 16)), np.ones(1024))).first()[0] == 1024 * 16 * 4 / 2**20


def test_weights(spark, tmp_path):
    values = [25.967083895041398, 98.356720651366302, 81.874022948405084]
    W.write_weights_csv(spark, values, str(tmp_path / "w"))
    read = W.read_weights_csv(spark, str(tmp_path / "w"), 3)
    assert W.weights_from_long(read).first()["w"] == values
    crlf = write(tmp_path / "w.csv", ",".join(map(str, values)) + "\r\n")
    assert W.weights_from_long(W.read_weights_csv(spark, crlf, 3)).first()["w"] == values
    with pytest.raises(Exception, match="(?i)malformed"):
        W.read_weights_csv(spark, crlf, 2).collect()


RECORD = {"error": 2.5, "gpu_time": 10.0, "shuffle_time": 1.0, "total_gradient_time": 4.0, "transfer_time": 7.0}


def test_run_records(spark, tmp_path):
    folder = tmp_path / "runs"
    folder.mkdir()
    write(folder / "scalable-9000-plain.json", json.dumps(RECORD, indent=3))
    R.write_run(spark, RECORD | {"error": 1.5}, str(folder), "my-scalable", 10000, "fold")
    found = R.read_runs(spark, str(folder)).orderBy("param_value").collect()
    assert [(r["run_id"], r["codepath"], r["param_value"], r["error"]) for r in found] == [
        ("scalable-9000-plain", "plain", 9000, 2.5),
        ("my-scalable-10000-fold", "fold", 10000, 1.5),
    ]
    assert {k: found[0][k] for k in RECORD} == RECORD


def test_streams_equal_the_tables(spark, tmp_path, examples):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(60, 2)), rng.normal(size=60)
    E.write_examples_csv(examples(x, y), str(tmp_path / "csv"), 2)
    stream = linear.mean_abs_error(stream_examples_csv(spark, str(tmp_path / "csv"), 2), [1.0, 2.0])
    writer = stream.writeStream.format("memory").queryName("mae").outputMode("complete").trigger(availableNow=True)
    writer.option("checkpointLocation", str(tmp_path / "check")).start().awaitTermination()
    assert spark.table("mae").first()[0] == pytest.approx(np.abs(x @ [1, 2] - y).mean(), rel=1e-12)

    folder = tmp_path / "records"
    folder.mkdir()
    write(folder / "a-5-fold.json", json.dumps(RECORD, indent=3))
    writer = stream_runs(spark, str(folder)).writeStream.format("memory").queryName("runs_seen").trigger(availableNow=True)
    writer.option("checkpointLocation", str(tmp_path / "check2")).start().awaitTermination()
    assert [(r["param_value"], r["codepath"]) for r in spark.table("runs_seen").collect()] == [(5, "fold")]


def test_files_of_many_records_are_read_whole(spark, tmp_path):
    text = json.dumps({m: 1.5 for m in R.MEASURES})
    (tmp_path / "many-10-fold.json").write_text(f"{text}\n{text}\n\n{text}")
    (tmp_path / "pretty-20-fold.json").write_text(json.dumps({m: 2.5 for m in R.MEASURES}, indent=2) * 2)
    found = R.read_runs(spark, str(tmp_path)).orderBy("param_value").collect()
    assert [(r["param_value"], r["error"]) for r in found] == [(10, 1.5)] * 3 + [(20, 2.5)] * 2
    (tmp_path / "broken-30-fold.json").write_text(text + " rest")
    with pytest.raises(Exception):
        R.read_runs(spark, str(tmp_path)).collect()


def test_odd_rows_are_not_written(spark, tmp_path):
    for i, bad in enumerate(([1.0, None], [1.0], [1.0, 2.0, 3.0], None)):
        df = spark.createDataFrame([([1.0, 2.0], 1.0), (bad, 1.0)], "features array<double>, label double")
        with pytest.raises(Exception, match="must not be null|another width"):
            E.write_examples_csv(df, str(tmp_path / f"bad{i}"), 2)
    with pytest.raises(Exception, match="label must not be null"):
        E.write_examples_csv(spark.createDataFrame([([1.0], None)], "features array<double>, label double"), str(tmp_path / "null"), 1)


def test_prefix_sums_over_groups_and_ranges(spark):
    rows = [(f"f{g:03d}", s, (7 * g + s) % 5) for g in range(60) for s in range(g % 4 + 1)]
    found = {(r["g"], r["s"]): r["before"] for r in E.prefix_sums(spark.createDataFrame(rows, "g string, s bigint, n bigint").repartition(9), "g", ["s"], "n", "before").collect()}
    total = 0
    for g, s, n in sorted(rows):
        assert found[g, s] == total
        total += n
    assert len(found) == len(rows)


def test_the_stored_copy_can_be_placed_and_released(spark, tmp_path):
    path = write(tmp_path / "a.csv", "1,2\n3,4\n")
    read = E.read_examples_csv(spark, path, 1, 2, store=str(tmp_path / "copy"))
    assert read.count() == 2 and (tmp_path / "copy").exists()
    discard(read)
    assert not (tmp_path / "copy").exists()


def test_figures_come_with_the_pass_that_reads(spark, examples):
    rows, figures = E.observed(examples(np.ones((30, 4)), np.ones(30)))
    assert linear.mean_abs_error(rows, [1.0] * 4).first()[0] == 3.0
    assert figures.get == {"n_rows": 30, "min_features": 4, "max_features": 4, "size_mb": 30 * 4 * 4 / 2**20}
    none, figures = E.observed(rows.limit(0))
    none.write.format("noop").mode("overwrite").save()
    assert figures.get == {"n_rows": 0, "min_features": None, "max_features": None, "size_mb": 0.0}


def test_a_record_written_again_is_one_record(spark, tmp_path):
    for error in (1.0, 2.0):
        R.write_run(spark, RECORD | {"error": error}, str(tmp_path), "again", 7, "steps", replace=True)
    assert [r["error"] for r in R.read_runs(spark, str(tmp_path)).collect()] == [2.0]
    with pytest.raises(Exception, match="(?i)exist"):
        R.write_run(spark, RECORD, str(tmp_path), "again", 7, "steps")


def test_two_folders_side_by_side(spark, tmp_path):
    for n in (10, 20):
        R.write_run(spark, RECORD | {"gpu_time": float(n), "error": 0.0}, str(tmp_path / "a"), "x", n, "fold")
        R.write_run(spark, RECORD | {"gpu_time": 3.0 * n}, str(tmp_path / "b"), "y", n, "steps")
    found = {(r["param_value"], r["measure"]): (r["a"], r["b"], r["speedup"]) for r in R.compare_folders(spark, str(tmp_path / "a"), str(tmp_path / "b")).collect()}
    assert len(found) == 10 and found[20, "gpu_time"] == (20.0, 60.0, 3.0) and found[10, "error"] == (0.0, 2.5, None)
    R.write_run(spark, RECORD, str(tmp_path / "b"), "y", 30, "steps")
    with pytest.raises(Exception, match="different settings"):
        R.compare_folders(spark, str(tmp_path / "a"), str(tmp_path / "b")).collect()
    assert R.compare_folders(spark, str(tmp_path / "a"), str(tmp_path / "b"), ("error",), common_only=True).count() == 2
    R.write_run(spark, RECORD, str(tmp_path / "a"), "z", 10, "fold")
    with pytest.raises(Exception, match="more than one run"):
        R.compare_folders(spark, str(tmp_path / "a"), str(tmp_path / "b"), common_only=True).collect()
