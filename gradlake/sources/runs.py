"""Run records: one JSON object per run, in a file or folder named ``<name>-<parameter>-<path>.json``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.functions.names import file_stem, run_codepath, run_parameter
from gradlake.operators.runs import compare_measures

MEASURES = ("error", "gpu_time", "shuffle_time", "total_gradient_time", "transfer_time")
RECORD_SCHEMA = ", ".join(f"{m} double" for m in MEASURES)


def record_json(measures: tuple[str, ...] = MEASURES) -> Column:
    """The run record as one JSON text."""
    return F.to_json(F.struct(*[F.col(m) for m in measures]))


def write_run(spark: SparkSession, record: dict[str, float], folder: str, name: str, parameter: int, codepath: str, replace: bool = False) -> str:
    """Write one run record; returns its path.

    The path is the run's own, so with ``replace`` a run that is written again leaves one record, the last; otherwise that is an error.
    """
    path = f"{folder.rstrip('/')}/{name}-{parameter}-{codepath}.json"
    row = [tuple(float(record[m]) for m in MEASURES)]
    spark.createDataFrame(row, RECORD_SCHEMA).coalesce(1).write.mode("overwrite" if replace else "error").json(path)
    return path


def write_sweep(runs: DataFrame, folder: str, name: str) -> list[str]:
    """Write each run of a sweep as its own record; a sweep holds one row per setting."""
    spark = runs.sparkSession
    rows = runs.select("param_value", "codepath", *MEASURES).collect()
    return [write_run(spark, r.asDict(), folder, name, r["param_value"], r["codepath"]) for r in rows]


def write_runs(runs: DataFrame, path: str) -> None:
    """Append many run records, one JSON object per line."""
    runs.write.mode("append").json(path)


def run_name(path: Column) -> Column:
    """The ``<name>-<parameter>-<path>.json`` part of a path, whether that is a file or a folder."""
    return F.regexp_extract(path, r"([^/]*\.json)(/[^/]*)?$", 1)


#: Records are flat, so each ends at the first closing brace, however it is printed.
RECORD_END = "}"


def named_records(pieces: DataFrame) -> DataFrame:
    """Parse texts that were cut at ``RECORD_END``, and add what the file name says. Anything but records is an error."""
    name = run_name(F.col("_metadata.file_path"))
    text = F.regexp_replace("value", r"^[\s,\[]+", "")
    record = F.from_json(F.concat(text, F.lit(RECORD_END)), RECORD_SCHEMA, {"mode": "FAILFAST"})
    records = pieces.where(~F.col("value").rlike(r"^[\s,\]]*$")).select(name.alias("name"), record.alias("record"))
    return records.select(
        file_stem(F.col("name")).alias("run_id"), run_codepath(F.col("name")).alias("codepath"), run_parameter(F.col("name")).alias("param_value"), "record.*"
    )


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """``runs(run_id, codepath, param_value, ...five measures...)`` of all records in a folder.

    A file may hold many records, one per line or each printed over several lines; large files are split.
    """
    return named_records(spark.read.option("lineSep", RECORD_END).text(f"{folder.rstrip('/')}/*.json"))


def compare_folders(spark: SparkSession, a: str, b: str, measures: tuple[str, ...] = MEASURES, common_only: bool = False) -> DataFrame:
    """The measures of the records in two folders side by side, by the parameter in their names (see ``compare_measures``)."""
    return compare_measures(read_runs(spark, a), read_runs(spark, b), measures, common_only=common_only)


def json_number(text: Column, field: str) -> Column:
    """One integer field of a JSON text."""
    return F.from_json(text, f"{field} bigint")[field]
