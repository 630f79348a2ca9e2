"""Session helpers: a small local session for tests, and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "gradlake", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. A temporary folder is used only in local mode, where one machine
    runs everything.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="gradlake-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, stem: str) -> str:
    """A path in the shared folder that nobody has used yet."""
    return f"{shared_folder(spark)}/{stem}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, stem: str = "table", path: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder, or at ``path``, and continue from there.

    The lineage ends at files that outlive any executor, and later passes still read only the columns they need.
    """
    path = path or fresh_path(df.sparkSession, f"gradlake-{stem}")
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.written_to = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialise`, and copies made by readers, that nothing reads any more; results derived from them must have been written."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
