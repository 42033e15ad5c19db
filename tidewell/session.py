"""Session helpers shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tidewell", cores: str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    n = os.cpu_count() if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), "tidewell-scratch")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, kept: list[str] | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For results that several jobs use: they are computed once, outlive lost executors,
    and as files have a known size when joins with them are planned. The path is added to ``kept``, for ``release``.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    if kept is not None:
        kept.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Remove staged results that nothing reads any more."""
    for path in paths:
        remove_path(spark, path)
    paths.clear()


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _files(spark, path)
    return files.exists(where)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern, sorted."""
    files, where = _files(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in files.globStatus(where) or [])


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files below a path."""
    files, where = _files(spark, path)
    return files.getContentSummary(where).getLength()


def remove_path(spark: SparkSession, path: str) -> None:
    files, where = _files(spark, path)
    files.delete(where, True)


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Put a finished folder in the place of another, which is moved aside first and removed last."""
    files, new = _files(spark, source)
    _, old = _files(spark, target)
    aside = new.suffix(f"-replaced-{uuid.uuid4().hex}")
    files.mkdirs(old.getParent())
    moved = files.exists(old)
    if moved and not files.rename(old, aside):
        raise OSError(f"cannot move {target} aside")
    if not files.rename(new, old):
        if moved:
            files.rename(aside, old)
        raise OSError(f"cannot move {source} to {target}")
    if moved:
        files.delete(aside, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file with one text."""
    files, where = _files(spark, path)
    out = files.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
