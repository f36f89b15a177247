"""Intermediate tables: written once to a folder that driver and executors share, then read again."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def cut(df: DataFrame) -> DataFrame:
    """df, written and read again, so that its lineage ends here.

    The folder lies below spark.checkpoint.dir; a temporary one serves only for Spark in one process. It goes
    with clear() or when the driver ends.
    """
    return kept(df, scratch(df.sparkSession))


def kept(df: DataFrame, path: str) -> DataFrame:
    """df, written to path in place of what is there, and read again."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one, for tables that a query keeps to itself."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"{tempfile.gettempdir()}/checkpoints"
    path = f"{base.rstrip('/')}/siftwell/{uuid.uuid4().hex}"
    if not _made:
        atexit.register(clear)
    _made.append((spark, path))
    return path


def clear() -> None:
    """Deletes what cut() and scratch() have made so far; results that still read it must be done."""
    while _made:
        spark, path = _made.pop()
        try:
            delete(spark, path)
        except Exception:  # the session has ended, its files go with the shared folder
            return


def hadoop(spark: SparkSession, path: str):
    """(path, file system) of Hadoop's, for any store that Spark can reach."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = hadoop(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    target, fs = hadoop(spark, path)
    fs.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of the driver's, UTF-8, in place of what is there."""
    target, fs = hadoop(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file; FileNotFoundError if there is none."""
    target, fs = hadoop(spark, path)
    if not fs.exists(target):
        raise FileNotFoundError(path)
    return "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
