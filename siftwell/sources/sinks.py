"""Sinks: deliverables in three parts, logs that take each line once, and batches that no one else may use."""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.operators.store import exists, hadoop
from siftwell.sources.jsonl import canonical_json, settle, write_lines

# The streams of a log, and which difficulties each of them takes.
STREAMS = {"cleaned": None, "complex": "hard", "normal": "normal"}
_BATCH = re.compile(r"[A-Za-z0-9][A-Za-z0-9._+\-]{0,127}")


def valid_batch_id(value: str) -> str:
    """value, if it may name a batch."""
    if not _BATCH.fullmatch(value):
        raise ValueError(f"no batch id: {value!r}")
    return value


def new_batch_id(now: datetime | None = None) -> str:
    """The time in Beijing and eight random hexadecimal digits."""
    now = (now or datetime.now(timezone.utc)).astimezone(timezone(timedelta(hours=8)))
    return f"{now:%Y%m%dT%H%M%S%z}_{uuid.uuid4().hex[:8]}"


class Batch:
    """A batch of a log folder, held by one driver at a time: a second one with the same id is an error.

    The lock is a file made atomically in the folder's store, and deleted at the end. The lock of a driver that
    was killed stays and names its time; delete it by hand, or take another id.
    """

    def __init__(self, spark: SparkSession, folder: str, batch_id: str | None = None):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.id = valid_batch_id(batch_id or new_batch_id())
        self.lock = f"{self.folder}/locks/{self.id}.lock"

    def path(self, kind: str) -> str:
        return f"{self.folder}/{kind}/{self.id}"

    def __enter__(self) -> Batch:
        target, fs = hadoop(self.spark, self.lock)
        fs.mkdirs(target.getParent())
        if not fs.createNewFile(target):
            raise ValueError(f"batch {self.id} is in use: {self.lock}")
        return self

    def __exit__(self, *_) -> None:
        target, fs = hadoop(self.spark, self.lock)
        fs.delete(target, False)


def publish(rows: DataFrame, folder: str, success: bool = True) -> bool:
    """Writes all, hard and normal rows below folder. A failed run, or one without rows, leaves what is there."""
    spark = rows.sparkSession
    if not success:
        return False
    empty = rows.isEmpty()
    for name, level in STREAMS.items():
        settle(spark, f"{folder}/{name}")
        if empty and exists(spark, f"{folder}/{name}"):
            continue
        write_lines(rows if level is None else rows.where(F.col("difficulty_level") == level), f"{folder}/{name}")
    return True


def as_lines(rows: DataFrame) -> DataFrame:
    """(difficulty_level, line, digest) of rows; a line's SHA-256 is its identity."""
    names = [c for c in rows.columns if not c.startswith("_")]
    return rows.select("difficulty_level", canonical_json(F.struct(*names)).alias("line")).withColumn("digest", F.sha2("line", 256))


class LineLog:
    """Streams of JSON lines that hold each line once, however often it is sent.

    append() adds the lines whose digests a stream lacks, by an anti-join with all digests that it has; Spark
    commits its files together, so rows that are sent again add what is missing and nothing twice.
    put() is for streams of batches that never share a line: it writes each batch's own folder anew, and reads none.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self, stream: str) -> DataFrame:
        """(digest, line) of a stream."""
        if not exists(self.spark, f"{self.path}/{stream}"):
            return self.spark.createDataFrame([], "digest string, line string")
        rows = self.spark.read.option("recursiveFileLookup", "true").schema("digest string, line string").parquet(f"{self.path}/{stream}")
        return rows

    def append(self, rows: DataFrame) -> None:
        """Adds rows to every stream that takes their difficulty_level; one of neither kind goes to cleaned only."""
        lines = as_lines(rows)
        for stream, level in STREAMS.items():
            part = lines if level is None else lines.where(F.col("difficulty_level") == level)
            new = part.select("digest", "line").dropDuplicates(["digest"]).join(self.read(stream).select("digest"), "digest", "left_anti")
            new.write.mode("append").parquet(f"{self.path}/{stream}")

    def put(self, batch_id: int, lines: DataFrame) -> None:
        """Writes lines (of as_lines) as batch batch_id, in place of what that batch has written before."""
        for stream, level in STREAMS.items():
            part = lines if level is None else lines.where(F.col("difficulty_level") == level)
            part.select("digest", "line").write.mode("overwrite").parquet(f"{self.path}/{stream}/batch={batch_id}")

    def check(self) -> None:
        """Fails if a stream holds a line that is no JSON object."""
        for stream in STREAMS:
            bad = self.read(stream).where(F.json_object_keys("line").isNull())
            if not bad.isEmpty():
                raise ValueError(f"stream {stream} holds a line that is no object")
