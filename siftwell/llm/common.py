"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import atexit
import string
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are worked on in slices of about so many bytes, so that temporaries stay small.
SLICE_BYTES = 1 << 21
#: Bytes that are hashed at once.
HASH_BLOCK = 1 << 21

_scratch: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, by any path that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; null stays null.

    Spark's lower() does the same where every character is ASCII, and is much faster there.
    """
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    A temporary folder serves only where the setting is absent and Spark runs in one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = f"{tempfile.gettempdir()}/checkpoints"
    path = f"{base.rstrip('/')}/siftwell/{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(clear_scratch)
    _scratch.append((spark, path))
    return path


def clear_scratch() -> None:
    """Deletes what stored() has written so far; results that still read it must be done."""
    while _scratch:
        spark, path = _scratch.pop()
        try:
            jvm = spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has ended, its files go with the shared folder
            return


def stored(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it again.

    That cuts the lineage, lets later steps read single columns, and survives lost executors.
    """
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(values: list, limit: int = SLICE_BYTES):
    """(start, end) of runs of byte strings with about limit bytes each; a longer string stands alone."""
    start, total = 0, 0
    for i, x in enumerate(values):
        if i > start and total + len(x) > limit:
            yield start, i
            start, total = i, 0
        total += len(x) + 1
    if start < len(values):
        yield start, len(values)


def as_bytes(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null becomes empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


_MULTIPLIER = 0x9E3779B97F4A7C15
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2^64."""
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        out = []
        for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        _powers, _inverses = out
    return _powers, _inverses


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(mask.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return edge[::2], edge[1::2]


def _block_sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each data[start:end], its bytes (plus one) weighted by powers that count from start, summed modulo 2^64."""
    power, inverse = _tables(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    return (total[ends] - total[starts]) * inverse[starts]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = HASH_BLOCK) -> np.ndarray:
    """A 64-bit hash of each data[start:end] that does not depend on where it stands; spans rise and do not overlap.

    Spans are hashed in blocks of about block bytes, and a longer span in pieces whose sums are carried
    on, so what this takes besides its result does not grow with a text.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + block, side="right")))
        if int(ends[j - 1]) - base <= block:
            out[i:j] = _block_sums(data[base : int(ends[j - 1])], starts[i:j] - base, ends[i:j] - base)
        else:  # one long span
            total, step = 0, pow(_MULTIPLIER, block, 1 << 64)
            pieces = range(base, int(ends[i]), block)
            for k in reversed(pieces):
                piece = data[k : min(k + block, int(ends[i]))]
                own = _block_sums(piece, np.zeros(1, dtype=np.int64), np.array([len(piece)]))
                total = (int(own[0]) + total * step) % (1 << 64)
            out[i] = total
        i = j
    return mix(out)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words between ASCII white space, A-Z lower-cased, and where each text's words begin."""
    data = np.frombuffer(b" ".join(texts).lower(), dtype=np.uint8)
    starts, ends = runs(~_SPACE[data])
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(x) + 1 for x in texts], out=at[1:])
    return hash_spans(data, starts, ends), np.searchsorted(starts, at)
