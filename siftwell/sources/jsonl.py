"""JSON lines: strict and tolerant scans with rejects, format detection, canonical and atomic output."""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.operators.labels import numbered
from siftwell.operators.store import cut, hadoop


def parsed(line: str) -> tuple[str, str | None]:
    """('', the object in plain form) of a line, or why it is none: Python's own reading of JSON decides.

    Of a name given twice the last value counts; NaN, infinities and numbers too large become null, and halves
    of surrogate pairs question marks.
    """
    try:
        value = json.loads(line, parse_constant=lambda _: None)
    except (ValueError, RecursionError):
        return "invalid_json", None
    if not isinstance(value, dict):
        return "not_an_object", None
    try:
        plain = json.dumps(value, ensure_ascii=False, separators=(",", ":"), allow_nan=False)
    except ValueError:
        value = json.loads(line, parse_constant=lambda _: None, parse_float=lambda x: y if math.isfinite(y := float(x)) else None)
        plain = json.dumps(value, ensure_ascii=False, separators=(",", ":"))
    return "", plain.encode("utf-8", "replace").decode()


def _records(batches):
    """(file, block, at, reason, json, raw) of the lines (file, block, raw) that are not blank, in one pass; at counts a
    split's lines, and the row of a split's last one also holds how many it has."""
    import pyarrow as pa

    key, at = None, 0
    for batch in batches:
        files, blocks, raws = (batch.column(i).to_pylist() for i in range(3))
        rows = []
        for file, block, raw in zip(files, blocks, raws, strict=True):
            if key != (file, block):
                key, at = (file, block), 0
            at += 1
            if raw and not raw.isspace():
                reason, plain = parsed(raw)
                rows.append((file, block, at, reason, plain, raw if reason else None))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "at", "reason", "json", "raw"])


def _text(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, raw): a task reads a split from its beginning to its end."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("raw"))


def _splits(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, before): the lines of a file that come before each of its splits."""
    splits = _text(spark, path).groupBy("file", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return cut(splits.select("file", "block", F.coalesce(before, F.lit(0)).alias("before")))


def scanned(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_number, reason, json, raw) of all lines that are not blank; numbers count from 1 and count blank lines too.

    Files are read in splits: lines are counted once, then parsed once, and a line's number is its place in its
    split plus the lines of the splits before it. Nothing is copied, and no file is read in one task.
    """
    rows = _text(spark, path).mapInArrow(_records, "file string, block long, at long, reason string, json string, raw string")
    return rows.join(_splits(spark, path), ["file", "block"]).select("file", (F.col("before") + F.col("at")).alias("line_number"), "reason", "json", "raw")


def read_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records: file, line_number, json; rejects: reason, file, line_number, raw)."""
    lines = scanned(spark, path)
    return lines.where("reason = ''").select("file", "line_number", "json"), lines.where("reason <> ''").select("reason", "file", "line_number", "raw")


def read_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Records by schema, with _line_number; a line that is no JSON object fails the query."""
    at = F.concat_ws(" ", F.col("reason"), F.lit("in line"), F.col("line_number").cast("string"), F.lit("of"), F.col("file"))
    record = F.when(F.col("reason") == "", F.from_json("json", schema)).otherwise(F.raise_error(at))
    return scanned(spark, path).select(record.alias("r"), F.col("line_number").alias("_line_number")).select("r.*", "_line_number")


def first_lines(spark: SparkSession, path: str, lines: int = 5) -> list[str]:
    """The first lines of a path that are not blank, file by file in the order of their names. Only the files' beginnings are read."""
    target, fs = hadoop(spark, path)
    found = fs.globStatus(target)
    listed = sorted(str(y.getPath()) for x in found or [] for y in (fs.listStatus(x.getPath()) if x.isDirectory() else [x]) if y.isFile())
    out: list[str] = []
    for file in listed:
        if file.rsplit("/", 1)[-1].startswith(("_", ".")):
            continue
        rows = spark.read.text(file).where(F.col("value").rlike(r"\S"))
        out += [r["value"] for r in rows.limit(lines - len(out)).collect()]  # limit takes from the first split on
        if len(out) >= lines:
            break
    return out[:lines]


def sniff(spark: SparkSession, path: str, lines: int = 5) -> str:
    """The dialect of the first lines that are not blank; lines that are no JSON count among them. More than one dialect is an error."""
    from siftwell.sources.dialects import dialect_of

    objects = [plain for reason, plain in map(parsed, first_lines(spark, path, lines)) if not reason]
    rows = spark.createDataFrame([(x,) for x in objects], "json string")
    found = {r["d"] for r in rows.select(dialect_of(F.col("json")).alias("d")).collect()} - {""}
    if "invalid" in found:
        raise ValueError("a record has some names of a dialect but is none")
    if len(found) != 1:
        raise ValueError(f"{'mixed dialects' if found else 'no known dialect'} in the first {lines} lines")
    return found.pop()


def canonical_json(row: Column) -> Column:
    """A struct as one line: nulls kept, separators compact, Unicode line ends as spaces."""
    return F.translate(F.to_json(row, {"ignoreNullFields": "false"}), "  ", "  ")


def write_lines(rows: DataFrame, path: str, order: str = "row_ord", single: bool = False) -> None:
    """Writes rows as JSON lines in order, without order and names that begin with _; readers see all of it or none.

    The new folder is written beside the old one. When it is complete the old one is set aside, the new one
    takes its name, and the old one goes; after a crash in between, settle() or the next write brings back
    whichever is whole. single gives one file, for deliverables of bounded size.
    """
    spark, path = rows.sparkSession, path.rstrip("/")
    settle(spark, path)
    names = [c for c in rows.columns if not c.startswith("_") and c != order]
    out = rows.select(*([order] if order in rows.columns else []), canonical_json(F.struct(*names)).alias("value"))
    out = out.orderBy(order).select("value") if order in out.columns else out
    (out.coalesce(1) if single else out).write.mode("overwrite").text(f"{path}.writing")
    aside = f"{path}.before-{uuid.uuid4().hex}"
    if hadoop(spark, path)[1].exists(hadoop(spark, path)[0]):
        _rename(spark, path, aside)
    _rename(spark, f"{path}.writing", path)
    target, fs = hadoop(spark, aside)
    fs.delete(target, True)


def settle(spark: SparkSession, path: str) -> None:
    """Ends what a crash of write_lines has left: a missing folder comes back from the one set aside; leftovers go."""
    target, fs = hadoop(spark, path.rstrip("/"))
    aside = sorted(str(s.getPath()) for s in fs.globStatus(hadoop(spark, f"{path.rstrip('/')}.before-*")[0]) or [])
    if aside and not fs.exists(target):
        _rename(spark, aside.pop(), str(target))
    for old in aside:
        fs.delete(hadoop(spark, old)[0], True)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    source, fs = hadoop(spark, old)
    if not fs.rename(source, hadoop(spark, new)[0]):
        raise OSError(f"can't move {old} to {new}")


def with_order(records: DataFrame) -> DataFrame:
    """records with row_ord by file and line."""
    return numbered(records, "file", "line_number")
