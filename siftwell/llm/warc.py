"""WARC archives: writing, and reading with boundary-chain verification."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.llm.common import scratch_dir, stored, table

MAGIC = b"WARC/1.0\r\n"
END = "\r\n\r\n"
#: Shorter payloads are always written in full.
MIN_REVISIT_BYTES = 1000
#: Up to so many revisits (16 bytes each) are broadcast; beyond, the pages are shuffled by page_id.
BROADCAST_REVISITS = 500_000
#: Records that lie in several chunks meet these by stretches of so many bytes of a file.
STRETCH = 1 << 20

_FIELDS = {"warc-type": "record_type", "warc-record-id": "record_id", "warc-refers-to": "refers_to", "warc-target-uri": "url", "warc-payload-digest": "header_digest", "warc-payload-length": "header_bytes"}
_NAMES = [*_FIELDS.values()]
_LIGHT = "file string, block long, kind string, rel long, succ long, exit long, complete boolean, head long, bytes long, digest string, " + ", ".join(f"{x} string" for x in _NAMES)


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES, broadcast_revisits: int = BROADCAST_REVISITS) -> None:
    """Writes one record per page (page_id, url, html) into archives below path, each task its own.

    Of equal payloads of at least min_bytes bytes, the page with the largest page_id is a response and
    the others are revisits that refer to it and hold no payload. Spark's text writer commits the
    files, so a task that runs twice leaves one copy. A null html is an empty payload; a null url and
    a null page_id leave their header out. Rows with the same page_id and payload are all responses.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    base = base.withColumns({"bytes": F.octet_length("html").cast("long"), "digest": F.sha1(F.col("html").cast("binary"))})
    long = stored(base.where((F.col("bytes") >= min_bytes) & F.col("page_id").isNotNull()).select("page_id", "digest", "bytes"))
    first = stored(long.groupBy("digest", "bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"))
    revisits = stored(long.join(first, ["digest", "bytes"]).where("page_id <> refers_to").select("page_id", "digest", "refers_to").distinct())
    few = revisits.count() <= broadcast_revisits
    rows = base.join(F.broadcast(revisits) if few else revisits, ["page_id", "digest"], "left")
    again = F.col("refers_to").isNotNull()
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.col(c).cast("string"), F.lit(">"))
    lines = [
        F.lit(MAGIC.decode().strip()),
        F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn("page_id")),
        F.lit("WARC-Date: 2000-01-01T00:00:00Z"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]+", " ")),
        F.concat(F.lit("WARC-Refers-To: "), urn("refers_to")),
        F.when(again, "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("bytes").cast("string")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(again, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
    ]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit(END), F.when(again, "").otherwise(F.col("html")))
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


def _header(chunk: bytes) -> tuple[int, int, dict] | None:
    """(end of the header, Content-Length, fields) of a chunk that follows a magic, or None."""
    at = chunk.find(b"\r\n\r\n")
    if at < 0:
        return None
    fields = {}
    for line in chunk[:at].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    length = fields.get("content-length", "")
    return (at + 4, int(length), fields) if length.isascii() and length.isdigit() and len(length) < 19 else None


def _candidates(batches):
    """Rows (file, block, value) in the order of the file: for each magic a row with the offsets of its record and of
    the one after, relative to the split's first chunk; exit is where its chain leaves the split. One more row for each split."""
    import pyarrow as pa

    names = ["file", "block", "kind", "rel", "succ", "exit", "complete", "head", "bytes", "digest", *_NAMES]
    types = {"block": pa.int64(), "rel": pa.int64(), "succ": pa.int64(), "exit": pa.int64(), "complete": pa.bool_(), "head": pa.int64(), "bytes": pa.int64()}
    key, found, at, last = None, [], 0, False

    def done():
        exits = {}
        for row in reversed(found):
            succ = row.get("succ")
            # the next split's first magic ends where this split's last chunk is counted to
            row["exit"] = exits[row["rel"]] = succ if succ is None or succ >= at - len(MAGIC) else exits.get(succ)
        rows = [*found, {"file": key[0], "block": key[1], "kind": "split", "rel": at}]
        return pa.record_batch([pa.array([x.get(n) for x in rows], types.get(n, pa.string())) for n in names], names=names)

    for batch in batches:
        for file, block, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
            first = key != (file, block)
            if first:
                if key is not None:
                    yield done()
                key, found, at = (file, block), [], 0
            if not first or block:  # what stands before a file's first magic is no record
                row = {"file": file, "block": block, "kind": "record", "rel": at - len(MAGIC)}
                if head := _header(value):
                    end, length, fields = head
                    row |= {"head": end, "succ": at + end + length + len(END), "complete": False, "bytes": length}
                    row |= {_FIELDS[k]: v for k, v in fields.items() if k in _FIELDS}
                    if len(value) == end + length + len(END) and value.endswith(END.encode()):
                        row |= {"complete": True, "digest": hashlib.sha1(value[end : end + length]).hexdigest()}
                found.append(row)
            at += len(value) + len(MAGIC)
    if key is not None:
        yield done()


def _mark(pdf):
    """The rows of one split that its entries reach."""
    pdf = pdf.sort_values("start", kind="stable")
    reached = set(pdf.loc[pdf["entry"], "start"])
    keep = []
    for start, succ in zip(pdf["start"], pdf["succ"], strict=True):
        keep.append(start in reached)
        if keep[-1] and succ == succ:
            reached.add(succ)
    return pdf.loc[keep, ["file", "start"]]


def _pieces(batches):
    """(file, block, rel, value) of every chunk, as _candidates counts them."""
    import pyarrow as pa

    key, at = None, 0
    for batch in batches:
        rels, values = [], batch.column(2).cast(pa.binary())
        for file, block, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), [len(x) for x in values.to_pylist()], strict=True):
            if key != (file, block):
                key, at = (file, block), 0
            rels.append(at - len(MAGIC))
            at += n + len(MAGIC)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(rels, pa.int64()), values], names=["file", "block", "rel", "value"])


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, record_type, record_id, refers_to, url, bytes, digest, header_digest, header_bytes) of the records below path.

    Every scan split takes each magic as a candidate and notes where its record would end. The
    candidates' chains are followed inside a split at once, and by pointer jumping from split to split:
    of a file only the records reachable from its first byte stay, so a magic inside a payload begins
    none. Payloads that hold a magic lie in several chunks and are put together in a second scan, which
    is made only where there are any, and meet their records by stretches of the file. A record with a
    broken length ends its file's chain. An empty
    file has no records. Archives are plain, not compressed; a record must fit into memory.
    """
    light = stored(_chunks(spark, path).mapInArrow(_candidates, _LIGHT))
    before = F.sum("rel").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    base = light.where("kind = 'split'").select("file", "block", F.coalesce(before, F.lit(0)).alias("base"))
    shift = lambda c: (F.col(c) + F.col("base")).alias(c)
    # the first chunk of a file's first split follows no magic, so offsets count from there
    placed = stored(
        light.where("kind = 'record'").join(base, ["file", "block"])
        .select("file", "block", shift("rel").alias("start"), shift("succ"), shift("exit"), "base", "complete", "head", "bytes", "digest", *_NAMES)
    )
    entry = placed.select("file", F.col("exit").alias("start")).where("start is not null").distinct()
    starts = placed.where("start = 0").select("file", "start")
    jump = stored(placed.join(entry.union(starts).distinct(), ["file", "start"], "left_semi").where("exit is not null").select("file", "start", "exit"))
    reached, count = stored(starts), -1
    while (now := reached.count()) != count:
        count = now
        step = reached.join(jump, ["file", "start"]).select("file", F.col("exit").alias("start"))
        reached = stored(reached.union(step).distinct())
        ahead = jump.select("file", F.col("start").alias("exit"), F.col("exit").alias("to"))
        jump = stored(jump.join(ahead, ["file", "exit"]).select("file", "start", F.col("to").alias("exit")))
    flagged = placed.select("file", "block", "start", "succ").join(reached.withColumn("entry", F.lit(True)), ["file", "start"], "left")
    flagged = flagged.withColumn("entry", F.coalesce("entry", F.lit(False)))
    live = flagged.groupBy("file", "block").applyInPandas(_mark, "file string, start long")
    records = stored(placed.join(live, ["file", "start"]).where("succ is not null"))
    out = records.select("file", "start", "record_type", "record_id", "refers_to", "url", "bytes", "digest", "header_digest", "header_bytes")
    wide = records.where("not complete").select("file", "start", "succ", "head")
    if wide.isEmpty():
        return out
    parts = _chunks(spark, path).mapInArrow(_pieces, "file string, block long, rel long, value binary").join(base, ["file", "block"])
    parts = parts.select("file", (F.col("rel") + F.col("base")).alias("at"), "value")
    stretch = lambda c: F.floor(F.col(c) / STRETCH)
    spread = stored(wide.withColumn("stretch", F.explode(F.sequence(stretch("start"), F.floor((F.col("succ") - 1) / STRETCH)))))
    parts = parts.withColumn("stretch", stretch("at"))
    inside = parts.join(F.broadcast(spread) if spread.count() <= BROADCAST_REVISITS else spread, ["file", "stretch"]).where("at >= start and at < succ")
    whole = inside.groupBy("file", "start", "succ", "head").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("p"))
    glued = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, F.lit(MAGIC), x["value"]))
    body = F.substring(glued, F.col("head") + len(MAGIC) + 1, F.col("succ") - F.col("start") - F.col("head") - len(MAGIC) - len(END))
    fixed = whole.select("file", "start", F.sha1(body).alias("digest2"))
    return out.join(fixed, ["file", "start"], "left").withColumn("digest", F.coalesce("digest", "digest2")).drop("digest2")


def page_records(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of records that write_archives has written."""
    again = F.col("record_type") == "revisit"
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).cast("long")
    return records.select(
        page("record_id").alias("page_id"),
        F.when(again, F.col("header_bytes").cast("long")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(again, F.regexp_replace("header_digest", "^sha1:", "")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        F.when(again, page("refers_to")).alias("refers_to"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark)
    write_archives(table(spark, sf_dir, "pages"), path)
    return page_records(read_archives(spark, path))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM q)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM r
"""
