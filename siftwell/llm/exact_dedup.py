"""Exact dedup by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import ascii_lower, stored, table

PREFIX_CHARS = 128
#: Shared prefix groups are marked in bitmaps of BITS bits, SPARE bits for each group, in MAX_BITMAPS bitmaps (32 MB) at most.
BITS, SPARE, MAX_BITMAPS = 32768, 64, 8192


def _bitmaps(groups: DataFrame, most: int) -> tuple[DataFrame, int]:
    """(map, bits) tables that mark the groups (n, head), and how many maps there are; both bounded by most."""
    wanted = groups.count() * SPARE // BITS
    maps = min(most, 1 << max(0, wanted).bit_length())
    at = _place(maps)
    # one task makes each map, from 12 bytes for each group
    dealt = groups.select(F.floor(at / BITS).alias("map"), (at % BITS).alias("bit"))
    return stored(dealt.repartition("map").groupBy("map").agg(F.bitmap_construct_agg("bit").alias("bits"))), maps


def _place(maps: int) -> Column:
    return F.pmod(F.xxhash64("n", "head", F.lit(maps)), F.lit(maps * BITS))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS, max_bitmaps: int = MAX_BITMAPS, carry: dict[str, Column] | None = None) -> DataFrame:
    """(id, keep_id, group_size, kept) for every row of docs, and the columns of carry, computed in the scan.

    Texts are equal when identical after lower-casing A-Z; the row with the largest id stays. Lengths
    that occur once are settled by a count of lengths; the others are refined by a hash of the first
    prefix_chars characters, and only texts whose (length, prefix) is shared are hashed in full. Counts
    and maxima are pre-aggregated, so a text that fills a third of the table costs no task more than
    others. The shared (length, prefix) groups reach the scan of texts as bitmaps by their hash, 32 MB
    at most however many they are; a text that meets another group's bit is hashed in vain, and counts as
    the single text that it is. In no case do texts move between machines.

    A null text counts as empty; empty texts equal each other. Rows with the same id and text are one
    document, so each of them has the same kept. A row without an id never wins against one with an
    id; in a group of such rows only, keep_id is null and kept is true. Texts of any length are hashed
    whole. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    carry = {f"carry {k}": v for k, v in (carry or {}).items()}
    base = docs.select(F.col(id_col).alias("id"), text.alias("text"), *[v.alias(k) for k, v in carry.items()]).withColumn("n", F.length("text"))
    head = F.xxhash64(ascii_lower(F.substring("text", 1, prefix_chars)))
    light = stored(base.select("n", head.alias("head")))
    lengths = light.groupBy("n").agg(F.count("*").alias("rows"))
    shared_n = lengths.where("rows > 1").select("n")
    prefixes = stored(light.groupBy("n", "head").agg(F.count("*").alias("rows")).where("rows > 1").join(shared_n, "n").select("n", "head"))
    bitmaps, maps = _bitmaps(prefixes, max_bitmaps)
    full = F.sha2(ascii_lower(F.col("text")), 256)
    rows = base.withColumn("head", head).withColumn("place", _place(maps)).withColumn("map", F.floor(F.col("place") / BITS))
    rows = rows.join(F.broadcast(bitmaps), "map", "left")  # MAX_BITMAPS rows of 4 KB at most
    bit = F.col("place") % BITS
    byte = F.conv(F.hex(F.substring("bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.bit_get(byte, (bit % 8).cast("int")) == 1
    rows = stored(rows.select("id", "n", F.when(hit, full).alias("digest"), *carry))
    groups = rows.where("digest is not null").groupBy("n", "digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1")
    groups = stored(groups)  # so that a skewed join can split a group that is large
    out = rows.join(groups, ["n", "digest"], "left")
    single = F.col("group_size").isNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(single, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(single, True).otherwise(F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        *[F.col(k).alias(k.removeprefix("carry ")) for k in carry],
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carries the digest of each normalised text along."""
    digest = F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256)
    return exact_duplicates(table(spark, sf_dir, "documents"), carry={"text_sha256": digest})


ORACLE = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""
