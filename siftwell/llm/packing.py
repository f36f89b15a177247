"""Packing of token ids into windows by the sum-of-squares rule."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import SLICE_BYTES, slices, table
from siftwell.llm.tokens import encoder, tokenizer_path

WINDOW = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"


class SumOfSquares:
    """Windows by fill level; levels[h] counts the open windows that hold h tokens.

    place() puts a piece of s < capacity tokens where the sum of the squared counts becomes least: taking a
    window from level h changes it by 1 - 2 levels[h], adding one to level h + s by 1 + 2 levels[h + s]; a new
    window takes from none, a full one adds to none. Ties go to the fullest window.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.levels = np.zeros(capacity + 1, dtype=np.int64)
        self.open: list[list[list]] = [[] for _ in range(capacity + 1)]

    def place(self, size: int, piece) -> list | None:
        """The window's pieces if it is full now."""
        last = self.capacity - size
        before, after = self.levels[: last + 1], self.levels[size : size + last + 1]
        cost = 2 * (after - before) + 2
        cost[0] = 2 * after[0] + 1
        cost[last] = 1 - 2 * before[last]  # full windows leave the array
        cost[1:][before[1:] == 0] = np.iinfo(np.int64).max
        h = last - int(np.argmin(cost[::-1]))
        window = self.open[h].pop() if h else []
        self.levels[h] -= h > 0
        window.append(piece)
        if h + size == self.capacity:
            return window
        self.levels[h + size] += 1
        self.open[h + size].append(window)
        return None


def power_of_two_at_most(n: int) -> int:
    return 1 << (n.bit_length() - 1)


def pack(documents, capacity: int):
    """(doc, start, length, moved, sequence, offset) of an iterator of (doc, tokens), window by window as they fill.

    A document's full windows come first; what remains is placed whole by the sum-of-squares rule. Of the
    windows that are still open at the end, the fullest stay as the rule has made them, as many as all their
    tokens can fill; the emptiest are taken apart and fill the gaps of those, cut where a gap ends. What is
    left, less than a window, is cut into powers of two, which need no padding. moved tells the pieces that
    no longer lie where the rule put them.
    """
    rule, sequence = SumOfSquares(capacity), 0

    def closed(window):
        at = 0
        for doc, start, length, moved in window:
            yield doc, start, length, moved, sequence, at
            at += length

    for doc, tokens in documents:
        start = 0
        while tokens - start >= capacity:
            yield from closed([(doc, start, capacity, False)])
            sequence, start = sequence + 1, start + capacity
        if start < tokens:
            window = rule.place(tokens - start, (doc, start, tokens - start, False))
            if window:
                yield from closed(window)
                sequence += 1
    left = [window for level in reversed(rule.open) for window in level]  # the fullest first
    total = sum(piece[2] for window in left for piece in window)
    stay = total // capacity
    spare = [piece for window in left[stay:] for piece in window]

    def taken(room: int) -> list[tuple]:
        """Pieces of room tokens in all, off the end of spare."""
        out = []
        while room:
            doc, start, length, _ = spare.pop()
            take = min(room, length)
            out.append((doc, start, take, True))
            if take < length:
                spare.append((doc, start + take, length - take, True))
            room -= take
        return out

    for window in left[:stay]:
        yield from closed([*window, *taken(capacity - sum(piece[2] for piece in window))])
        sequence += 1
    total -= stay * capacity
    while total:
        room = power_of_two_at_most(total)
        yield from closed(taken(room))
        sequence, total = sequence + 1, total - room


def _packer(capacity: int, end_id: int, path: str):
    def packed(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        first, names = TaskContext.get().partitionId() << 32, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "moved"]
        encode, tail = encoder(path).encode, np.array([end_id], dtype="<u4").tobytes()

        def batch_of(rows):
            columns = list(zip(*rows, strict=True))
            return pa.record_batch([*[pa.array(x, pa.int64()) for x in columns[:-1]], pa.array(columns[-1], pa.bool_())], names=names)

        kept: dict[int, list] = {}  # documents with pieces that are still open: [id, ids, tokens that are not yet out]
        out: list[tuple] = []

        def documents():
            n = 0
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
                for s, e in slices(texts, SLICE_BYTES):
                    for doc, packed_ids in zip(ids[s:e], encode(texts[s:e]), strict=True):
                        packed_ids += tail
                        kept[n] = [doc, packed_ids, len(packed_ids) // 4]
                        yield n, len(packed_ids) // 4
                        n += 1

        for n, start, length, moved, sequence, offset in pack(documents(), capacity):
            doc = kept[n]
            out.append((doc[0], start, length, zlib.crc32(doc[1][4 * start : 4 * (start + length)]), len(doc[1]) // 4, first + sequence, offset, moved))
            doc[2] -= length
            if not doc[2]:
                del kept[n]
            if len(out) >= 20_000:
                yield batch_of(out)
                out.clear()
        if out:
            yield batch_of(out)

    return packed


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = WINDOW, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset, moved) of all documents, packed into windows.

    Each task packs the rows of its scan split with a level array of its own, so nothing is shuffled
    and a task that is run again gives the same pieces; its sequence ids begin at its partition number
    times 2^32. Only documents with a piece in an open window are held, and a text of any length while its
    ids are made. Each token lies in one piece; moved marks the pieces that the end of a task has taken
    from where the rule put them, a share that falls as a task's rows grow. Every document ends with end_id, so a null or empty text is one piece of one token. Rows with
    equal or null ids are packed like any other. Other columns are ignored. Ids are integers.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, moved boolean"
    out = rows.mapInArrow(_packer(capacity, end_id, path or tokenizer_path(TOKENIZER)), schema)
    return out.withColumnRenamed("doc_id", id_col)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))
