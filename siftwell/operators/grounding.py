"""Quotes of known passages in texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.functions.text import grounding_form

#: Passages of about so many bytes are searched in one pass over the texts.
BLOCK_BYTES = 4 << 20


def quoted(texts: DataFrame, passages: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(row_ord, passage) for every passage (passage, text) that a text (row_ord, text) holds in its grounding form.

    The passages are a given set; they are searched in blocks, each a pass over the texts with an automaton that
    finds all of them at once (Aho-Corasick), so a text costs its length whatever their number. Nothing is
    shuffled, and a block's passages are all that a task holds. Passages without a character are in every text.
    """
    import ahocorasick  # noqa: F401  fails here rather than on the executors

    known = passages.where("passage is not null").select(F.col("passage").cast("long").alias("passage"), grounding_form(F.col("text")).alias("form"))
    total = known.agg(F.sum(F.octet_length("form"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    rows = texts.select(F.col("row_ord").cast("long").alias("row_ord"), grounding_form(F.col("text")).alias("form"))
    empty = known.where("form = ''").select("passage")
    out = rows.select("row_ord").join(F.broadcast(empty), F.lit(True)) if not empty.isEmpty() else None  # a stated set against all rows
    for b in range(blocks):
        part = known.where((F.pmod(F.xxhash64("passage"), F.lit(blocks)) == b) & (F.col("form") != "")).collect()
        forms: dict[str, list[int]] = {}
        for r in part:
            forms.setdefault(r["form"], []).append(r["passage"])
        found = rows.mapInArrow(_searcher(forms), "row_ord long, passage long")
        out = found if out is None else out.union(found)
    return out


def _searcher(forms: dict[str, list[int]]):
    def search(batches):
        import ahocorasick
        import pyarrow as pa

        automaton = ahocorasick.Automaton()
        for form, ids in forms.items():
            automaton.add_word(form, ids)
        automaton.make_automaton()
        for batch in batches:
            left, right = [], []
            for row, form in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = {i for _, some in automaton.iter(form) for i in some} if forms else ()
                left += [row] * len(ids)
                right += sorted(ids)
            yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["row_ord", "passage"])

    return search
