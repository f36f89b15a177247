"""The most similar sets of each set, without the pairs that do not come first."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.operators.store import cut

# Subsets of a short set, entries that meet in one task, sets whose lists are merged in one task, pairs looked at together,
# postings of long sets that meet in one task.
SUBSETS, ENTRIES, LISTS, CHUNK, POSTINGS = 256, 1_000_000, 10_000, 1 << 20, 200_000
_BLOCK = "part int, said binary"


def least_kept(n: int, threshold: float) -> int:
    """Tokens that a set of n shares at least with a similar one."""
    return max(1, ceil(n * threshold - 1e-9))


def subsets(n: int, threshold: float) -> int:
    return sum(comb(n, c) for c in range(least_kept(n, threshold), n + 1))


def longest_short(threshold: float, anchors: int) -> int:
    """The largest size up to which sets have few subsets, and share one of their anchors rarest tokens with all similar ones."""
    n = 0
    while subsets(n + 1, threshold) <= SUBSETS and n + 1 - least_kept(n + 1, threshold) + 1 <= anchors:
        n += 1
    return n


def _packed(part: np.ndarray, parts: int, *columns: np.ndarray) -> pa.RecordBatch:
    """Columns of 64 bits in one block for each part."""
    order = np.argsort(part, kind="stable")
    said = np.stack([c.view(np.int64) for c in columns])[:, order]
    ends = np.cumsum(np.bincount(part, minlength=parts))
    some = [(k, said[:, a:b].tobytes()) for k, (a, b) in enumerate(zip([0, *ends[:-1]], ends)) if b > a]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in some], pa.int32()), pa.array([x for _, x in some], pa.binary())], names=["part", "said"])


def _unpacked(batches: Iterator[pa.RecordBatch], columns: int) -> np.ndarray:
    blocks = [np.frombuffer(x.as_buffer(), np.int64).reshape(columns, -1) for b in batches for x in b.column("said")]
    return np.concatenate([np.empty((columns, 0), np.int64), *blocks], axis=1)


def _ranges(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, many of each."""
    return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start, many)


def _firsts(asker: np.ndarray, similarity: np.ndarray, pos: np.ndarray, row: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """Of each asker its most similar rows, each once, ties by pos; in this order."""
    order = np.lexsort((-similarity, pos, asker))
    asker, similarity, pos, row = asker[order], similarity[order], pos[order], row[order]
    once = np.ones(len(asker), bool)
    once[1:] = (asker[1:] != asker[:-1]) | (pos[1:] != pos[:-1])
    asker, similarity, pos, row = asker[once], similarity[once], pos[once], row[once]
    order = np.lexsort((pos, -similarity, asker))
    asker, similarity, pos, row = asker[order], similarity[order], pos[order], row[order]
    held = np.arange(len(asker)) - np.searchsorted(asker, asker) < most
    return asker[held], similarity[held], pos[held], row[held]


def _part_of(row: np.ndarray, parts: int) -> np.ndarray:
    return ((row.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(17)) % np.uint64(parts)).astype(np.int64)


def _entries(threshold: float, parts: int):
    """Each set's subsets that a similar set can have in common with it, as sums of its tokens' hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(k) for k in ("h1", "h2")]
            n, start = np.diff(lists[0].offsets.to_numpy()), lists[0].offsets.to_numpy()[:-1] - lists[0].offsets.to_numpy()[0]
            flat = [x.flatten().to_numpy().view(np.uint64) for x in lists]
            row, pos, asks = (batch.column(k).to_numpy() for k in ("row_ord", "pos", "asks"))
            for k in np.unique(n):
                mine = np.flatnonzero(n == k)
                bits = (np.arange(1 << k)[:, None] >> np.arange(k)) & 1
                bits = bits[bits.sum(1) >= least_kept(int(k), threshold)].astype(np.uint64)
                at = start[mine][:, None] + np.arange(k)
                h1, h2 = ((x[at] @ bits.T).ravel() for x in flat)
                of, common = np.repeat(mine, len(bits)), np.tile(bits.sum(1).astype(np.int64), len(mine))
                part = ((h1 >> np.uint64(7)) % np.uint64(parts)).astype(np.int64)
                yield _packed(part, parts, h1, h2, common << 32 | k << 8 | asks[of], pos[of], row[of])

    return run


def _met(threshold: float, most: int, parts: int):
    """What each asking set gets from the sets that have a subset in common with it: of each size the first by pos."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h1, h2, meta, pos, row = _unpacked(batches, 5)
        if not len(row):
            return
        order = np.lexsort((pos, meta >> 8, h2, h1))
        h1, h2, meta, pos, row = h1[order], h2[order], meta[order], pos[order], row[order]
        common, n, asks = meta >> 32, meta >> 8 & 0xFFFFFF, meta & 0xFF
        new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        key = np.cumsum(new) - 1
        del h1, h2, meta
        # groups: the sets of one size that hold one subset
        start = np.flatnonzero(new | np.concatenate([[True], n[1:] != n[:-1]]))
        held = np.minimum(np.diff(np.append(start, len(n))), most)
        groups = np.bincount(key[start])
        first = np.cumsum(groups) - groups
        x = np.flatnonzero((np.bincount(key)[key] > 1) & ((asks == 2) | (asks == 1) & (common == n)))
        many = groups[key[x]]
        g, x = _ranges(first[key[x]], many), np.repeat(x, many)
        similarity = common[x] / (n[x] + n[start[g]] - common[x])
        fits = similarity >= threshold
        g, x, similarity = g[fits], x[fits], similarity[fits]
        ends = np.cumsum(held[g])
        at = 0
        while at < len(g):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, side="right")))
            many = held[g[at:upto]]
            y, a, s = _ranges(start[g[at:upto]], many), np.repeat(x[at:upto], many), np.repeat(similarity[at:upto], many)
            others = (pos[a] != pos[y]) | (s == 1)
            out = _firsts(row[a[others]], s[others], pos[y[others]], row[y[others]], most)
            if len(out[0]):
                yield _packed(_part_of(out[0], parts), parts, *out)
            at = upto

    return run


def _met_long(threshold: float, most: int, short: int, parts: int):
    """The same for pairs with a set that is longer than short: all sets of a token's postings are compared, and only the first are handed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        token, asks, n, pos, row = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in ("token", "asks", "n", "pos", "row_ord"))
        ids = pa.concat_arrays([b.column("ids") for b in held])
        del held
        width, flat = np.diff(ids.offsets.to_numpy()).astype(np.int64), ids.flatten().to_numpy()
        begin = np.cumsum(width) - width
        order = np.lexsort((n, token))
        bounds = np.append(np.flatnonzero(np.diff(token[order], prepend=token[order[0]] - 1)), len(order))
        for a, b in zip(bounds[:-1], bounds[1:]):
            some = order[a:b]
            size, held = n[some], np.concatenate([[0], np.cumsum(width[some])])
            near = np.unique(flat[_ranges(begin[some], width[some])], return_inverse=True)[1]
            own, found, made = np.zeros(near.max() + 1, np.int64), [], 0
            for k in np.flatnonzero(asks[some]):
                x, mine = some[k], near[held[k] : held[k + 1]]
                low = max(ceil(n[x] * threshold - 1e-9), short + 1 if n[x] <= short else 0)
                lo = int(np.searchsorted(size, low))
                hi = int(np.searchsorted(size, np.floor(n[x] / threshold + 1e-9), side="right")) if threshold > 0 else len(size)
                if hi <= lo:
                    continue
                own[mine] = 1
                common = np.add.reduceat(own[near[held[lo] : held[hi]]], held[lo:hi] - held[lo])
                own[mine] = 0
                similarity = common / (n[x] + size[lo:hi] - common)
                y = np.flatnonzero(similarity >= threshold)
                out = _firsts(np.full(len(y), row[x]), similarity[y], pos[some[lo:hi]][y], row[some[lo:hi]][y], most)
                found.append(out)
                made += len(out[0])
                if made > CHUNK:
                    out = [np.concatenate(c) for c in zip(*found)]
                    yield _packed(_part_of(out[0], parts), parts, *out)
                    found, made = [], 0
            if made:
                out = [np.concatenate(c) for c in zip(*found)]
                yield _packed(_part_of(out[0], parts), parts, *out)

    return run


def _merged(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asker, similarity, pos, row = _unpacked(batches, 4)
        asker, similarity, _, row = _firsts(asker, similarity.view(np.float64), pos, row, most)
        ends = np.append(np.flatnonzero(np.diff(asker, prepend=asker[:1] - 1)), len(asker))
        for at in range(0, len(ends) - 1, LISTS):
            some = ends[at : at + LISTS + 1]
            a, b = some[0], some[-1]
            listed = pa.StructArray.from_arrays([pa.array(row[a:b]), pa.array(similarity[a:b])], names=["b", "similarity"])
            yield pa.RecordBatch.from_arrays([pa.array(asker[some[:-1]]), pa.ListArray.from_arrays(pa.array(some - a, pa.int32()), listed)], names=["first", "listed"])

    return run


def nearest(sets: DataFrame, tokens: DataFrame, threshold: float, anchors: int, most: int) -> DataFrame:
    """(first, listed): for each asking set its most similar rows (b, similarity), at most `most`, of threshold or more; ties go by pos.

    sets are (row_ord, tokens, pos, asks): asks is 2 of a set that asks, 1 of one that asks for equal sets only and 0 of one
    that is only offered. A set is compared with those that hold one of its `anchors` rarest tokens, counted in all sets of the
    column tokens of `tokens`, ties by the token.

    Short sets meet at subsets that similar ones can have in common. All sets of one size at a subset are equally
    similar as far as it tells, so of them only the first `most` by pos can be in a list: those before one that shares just this
    subset share it too. So nothing is made for a pair that does not come first, however many sets are similar. Subsets
    travel as sums of two hashes of 64 bits each. Pairs with a longer set meet at the rarest tokens, where
    they are compared in memory and only a set's first ones are handed on: the time grows with the square of
    a token's frequency among them, what is written with the sets.
    """
    spark = sets.sparkSession
    least = spark.sparkContext.defaultParallelism
    short = longest_short(threshold, anchors)
    sizes = {r["n"]: (r["rows"], r["askers"]) for r in sets.groupBy(F.size("tokens").alias("n")).agg(F.count("*").alias("rows"), F.count_if(F.col("asks") > 0).alias("askers")).collect()}
    lists = max(sum(x for _, x in sizes.values()) // LISTS + 1, least)
    parts = max(sum(subsets(n, threshold) * x for n, (x, _) in sizes.items() if n <= short) // ENTRIES + 1, least)
    hashed = (F.transform("tokens", lambda t: F.xxhash64(t)).alias("h1"), F.transform("tokens", lambda t: F.xxhash64(F.lit(7), t)).alias("h2"))
    few = sets.where(F.size("tokens").between(1, short)).select("row_ord", "pos", F.col("asks").cast("long").alias("asks"), *hashed)
    found = few.mapInArrow(_entries(threshold, 4 * parts), _BLOCK).repartition(parts, "part").mapInArrow(_met(threshold, most, 4 * lists), _BLOCK)
    if max(sizes, default=0) > short:
        df = tokens.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
        ids = cut(df.orderBy("df", "token").select("token", F.monotonically_increasing_id().alias("id")))
        n = F.size("tokens")
        able = sets.where(n >= F.lit(max(1, ceil((short + 1) * threshold - 1e-9)))).select("row_ord", "pos", "asks", n.cast("long").alias("n"), F.explode("tokens").alias("token"))
        known = able.join(ids, "token").groupBy("row_ord", "pos", "asks", "n").agg(F.array_sort(F.collect_list("id")).alias("ids"))
        # the rarest common token is in the prefixes of both, and is an anchor if any common one is; tokens of one set alone come first
        prefix = F.least(F.size("ids"), F.size("ids") - F.greatest(F.ceil(F.col("n") * threshold - 1e-9), F.lit(1)) + 1)
        known = cut(known.where(prefix > 0).withColumn("prefix", prefix.cast("int")))
        posted = known.select("*", F.posexplode(F.slice("ids", F.lit(1), F.col("prefix"))).alias("place", "token"))
        asks = (F.col("asks") == 2) & (F.col("place") < anchors) | (F.col("asks") == 1) & (F.col("place") == 0) & (F.col("n") > short)
        posted = posted.select("token", asks.alias("asks"), "n", "pos", "row_ord", "ids")
        many = max((known.agg(F.sum("prefix")).first()[0] or 0) // POSTINGS + 1, least)
        found = found.union(posted.repartition(many, "token").mapInArrow(_met_long(threshold, most, short, 4 * lists), _BLOCK))
    return found.repartition(lists, "part").mapInArrow(_merged(most), "first long, listed array<struct<b: long, similarity: double>>")
