"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star edges."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import as_bytes, hashed_words, mix, slices, stored, table
from siftwell.operators.components import connected_components

#: One permutation is cut into BINS bins; BANDS bands of ROWS bins find a pair of similarity 0.8 with probability 1 - 3e-6.
BINS, BANDS, ROWS = 256, 42, 6
WIDTH, NUM, DEN = 4, 80, 100
#: Members that one task slice compares with a centre.
CHUNK = 256
#: Up to so many rows of ids or buckets (60 bytes each at most) are broadcast; beyond, both sides of the join are shuffled.
BROADCAST_IDS = 400_000

_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """Each text's sorted distinct hashed shingles of width words; a shorter text is one shingle, an empty one has none."""
    words, at = hashed_words(texts)
    n = len(words)
    full = words[: max(0, n - width + 1)].copy()
    for k in range(1, width):
        full = full * _FACTOR + words[k : k + len(full)]
    full = mix(full)
    out = []
    for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if e - s >= width:
            x = np.sort(full[s : e - width + 1])
            out.append(x[np.concatenate(([True], x[1:] != x[:-1]))])
        elif e > s:
            h = np.array([e - s], dtype=np.uint64)
            for k in range(s, e):
                h = h * _FACTOR + words[k]
            out.append(mix(h))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _probes(rounds: int) -> np.ndarray:
    """For each attempt and bin, the bin that an empty bin asks next (a 2-universal draw, alike in all tasks)."""
    x = np.arange(rounds * BINS, dtype=np.uint64)
    return (mix(x * np.uint64(0x2545F4914F6CDD1D) + np.uint64(77)) % np.uint64(BINS)).astype(np.int64).reshape(rounds, BINS)


_PROBES = _probes(4096)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """The bucket keys (len(sets) x BANDS) of sets that are not empty."""
    d = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(d), [len(x) for x in sets])
    cell = owner * BINS + (values >> np.uint64(56)).astype(np.int64)
    first = np.concatenate(([True], cell[1:] != cell[:-1]))  # the sets are sorted: the first of a bin is its minimum
    sig = np.zeros(d * BINS, dtype=np.uint64)
    filled = np.zeros(d * BINS, dtype=bool)
    sig[cell[first]] = values[first]
    filled[cell[first]] = True
    empty, attempt, source = np.flatnonzero(~filled), 0, filled
    while len(empty):
        row, col = empty // BINS, empty % BINS
        ask = row * BINS + (_PROBES[attempt][col] if attempt < len(_PROBES) else (col + attempt) % BINS)
        ok = source[ask]
        sig[empty[ok]] = sig[ask[ok]]
        empty, attempt = empty[~ok], attempt + 1
    rows = sig.reshape(d, BINS)[:, : BANDS * ROWS].reshape(d, BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (d, BANDS)).copy()
    for k in range(ROWS):
        key = mix(key * _FACTOR + rows[:, :, k])
    return key.view(np.int64)


def _sketch(batches):
    import pyarrow as pa

    for batch in batches:
        ids, texts = batch.column(0), as_bytes(batch.column(1))
        for s, e in slices(texts):
            sets = shingle_sets(texts[s:e])
            some = [x for x in sets if len(x)]
            keys = iter(band_keys(some)) if some else iter(())
            sums = [(int(x.sum()), int(mix(x).sum())) for x in some]
            sig = iter([f"{len(x):x}.{a & (1 << 64) - 1:x}.{b & (1 << 64) - 1:x}" for x, (a, b) in zip(some, sums, strict=True)])
            yield pa.record_batch(
                [ids.slice(s, e - s), pa.array([len(x) for x in sets], pa.int64()), pa.array([next(sig) if len(x) else None for x in sets], pa.string()), pa.array([next(keys) if len(x) else None for x in sets], pa.list_(pa.int64()))],
                names=["id", "n", "sig", "keys"],
            )


def linked(a: np.ndarray, b: np.ndarray, num: int = NUM, den: int = DEN) -> bool:
    """Whether two sorted sets have den * intersection >= num * union."""
    if min(len(a), len(b)) * den < num * max(len(a), len(b)):
        return False
    at = np.searchsorted(b, a)
    same = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return den * same >= num * (len(a) + len(b) - same)


def _verify(batches):
    """Rows (centre, part, is_member, id, text), a centre before its members: the pairs that are linked.

    Of a centre's rows with different texts, each counts.
    """
    import pyarrow as pa

    now, centres = None, []
    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(4)]
        texts, left, right = as_bytes(batch.column(4)), [], []
        for s, e in slices(texts):
            for c, member, i, x in zip(cols[0][s:e], cols[2][s:e], cols[3][s:e], shingle_sets(texts[s:e]), strict=True):
                if not member:
                    if now != c:
                        now, centres = c, []
                    if not any(np.array_equal(x, y) for y in centres):
                        centres.append(x)
                elif now == c and any(linked(y, x) for y in centres if len(y) and len(x)):
                    left.append(c)
                    right.append(i)
        yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _if_few(ids: DataFrame, most: int = BROADCAST_IDS) -> DataFrame:
    """A stored table, marked for a broadcast if its rows are few; the join gives the same rows either way.

    Beyond that both sides are stored, so adaptive execution can split a key that holds many rows.
    """
    return F.broadcast(ids) if ids.count() <= most else ids


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the candidate pairs (a: centre, b: member, bigint), those linked by their full sets.

    Each member's text travels once for each of its centres, a centre's once for each CHUNK members;
    they meet sorted in one stream, so no group is held, and a centre with many members is spread out.
    """
    load = pairs.groupBy("a").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("parts"))
    place = pairs.join(load, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    place = stored(place)
    members = place.select(F.col("b").alias("id"), "a", "part", F.lit(True).alias("member"))
    centres = place.select(F.col("a").alias("id"), "a", "part", F.lit(False).alias("member")).distinct()
    wanted = texts.join(_if_few(stored(members.union(centres))), "id").select("a", "part", "member", "id", "text")
    n = max(1, int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return wanted.repartition(n, "a", "part").sortWithinPartitions("a", "part", "member").mapInArrow(_verify, "a long, b long")


def _shingle_rows(batches):
    import pyarrow as pa

    for batch in batches:
        ids, texts = batch.column(0), as_bytes(batch.column(1))
        for s, e in slices(texts):
            sets = shingle_sets(texts[s:e])
            yield pa.record_batch([ids.slice(s, e - s), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))], names=["class", "n", "shingles"])


def _could_link(own: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (low, high) of the classes of own (class, component) in different components; no linked pair is left out.

    Shingles are ordered by how many of these classes have them. Two sets of sizes n and m are linked
    only if NUM / (NUM + DEN) of n + m shingles are in both, so the first one in both stands early
    enough in each, and within the first n - NUM / DEN * n + 1. Rare shingles come first, so a passage that many
    texts share is seldom compared by.
    """
    found = stored(texts.join(_if_few(own.select(F.col("class").alias("id"))), "id", "left_semi").mapInArrow(_shingle_rows, "class long, n long, shingles array<long>"))
    rows = stored(found.select("class", "n", F.explode("shingles").alias("shingle")).distinct())  # rows with equal ids and texts
    often = stored(rows.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1"))
    ranked = rows.join(often, "shingle").groupBy("class", "n").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("s"))
    # shingles of one class alone come before all others; at is 0-based
    first = ranked.withColumn("alone", F.col("n") - F.size("s")).withColumn("take", F.col("n") - F.ceil(F.col("n") * NUM / DEN) + 1 - F.col("alone")).where("take > 0")
    first = first.select("class", "n", "alone", F.posexplode(F.slice("s", F.lit(1), F.col("take").cast("int"))).alias("k", "x")).select("class", "n", (F.col("alone") + F.col("k")).alias("at"), F.col("x.shingle").alias("shingle"))
    first = stored(first.join(own, "class"))
    mixed = first.groupBy("shingle").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2").select("shingle")
    first = stored(first.join(mixed, "shingle"))
    a, b = (first.select("shingle", *[F.col(c).alias(f"{c}{k}") for c in ("class", "n", "at", "component")]) for k in (1, 2))
    enough = f"class1 < class2 and component1 <> component2 and least(n1 - at1, n2 - at2) * {NUM + DEN} >= {NUM} * (n1 + n2)"
    return a.join(b, "shingle").where(enough).select(F.col("class1").alias("low"), F.col("class2").alias("high")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of docs.

    Words lie between ASCII white space, A-Z lower-cased; a text's set holds its distinct 4-word
    shingles. Texts with equal sets form a class at once. In each bucket of a band the classes are
    compared with one centre (a star instead of all pairs), and linked if their full sets have a
    Jaccard similarity of 0.8 or more. The centre is the class that meets most others in all its
    buckets, which in a group of near copies is the text they stem from. In buckets that still hold
    several components the next such class is the centre, for the classes outside its component,
    round after round until a round finds no further link (two rounds at least). Buckets that then still
    hold several components among the classes that were no centre are finished by an exact search
    (prefixes of the sets, rare shingles first) among these classes, so every linked pair that shares a
    bucket ends in one component. No bucket is capped.

    A null or empty text, or one of white space only, is in a component of its own. Rows with the
    same id are one document, which is linked wherever one of its texts is; its empty texts stand alone.
    A row without an id gets neither component nor kept = true. Ties of centres go to the smaller id. A
    text of any length is one task's, which holds some 40 bytes for each of its words besides the text.
    Other columns are ignored. Ids are integers.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketch = stored(texts.mapInArrow(_sketch, "id long, n long, sig string, keys array<long>"))
    heads = stored(sketch.where("sig is not null and id is not null").groupBy("sig").agg(F.min("id").alias("class")))
    several = stored(sketch.where("sig is not null and id is not null").groupBy("id").agg(F.min("sig").alias("s1"), F.max("sig").alias("s2")).where("s1 <> s2").select("id"))
    links = None
    if not several.isEmpty():  # texts of one document belong together
        own = sketch.select("id", "sig").join(several, "id").distinct().join(heads, "sig")
        links = stored(own.groupBy("id").agg(F.min("class").alias("a")).join(own, "id").select("a", F.col("class").alias("b")).where("a <> b"))
    keyed = sketch.join(heads.select(F.col("class").alias("id"), F.col("sig").alias("head")), "id").where("sig = head")
    member = keyed.select(F.col("id").alias("class"), F.explode("keys").alias("bucket")).distinct()  # a key holds its band's number
    size = member.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(member.join(_if_few(stored(size)), "bucket"))
    weight = stored(shared.groupBy("class").agg(F.sum(F.col("size") - 1).alias("weight")))
    shared = stored(shared.join(weight, "class").select("bucket", "class", "size", F.struct("weight", (-F.col("class")).alias("order")).alias("rank")))

    texts = stored(texts.join(_if_few(stored(shared.select(F.col("class").alias("id")).distinct())), "id", "left_semi"))  # others meet nothing

    seen, groups, used, turn = None, None, None, 0
    while True:
        if turn == 0:
            hubs = stored(shared.groupBy("bucket").agg(F.max_by("class", "rank").alias("hub")))
            pairs = shared.join(_if_few(hubs), "bucket").select(F.col("hub").alias("a"), F.col("class").alias("b"))
        else:
            in_group = groups.select(F.col("node").alias("class"), "component")
            wide = shared.where("size > 2").join(in_group, "class", "left").withColumn("component", F.coalesce("component", "class"))
            mixed = stored(wide.groupBy("bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2").select("bucket"))
            wide = stored(wide.join(_if_few(mixed), "bucket").select("bucket", "class", "rank", "component"))
            free = stored(wide.join(used.withColumnRenamed("hub", "class"), ["bucket", "class"], "left_anti"))
            hubs = stored(free.groupBy("bucket").agg(F.max_by(F.struct("class", "component"), "rank").alias("h")).select("bucket", F.col("h.class").alias("hub"), F.col("h.component").alias("own")))
            pairs = wide.join(_if_few(hubs), "bucket").where("component <> own").select(F.col("hub").alias("a"), F.col("class").alias("b"))
            hubs = hubs.select("bucket", "hub")
        used = hubs if used is None else used.union(hubs)
        pairs = pairs.where("a <> b").withColumns({"low": F.least("a", "b"), "high": F.greatest("a", "b")}).groupBy("low", "high").agg(F.min("a").alias("a"))
        pairs = pairs.select("low", "high", "a", (F.col("low") + F.col("high") - F.col("a")).alias("b"))
        if seen is not None:
            pairs = pairs.join(seen, ["low", "high"], "left_anti")
        pairs = stored(pairs)
        found = stored(confirmed(pairs.select("a", "b"), texts))
        seen = pairs.select("low", "high") if seen is None else seen.union(pairs.select("low", "high"))
        if turn and found.isEmpty():
            break
        links = found if links is None else links.union(found)
        groups = connected_components(links, stored)
        turn += 1
    # a centre has met all classes outside its component: where three or more were free before the last round, pairs can be left
    mixed = free.groupBy("bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2"), F.count("*").alias("n")).where("c1 <> c2 and n > 2").select("bucket")
    own = stored(free.join(mixed, "bucket").select("class", "component").distinct())
    if not own.isEmpty():
        pairs = stored(_could_link(own, texts).join(seen, ["low", "high"], "left_anti").select(F.col("low").alias("a"), F.col("high").alias("b")))
        found = stored(confirmed(pairs, texts))
        groups = connected_components(links.union(found), stored)
    component = groups.select(F.col("node").alias("class"), "component")
    by_sig = stored(heads.join(component, "class", "left").select("sig", F.coalesce("component", "class").alias("component")))
    return (
        sketch.select("id", "n", "sig").join(by_sig, "sig", "left")
        .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
    )


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
