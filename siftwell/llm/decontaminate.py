"""Benchmark decontamination: CGK embedding of word windows, bit-sampling LSH, exact edit verification."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import as_bytes, hash_spans, mix, runs, slices, table

#: A passage matches an item of n words when it differs from it by EDITS * n insertions, deletions and replacements of words at most.
EDITS = 0.2
#: Items with fewer words may not be changed at all (EDITS of them is no whole word) and are searched as they stand.
MIN_WORDS = 5
#: Share of simulated passages with the most edits allowed, of each kind, that repetitions are added for; symbols in a key, keys for each walk, walks beyond which building an index fails.
RECALL, SYMBOLS, SAMPLES, MAX_WALKS = 0.98, 3, 8, 400
#: Longer items are searched by parts of about equal length. Of the edits of a passage, one part at least has no more than its share.
PART_WORDS = 64
#: Items whose lengths differ by this factor at most share windows of one size.
LENGTH_STEP = 1.15
#: Item texts of about so many bytes are searched in one pass over the documents.
BLOCK_BYTES = 4 << 20

_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of lower-cased UTF-8 text.

    Words are runs of letters and digits. Signs and spaces of the blocks Latin-1, General Punctuation, CJK
    and full-width forms divide words as ASCII ones do; characters of scripts that are written without
    spaces (Chinese, Japanese, Thai, Lao, Burmese, Khmer) are words of their own.
    """
    mask = _WORD[data]
    if not (data >= 0xC2).any():
        return runs(mask)
    # the bytes that follow each, 0 after the end
    second, third = np.append(data[1:], np.uint8(0)), np.append(data[2:], np.zeros(min(2, len(data)), np.uint8))
    two = data == 0xC2
    wide = (third < 0x90) | ((third >= 0x9A) & (third < 0xA1))
    three = ((data == 0xE2) & (second <= 0x81)) | ((data == 0xE3) & (second == 0x80)) | ((data == 0xEF) & (second == 0xBC) & wide)
    lone = (data >= 0xE3) & (data <= 0xE9) & ~three
    lone |= (data == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    lone |= (data == 0xE1) & (((second >= 0x80) & (second <= 0x82)) | (second == 0x9E) | (second == 0x9F))
    for k in range(3):
        mask[k:][three[: len(three) - k]] = False
        if k < 2:
            mask[k:][two[: len(two) - k]] = False
    cut = lone.copy()  # a word begins at a lone character and after it
    cut[3:] |= lone[:-3]
    before, after = np.append(False, mask[:-1]), np.append(mask[1:], False)
    return np.flatnonzero(mask & (~before | cut)), np.flatnonzero(mask & (~after | np.append(cut[1:], True))) + 1


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, A-Z lower-cased, and where each text's words begin; a 0 ends each text."""
    data = np.frombuffer((b"\n".join(texts) + b"\n").lower(), dtype=np.uint8)
    starts, ends = word_spans(data)
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(x) + 1 for x in texts], out=at[1:])
    first = np.searchsorted(starts, at)
    out = np.zeros(len(starts) + len(texts), dtype=np.uint64)
    out[np.arange(len(starts)) + np.searchsorted(at, starts, side="right") - 1] = hash_spans(data, starts, ends) | np.uint64(1)
    return out, first + np.arange(len(texts) + 1)


def walk(words: np.ndarray, at: np.ndarray, number: int, steps: int, wanted: np.ndarray, coins: dict[int, np.ndarray]) -> np.ndarray:
    """The CGK embedding of the strings that start at the given places: symbols at the wanted steps (places x wanted).

    At each step the walk puts out its symbol and moves on by a random bit of the step and the symbol,
    the same for all strings, so strings that differ by few edits soon fall into step again. A walk sees
    about half as many words as it has steps; those with odd numbers go backwards, from the places of last
    words, so that both halves of a string are seen. The 0 that ends a text holds the walk (the one
    before the first text is the last one). coins keeps the bits of one number's steps for these words.
    """
    out = np.zeros((len(at), len(wanted)), dtype=np.uint64)
    place = at.copy()
    column = {int(s): k for k, s in enumerate(wanted)}
    for step in range(steps):
        if step // 64 not in coins:
            coin = mix(words + np.uint64((number * 4096 + step // 64 + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            coin[words == 0] = 0
            coins[step // 64] = coin
        if step in column:
            out[:, column[step]] = words[place]
        bit = ((coins[step // 64][place] >> np.uint64(step % 64)) & np.uint64(1)).astype(np.int64)
        place += -bit if number % 2 else bit
    return out


def word_pairs(words: np.ndarray) -> np.ndarray:
    """A hash of each word with the next; the last one has no meaning."""
    return mix(words * np.uint64(0xD6E8FEB86659FD93) + np.append(words[1:], np.uint64(0)))


def runs_of(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words from each place on, where that many follow."""
    out = words[: max(0, len(words) - n + 1)].copy()
    for k in range(1, n):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[k : k + len(out)]
    return mix(out)


def edit_distance_inside(item: list[int], text: list[int], most: int) -> int | None:
    """The least edit distance between item and a part of text, if it is most or less (Myers' bit vectors)."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    m = len(item)
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = score
    for w in text:
        eq = masks.get(w, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | (full & ~(xh | plus)), plus & xh
        score += bool(up & high) - bool(down & high)
        best = min(best, score)
        up, down = (up << 1) & full, (down << 1) & full  # a match may begin anywhere in text
        plus, minus = down | (full & ~(xv | up)), up & xv
    return best if best <= most else None


@dataclass
class LengthClass:
    """Parts of items of about one length: window size, the steps each repetition samples, and each walk's sorted keys with their parts."""

    size: int
    least: int  # pairs of neighbouring words that a window must share with the items
    steps: int
    parts: list[tuple[int, int, int]]  # item, first word, words
    samples: list[np.ndarray] = field(default_factory=list)
    keys: list[np.ndarray] = field(default_factory=list)
    owners: list[np.ndarray] = field(default_factory=list)


def _keys(words: np.ndarray, at: np.ndarray, c: LengthClass, number: int, coins: dict[int, np.ndarray]) -> np.ndarray:
    """Keys (places x SAMPLES) of the strings that one walk starts in at the given places."""
    wanted = c.samples[number]
    steps = np.unique(wanted)
    symbols = walk(words, at, number, int(steps[-1]) + 1, steps, coins)
    where = np.searchsorted(steps, wanted)
    out = np.empty((len(at), SAMPLES), dtype=np.uint64)
    for r in range(SAMPLES):
        key = np.full(len(at), number * SAMPLES + r + 1, dtype=np.uint64)
        for k in where[r]:
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + symbols[:, k])
        out[:, r] = key
    return out


def _joined(strings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strings with a 0 after each, and the places of their first and last words."""
    ends = np.cumsum([len(x) + 1 for x in strings])
    return np.concatenate([np.append(x, np.uint64(0)) for x in strings]), np.concatenate(([0], ends[:-1])), ends - 2


class BenchmarkIndex:
    """Items by id, and their LSH keys; as many walks as simulated passages of each kind need to reach the recall.

    Items under min_words words are kept apart, by the hash of all their words.
    """

    def __init__(self, items: list[tuple[int, bytes]], edits: float = EDITS, recall: float = RECALL, min_words: int = MIN_WORDS):
        words, at = words_of([x for _, x in items])
        self.edits = edits
        every = {i: words[a : b - 1] for (i, _), a, b in zip(items, at[:-1], at[1:], strict=True) if b - 1 > a}
        self.sizes = {i: len(x) for i, x in every.items()}
        self.items = {i: x for i, x in every.items() if len(x) >= min_words}
        self.own_pairs = {i: set(word_pairs(x)[:-1].tolist()) for i, x in self.items.items()}
        self.short: dict[int, dict[int, list[int]]] = {}
        for i, x in every.items():
            if len(x) < min_words:
                self.short.setdefault(len(x), {}).setdefault(int(runs_of(x, len(x))[0]), []).append(i)
        self.pairs = np.unique(np.concatenate([np.zeros(0, np.uint64), *[word_pairs(x)[:-1] for x in self.items.values()]]))
        self.present = np.zeros(1 << 20, dtype=bool)
        self.present[(self.pairs >> np.uint64(44)).astype(np.int64)] = True
        self.classes: list[LengthClass] = []
        left = []
        for i, x in self.items.items():
            n = -(-len(x) // PART_WORDS)
            cuts = [len(x) * k // n for k in range(n + 1)]
            left += [(i, s, e - s) for s, e in zip(cuts, cuts[1:], strict=False)]
        left.sort(key=lambda p: (p[2], p))
        while left:
            members = [p for p in left if p[2] <= left[0][2] * LENGTH_STEP]
            left = left[len(members) :]
            self.classes.append(self._class(members, recall))

    def allowed(self, n: int) -> int:
        return int(self.edits * n)

    def _class(self, members: list[tuple[int, int, int]], recall: float) -> LengthClass:
        least, size = members[0][2], members[-1][2]
        need = min(n - 1 - 2 * self.allowed(n) for _, _, n in members)
        c = LengthClass(size, max(1, need), least, members)  # a walk of so many steps stays inside every part, so equal passages give equal keys
        draw = np.random.default_rng(least * 1000 + size)
        strings = [self.items[i][s : s + n] for i, s, n in members]
        text, *ends = _joined(strings)
        kinds = 5
        from_part = draw.integers(len(members), size=150 * kinds)
        edited, *edited_ends = _joined([self._edited(strings[int(p)], draw, k % kinds) for k, p in enumerate(from_part)])
        hit = np.zeros(len(from_part), dtype=bool)
        for number in range(MAX_WALKS):
            c.samples.append(draw.integers(c.steps, size=(SAMPLES, SYMBOLS)))
            keys = _keys(text, ends[number % 2], c, number, {})
            hit |= (_keys(edited, edited_ends[number % 2], c, number, {}) == keys[from_part]).any(axis=1)
            order = np.argsort(keys.ravel(), kind="stable")
            c.keys.append(keys.ravel()[order])
            c.owners.append(np.repeat(np.arange(len(members)), SAMPLES)[order])
            if number >= 1 and hit.reshape(-1, kinds).mean(axis=0).min() >= recall:
                return c
        raise ValueError(f"{MAX_WALKS} walks do not reach a recall of {recall} at {least} to {size} words")

    def _edited(self, item: np.ndarray, draw: np.random.Generator, kind: int) -> np.ndarray:
        """item with the most edits allowed: 0 spread over it, or every second word of its 1 first, 2 middle, 3 last part, 4 both ends replaced."""
        out, n, most = item.tolist(), len(item), self.allowed(len(item))
        if kind:
            begin = {1: 0, 2: (n - 2 * most) // 2, 3: n - 2 * most}.get(kind, 0)
            at = [begin + 2 * k for k in range(most)]
            if kind == 4:
                at = [k if j % 2 else n - 1 - k for j, k in enumerate(sorted([*range(0, 2 * most, 2), *range(0, 2 * most, 2)])[:most])]
            if kind == 3:
                at = [k + 1 for k in at]
            for k in at:
                out[k] = int(draw.integers(1, 1 << 62)) | 1
            return np.array(out, dtype=np.uint64)
        for _ in range(most):
            k, what = int(draw.integers(len(out))), draw.integers(3)
            new = int(draw.integers(1, 1 << 62)) | 1
            if what == 0:
                out[k] = new
            elif what == 1:
                out.insert(k, new)
            elif len(out) > 1:
                del out[k]
        return np.array(out, dtype=np.uint64)

    def matches(self, texts: list[bytes]) -> list[dict[int, int]]:
        """For each text its items and their least edit distance.

        An edit changes two pairs of neighbouring words at most, so a window can only match an item of n words
        if all but twice the allowed edits of its n - 1 pairs occur in the items at all. This drops no match.
        """
        words, first = words_of(texts)
        out: list[dict[int, int]] = [{} for _ in texts]
        pairs = word_pairs(words)
        known = self.present[(pairs >> np.uint64(44)).astype(np.int64)]
        hits = np.flatnonzero(known)
        known[hits] = np.isin(pairs[hits], self.pairs)
        total = np.zeros(len(words) + 1, dtype=np.int32)
        np.cumsum(known, out=total[1:])
        ends = np.arange(len(words))
        places = []
        for c in self.classes:
            starts = total[np.minimum(ends + c.size - 1, len(words))] - total[:-1] >= c.least
            lasts = total[:-1] - total[np.maximum(ends - c.size + 1, 0)] >= c.least
            places.append((np.flatnonzero(starts & (words != 0)), np.flatnonzero(lasts & (words != 0))))
        for n, known_runs in self.short.items():
            found = runs_of(words, n)
            for place in np.flatnonzero(np.isin(found, np.array(list(known_runs), dtype=np.uint64))).tolist():
                doc = int(np.searchsorted(first, place, side="right")) - 1
                out[doc].update(dict.fromkeys(known_runs[int(found[place])], 0))
        tried: set = set()
        for number in range(max((len(c.samples) for c in self.classes), default=0)):
            coins: dict[int, np.ndarray] = {}
            for c, at in zip(self.classes, places, strict=True):
                if number < len(c.samples):
                    at = at[number % 2]
                    for s in range(0, len(at), 1 << 16):
                        self._search(c, number, words, pairs, first, at[s : s + (1 << 16)], coins, tried, out)
        return out

    def _search(self, c: LengthClass, number: int, words, pairs, first, at, coins, tried, out) -> None:
        keys = _keys(words, at, c, number, coins)
        known_keys, owners, back = c.keys[number], c.owners[number], number % 2
        low = np.searchsorted(known_keys, keys)
        rows, cols = np.nonzero(known_keys[np.minimum(low, len(known_keys) - 1)] == keys)
        for r, k in zip(rows.tolist(), cols.tolist(), strict=True):
            j, place = int(low[r, k]), int(at[r])
            while j < len(known_keys) and known_keys[j] == keys[r, k]:
                item, offset, length = c.parts[int(owners[j])]
                j += 1
                start = place - offset - (length - 1 if back else 0)
                doc = int(np.searchsorted(first, place, side="right")) - 1
                if (doc, start, item) in tried:
                    continue
                tried.add((doc, start, item))
                known = out[doc].get(item)
                if known == 0:
                    continue
                goal = self.items[item]
                slack = self.allowed(len(goal))
                # the start and the length of what stands before it may each be off by as many words as edits
                low_end, high_end = max(int(first[doc]), start - 2 * slack), max(0, min(int(first[doc + 1]) - 1, start + len(goal) + 2 * slack))
                # as for the windows: all but twice the allowed edits of the item's own pairs must be there
                if len(self.own_pairs[item].difference(pairs[low_end : max(low_end, high_end - 1)].tolist())) > 2 * slack:
                    continue
                part = words[low_end:high_end]
                edits = edit_distance_inside(goal.tolist(), part.tolist(), slack)
                if edits is not None and (known is None or edits < known):
                    out[doc][item] = edits


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, edits: float = EDITS) -> DataFrame:
    """(id, item, edits, n_words): every item with a passage in a document, and its least edit distance in words.

    Words are runs of letters and digits, A-Z lower-cased; see word_spans for scripts without spaces. The benchmark is searched in blocks of about
    block_bytes, each a pass over the documents with nothing shuffled; a block's index is the only
    thing sent to the tasks, so what they hold does not grow with either table. Every window of every
    whole text is embedded unless too few of its pairs of neighbouring words occur in any item. A match found by LSH is
    verified exactly; one with the most edits allowed is missed with probability 1 - RECALL at most,
    as measured on simulated passages, with edits spread or bunched in any part, when the index is built,
    and exact copies are never missed. Items over PART_WORDS words are found by their parts.

    Items under MIN_WORDS words are found by equal hashes of all their words in a row.

    Null and empty texts, and items without a word, match nothing. Equal items are reported each; of items
    with equal ids the last one counts. Rows with equal or null ids are reported each. A text of any length
    is searched whole by one task, which holds some 60 bytes for each of its words besides the text. Other
    columns are ignored. Ids are integers.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).cast("string").alias("text")).where("item is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    out = None
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).sort("item").collect()
        index = BenchmarkIndex([(r["item"], r["text"].encode()) for r in part], edits)

        def search(batches, index=index):
            import pyarrow as pa

            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), as_bytes(batch.column(1))
                got = [(ids[s + i], item, n, index.sizes[item]) for s, e in slices(texts, 1 << 20) for i, x in enumerate(index.matches(texts[s:e])) for item, n in sorted(x.items())]
                columns = list(zip(*got, strict=True)) or [[]] * 4
                yield pa.record_batch([pa.array(x, pa.int64()) for x in columns], names=["id", "item", "edits", "n_words"])

        found = rows.mapInArrow(search, "id long, item long, edits long, n_words long")
        out = found if out is None else out.union(found)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "edits", "n_words")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
