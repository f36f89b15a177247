"""Secret scans: fixed patterns, and a linear-chain conditional random field that tags tokens."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import as_bytes, hash_spans, mix, runs, slices, table

# The base patterns, their least lengths, and the order of kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex")
LEAST = {"assign": 6, "access": 20, "hex": 24}
EXTRA = "crf"

_KEY = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""")

#: Rows of documents whose lines the model is trained between, at most, and characters of a line that are taken.
TRAIN_ROWS, LINE_CHARS = 400, 400
#: Buckets for each hashed feature.
SPACE = 1 << 12
#: A span of the best path is added if its tokens are part of a secret with this probability, in the mean.
LEAST_PROBABILITY = 0.9

Span = tuple[str, int, int]


def base_spans(text: str, hexes: bool = True) -> list[Span]:
    """The spans (kind, start, end) of the fixed patterns, by start, then kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    if hexes:
        out += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return ordered(out)


def secret_values(text: str) -> list[tuple[int, int]]:
    """Where the secrets themselves stand in the spans of the fixed patterns: of an assignment, the value."""
    out = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    return out + [(a, b) for k, a, b in base_spans(text) if k != "assign"]


def ordered(spans: list[Span]) -> list[Span]:
    order = {k: i for i, k in enumerate((*KINDS, EXTRA))}
    return sorted(spans, key=lambda s: (s[1], order[s[0]], s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_LOWER, _UPPER, _DIGIT = (_table(bytes(range(a, b + 1))) for a, b in ((97, 122), (65, 90), (48, 57)))
_SIGN, _HIGH, _HEX = _table(b"+/_-"), _table(bytes(range(128, 256))), _table(b"0123456789abcdef")
_TOKEN = _LOWER | _UPPER | _DIGIT | _SIGN | _HIGH
_CLASS = (_LOWER * 1 + _UPPER * 2 + _DIGIT * 3 + _SIGN * 4 + _HIGH * 5).astype(np.int8)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_CODE = _table(b"{}[]();=<>\"'")
FEATURES = 10


@dataclass
class Tokens:
    """Tokens of several texts joined by a line feed: byte spans, and FEATURES rows of the weight table for each."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    first: np.ndarray


def _bucket(x: np.ndarray) -> np.ndarray:
    """0, 1, 2, 3-4, 5-8, ... as 0, 1, 2, 3, 4, ..., at most 7."""
    return np.minimum(np.ceil(np.log2(np.maximum(x, 1))).astype(np.int64) + (x > 0), 7)


def tokens(texts: list[bytes]) -> Tokens:
    """Runs of letters, digits, + / _ and - with shape, words around them, separators, and the texts' make-up."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    starts, ends = runs(_TOKEN[data])
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(x) + 1 for x in texts], out=at[1:])
    first = np.searchsorted(starts, at)
    n = len(starts)
    if not n:
        return Tokens(starts, ends, np.zeros((FEATURES, 0), dtype=np.int32), first)
    cuts = np.column_stack([starts, ends]).ravel()  # a line feed follows the last token
    inside = lambda mask: np.add.reduceat(mask.view(np.uint8), cuts, dtype=np.int64)[::2]
    kind = _CLASS[data]
    turns = np.zeros(len(data), dtype=bool)
    turns[1:] = kind[1:] != kind[:-1]
    length = ends - starts
    n_digit, n_upper, n_sign, n_high = (inside(t[data]) for t in (_DIGIT, _UPPER, _SIGN, _HIGH))
    n_turn = inside(turns) - turns[starts]
    mask = (n_digit > 0) * 1 + (n_upper > 0) * 2 + (n_sign > 0) * 4 + (n_high > 0) * 8 + (length > n_digit + n_upper + n_sign + n_high) * 16
    size = np.minimum(length // 4, 15)
    word = (hash_spans(_FOLD[data], starts, ends) >> np.uint64(40)).astype(np.int64) % SPACE
    word = np.where(length > 20, SPACE - 1, word)
    left = np.zeros(n, dtype=np.uint64)  # up to four bytes before and two after
    for k in range(1, 5):
        ok = (starts >= k) & ~_TOKEN[data[starts - k]]
        left = left * np.uint64(257) + np.where(ok, data[starts - k], 0).astype(np.uint64)
    spans = list(zip(at[:-1].tolist(), (at[1:] - 1).tolist(), strict=True))
    share = lambda t: np.array([min(7, int(np.count_nonzero(t[data[a:b]])) * 64 // (b + 1 - a)) for a, b in spans])
    rows = np.empty((FEATURES, n), dtype=np.int32)
    rows[0] = mask * 16 + size
    rows[1] = 512 + n_turn.clip(0, 15) * 16 + size
    rows[2] = 1024 + _bucket(n_digit) * 64 + _bucket(n_upper) * 8 + _bucket(length)
    rows[3] = SPACE + word
    rows[4, 0], rows[4, 1:] = 3 * SPACE - 2, 2 * SPACE + word[:-1]
    rows[5, -1], rows[5, :-1] = 4 * SPACE - 2, 3 * SPACE + word[1:]
    rows[6] = 4 * SPACE + (mix(left) >> np.uint64(40)).astype(np.int64) % SPACE
    rows[7] = 1600 + data[ends].astype(np.int32)
    rows[8] = 1900 + np.repeat(share(_CODE) * 8 + share(_DIGIT), np.diff(first))
    rows[9] = 2000
    return Tokens(starts, ends, rows, first)


ROWS = 5 * SPACE
OUTSIDE, BEGIN, INSIDE = 0, 1, 2


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class SecretModel:
    """weights (ROWS x 3) by feature and tag, moves (3 x 3) by tag and next tag; inside never follows outside."""

    weights: np.ndarray
    moves: np.ndarray

    def emissions(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((rows.shape[1], 3), dtype=np.float32)
        for r in rows:
            out += self.weights[r]
        return out

    def spans(self, t: Tokens) -> list[tuple[int, int, int]]:
        """(first token, end, text) of the spans on the best path of each text.

        Of these spans only those count that are secrets with LEAST_PROBABILITY, by the marginals of their tokens.
        A token whose outside score exceeds the others by more than all moves around it could win back
        is outside on every best path; only the runs between such tokens are decoded, which is exact.
        """
        e = self.emissions(t.rows)
        reach = 2 * float(np.ptp(self.moves[np.isfinite(self.moves) & (self.moves > -1e8)])) + 1e-3
        unsure = e[:, OUTSIDE] - e[:, BEGIN:].max(axis=1) <= reach
        at = t.first[:-1][np.diff(t.first) > 0]
        begins = np.zeros(len(unsure), dtype=bool)
        begins[at] = True
        out = []
        for s, end in zip(*runs(unsure), strict=True):
            cuts = [s, *(s + 1 + np.flatnonzero(begins[s + 1 : end])).tolist(), end]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                # the whole run, between outside tokens or the ends of the text
                tags = self._viterbi(e[a:b], bool(begins[a]), b == len(begins) or bool(begins[b]))
                p = None
                i = 0
                while i < len(tags):
                    if tags[i] == BEGIN:
                        j = i + 1
                        while j < len(tags) and tags[j] == INSIDE:
                            j += 1
                        if p is None:
                            p = self._marginal_outside(e[a:b], bool(begins[a]), b == len(begins) or bool(begins[b]))
                        if 1 - p[i:j].mean() >= LEAST_PROBABILITY:
                            out.append((a + i, a + j))
                        i = j
                    else:
                        i += 1
        text = np.searchsorted(t.first, [x[0] for x in out], side="right") - 1
        return [(a, b, int(k)) for (a, b), k in zip(out, text, strict=True)]

    def _edges(self, e: np.ndarray, opens: bool, closes: bool) -> tuple[np.ndarray, np.ndarray]:
        e = e.astype(np.float64).copy()
        e[0] += [0, 0, -1e9] if opens else self.moves[OUTSIDE]
        if not closes:
            e[-1] += self.moves[:, OUTSIDE]
        return e, self.moves

    def _viterbi(self, e: np.ndarray, opens: bool, closes: bool) -> list[int]:
        e, moves = self._edges(e, opens, closes)
        back, score = [], e[0]
        for x in e[1:]:
            step = score[:, None] + moves
            back.append(step.argmax(axis=0))
            score = step.max(axis=0) + x
        tag = int(score.argmax())
        tags = [tag]
        for b in reversed(back):
            tag = int(b[tag])
            tags.append(tag)
        return tags[::-1]

    def _marginal_outside(self, e: np.ndarray, opens: bool, closes: bool) -> np.ndarray:
        e, moves = self._edges(e, opens, closes)
        f, b = [e[0]], [np.zeros(3)]
        for x in e[1:]:
            f.append(_logsum(f[-1][:, None] + moves, 0) + x)
        for x in e[:0:-1]:
            b.append(_logsum(moves + (x + b[-1])[None, :], 1))
        total = np.array(f) + np.array(b[::-1])
        return np.exp(total[:, OUTSIDE] - _logsum(total, 1))


_ALPHABETS = {
    "hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "b62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "b64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "b32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-",
}
_BEFORE = ("key = ", "key: ", "auth_token=", 'token = "', "password: ", "secret=", "Bearer ", "api_key='", "private_key: ", "client_secret = ", "credential=", "access key ", "pwd=", "passphrase: ", "apikey ", "signature=", "session=", '"auth": "', "-p ", "export KEY=")
_PREFIX = ("", "", "", "", "ghp_", "sk-", "xoxb-", "AKIA", "glpat-", "pk_live_", "AIza")


def _lines(draw: np.random.Generator, prose: list[str]) -> tuple[str, int, int]:
    """A line of prose, most often with a made-up secret in it; its span, or (-1, -1)."""
    words = prose[draw.integers(len(prose))].split(" ")
    a = int(draw.integers(max(1, len(words) - 12))) if len(words) > 12 else 0
    words = words[a : a + 12]
    kind = draw.random()
    pick = lambda xs: xs[draw.integers(len(xs))]
    if kind < 0.5:
        abc = _ALPHABETS[pick(list(_ALPHABETS))]
        value = pick(_PREFIX) + "".join(abc[i] for i in draw.integers(len(abc), size=draw.integers(16, 65)))
        if draw.random() < 0.1:
            value += "." + "".join(abc[i] for i in draw.integers(len(abc), size=30))
        lead = pick(_BEFORE)
    elif kind < 0.75:  # what looks alike but is none: numbers, dates, words, paths, addresses
        lead, value = pick((*_BEFORE, "", "", "")), ""
        digits = "".join(map(str, draw.integers(10, size=draw.integers(4, 17))))
        other = pick((digits, f"{digits[:4]}-01-02", "https://www.example.com/a/b-c_d", "user/name@example.com", pick(words) if words else "a", f"src/{pick(words) if words else 'x'}.py", f"+{digits}", f"{digits[:3]}-{digits[-4:]}"))
        return " ".join([*words[:6], (lead if draw.random() < 0.4 else "") + other, *words[6:]]), -1, -1
    else:
        return " ".join(words), -1, -1
    head = " ".join(words[:6]) + " " * bool(words[:6])
    start = len((head + lead).encode())
    close = {'"': '"', "'": "'"}.get(lead[-1], "")
    return head + lead + value + close + " " + " ".join(words[6:]), start, start + len(value)


def train(prose: list[str], size: int = 4000, epochs: int = 25, seed: int = 5) -> SecretModel:
    """Fits the field by gradient ascent of its likelihood on lines with made-up secrets among the given prose.

    Secrets that the fixed patterns find in the prose are tagged as such, too.
    """
    draw = np.random.default_rng(seed)
    prose = [p for p in prose if p.strip()] or ["the quick brown fox jumps over the lazy dog and runs away from it all"]
    made = [_lines(draw, prose) for _ in range(size)]
    t = tokens([x[0].encode() for x in made])
    offset = np.concatenate([[0], np.cumsum([len(x[0].encode()) + 1 for x in made])])
    longest = int(np.diff(t.first).max())
    index = np.full((size, longest), -1)
    gold = np.zeros((size, longest), dtype=np.int64)
    for i, (line, s, e) in enumerate(made):
        a, b = int(t.first[i]), int(t.first[i + 1])
        index[i, : b - a] = range(a, b)
        known = [(len(line[:x].encode()), len(line[:y].encode())) for x, y in secret_values(line)]
        for s, e in sorted([*known, *([(s, e)] if s >= 0 else [])], reverse=True):
            inside = (t.starts[a:b] < offset[i] + e) & (t.ends[a:b] > offset[i] + s)
            if inside.any():
                gold[i, : b - a][inside] = INSIDE
                gold[i, int(np.argmax(inside))] = BEGIN
    live = index >= 0
    weights, moves = np.zeros((ROWS, 3)), np.zeros((3, 3))
    sq_w, sq_m = np.full((ROWS, 3), 1e-6), np.full((3, 3), 1e-6)
    barred = np.zeros((3, 3))
    barred[OUTSIDE, INSIDE] = -1e9
    begin = np.array([0, 0, -1e9])
    for _ in range(epochs):
        for part in np.array_split(draw.permutation(size), 8):
            idx, on, y = index[part], live[part], gold[part]
            n, steps = idx.shape
            rows = t.rows[:, np.maximum(idx, 0)]  # features x n x steps
            e = weights[rows].sum(axis=0)
            m = moves + barred
            f = np.zeros((steps, n, 3))
            f[0] = e[:, 0] + begin
            for k in range(1, steps):
                f[k] = np.where(on[:, k, None], _logsum(f[k - 1][:, :, None] + m, 1) + e[:, k], f[k - 1])
            b = np.zeros((steps, n, 3))
            pair = np.zeros((3, 3))
            z = _logsum(f[-1], 1)
            for k in range(steps - 2, -1, -1):
                ahead = e[:, k + 1] + b[k + 1]
                b[k] = np.where(on[:, k + 1, None], _logsum(m[None] + ahead[:, None, :], 2), b[k + 1])
                p = np.exp(f[k][:, :, None] + m[None] + ahead[:, None, :] - z[:, None, None]) * on[:, k + 1, None, None]
                pair -= p.sum(axis=0)
                np.add.at(pair, (y[on[:, k + 1], k], y[on[:, k + 1], k + 1]), 1)
            marginal = np.exp(f + b - z[None, :, None]).transpose(1, 0, 2) * on[:, :, None]
            g = (np.eye(3)[y] * on[:, :, None] - marginal)[on]
            grad = np.zeros((ROWS, 3))
            for r in rows:
                np.add.at(grad, r[on], g)
            grad -= 1e-3 * n / size * weights
            sq_w += grad * grad
            weights += 0.3 * grad / np.sqrt(sq_w)
            sq_m += pair * pair
            moves += 0.1 * pair / np.sqrt(sq_m)
    return SecretModel(weights.astype(np.float32), moves + barred)


def fit_secret_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> SecretModel:
    """Trains between lines of at most rows documents, taken by a hash of the id; no label column is needed.

    Of each such document one line serves, and of it LINE_CHARS characters from a place on, both by the hash;
    what is scanned later are whole texts.
    """
    n = docs.select(id_col).count()
    key = F.xxhash64(F.col(id_col).cast("string"))
    part = docs.where(F.pmod(key, F.lit(1 << 30)) < (1 << 30) * min(1.0, 1.5 * rows / max(n, 1)))
    # a line is enough of each document, so the driver gets rows lines, not texts
    part = part.select(key.alias("o"), F.filter(F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n"), lambda x: F.length(F.trim(x)) > 0).alias("lines")).where(F.size("lines") > 0)
    line = F.element_at("lines", (F.pmod(F.shiftright("o", 7), F.size("lines").cast("long")) + 1).cast("int"))
    part = part.select("o", line.alias("line"))
    place = F.pmod(F.shiftright("o", 31), F.greatest(F.length("line") - LINE_CHARS, F.lit(0)).cast("long") + 1) + 1
    got = part.select("o", F.substring("line", place.cast("int"), F.lit(LINE_CHARS)).alias("line")).sort("o", "line").limit(rows).collect()
    return train([r["line"] for r in got])


def code_points(text: bytes, offsets: list[int]) -> list[int]:
    """The code points before each of some rising byte offsets."""
    out, at, count = [], 0, 0
    lead = np.frombuffer(text, dtype=np.uint8)
    for o in offsets:
        count += o - at if text.isascii() else int(np.count_nonzero((lead[at:o] & 0xC0) != 0x80))
        at = o
        out.append(count)
    return out


def field_spans(texts: list[bytes], model: SecretModel) -> list[list[tuple[int, int]]]:
    """The spans of each text that the model finds, in code points."""
    at = np.cumsum([0, *[len(x) + 1 for x in texts]])
    t = tokens(texts)
    found: list[list[int]] = [[] for _ in texts]
    for a, b, i in model.spans(t):
        found[i] += [int(t.starts[a] - at[i]), int(t.ends[b - 1] - at[i])]
    out = []
    for x, offsets in zip(texts, found, strict=True):
        places = code_points(x, offsets)
        out.append(list(zip(places[::2], places[1::2], strict=True)))
    return out


def scan(texts: list[bytes], model: SecretModel) -> list[list[Span]]:
    """All spans of each text: those of the patterns, and those of the model that touch none of them."""
    low = b"\n".join(texts).lower()
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(x) + 1 for x in texts], out=at[1:])
    third = _HEX[np.frombuffer(low, dtype=np.uint8)[::3]]  # a run of 24 holds eight of these in a row
    if len(third) >= 8:
        eight = third[:-1] & third[1:]
        eight = eight[:-2] & eight[2:]
        eight = eight[:-4] & eight[4:]
        hexes = set((np.searchsorted(at, 3 * np.flatnonzero(eight), side="right") - 1).tolist())
    else:
        hexes = set()
    keys = {int(k) - 1 for k in np.searchsorted(at, [m.start() for m in _KEY.finditer(low)], side="right")}
    out: list[list[Span]] = []
    for i, x in enumerate(texts):
        out.append(base_spans(x.decode("utf-8", "replace"), i in hexes) if i in hexes or i in keys or b"AKIA" in x else [])
    for i, more in enumerate(field_spans(texts, model)):
        if more:
            base, k, top = sorted((x, y) for _, x, y in out[i]), 0, -1  # top: where the base spans that begin before e end
            for s, e in more:
                while k < len(base) and base[k][0] < e:
                    top = max(top, base[k][1])
                    k += 1
                if top <= s:
                    out[i].append((EXTRA, s, e))
    return [ordered(x) for x in out]


def found_secrets(docs: DataFrame, model: SecretModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans: array of (kind, start, end)) for every row; code points, end exclusive.

    Kinds are those of the fixed patterns, and crf for spans of the model that touch none of these. A null or
    empty text has no spans. Texts are scanned whole, each by one task, which holds some 100 bytes for
    each of a text's tokens. Rows with equal or null ids are scanned like any other; other columns are
    ignored.
    """
    def scanned(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for s, e in slices(texts):
                spans = [[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in scan(texts[s:e], model)]
                yield pa.record_batch([batch.column(0).slice(s, e - s), pa.array(spans, kind)], names=["id", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scanned, "id long, spans array<struct<kind string, start long, end long>>").withColumnRenamed("id", id_col)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = found_secrets(docs, fit_secret_model(docs))
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["kind"] != EXTRA)
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *[count(k) for k in KINDS], F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
