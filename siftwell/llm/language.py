"""Language identification: FTRL-trained sparse multinomial regression on TF-IDF character n-grams, calibrated."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import table

#: n-grams of one to ORDER characters are hashed into so many buckets.
BUCKETS, ORDER = 1 << 16, 3
#: Labelled rows that the classifier is fitted on, at most: of each language, and of all together. A fifth of them sets the temperature.
SAMPLE_PER_LANG, SAMPLE_ROWS = 600, 2400
#: Each row of the sample serves whole and as a fragment of 2 to 2^FRAGMENT characters, so that short texts are judged as such.
FRAGMENT = 7
#: Share of a label that calibration spreads over all languages.
SMOOTHING = 0.01
#: Learning rate, smoothing, L1 and L2 of follow-the-regularised-leader; passes over the sample.
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 0.02, 0.02, 3
UNKNOWN = "und"

_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Code points of letters as they are, of all else as a space."""
    global _letters
    if _letters is None:
        points = np.arange(0x110000, dtype=np.uint32)
        alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
        _letters = np.where(alpha, points, np.uint32(32))
    return _letters


def grams(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of the n-grams at every position for each n, starts, ends and letters of each text).

    A text is lower-cased and stands between spaces, so no n-gram reaches into another text.
    """
    low = [f" {t.lower()}  " for t in texts]
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = _letter_table()[code]
    ends = np.cumsum([len(t) for t in low])
    starts = ends - [len(t) for t in low]
    h, out = np.zeros(len(code), dtype=np.uint32), []
    for n in range(ORDER):
        h = h.copy()
        h[: len(code) - n] = (h[: len(code) - n] + code[n:] + np.uint32(1)) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        out.append((h * np.uint32(0x85EBCA77)) >> np.uint32(32 - 16))
    letters = np.add.reduceat((code != 32).astype(np.int64), starts) if len(texts) else np.zeros(0, np.int64)
    return out, starts, ends - 2, letters


def _slices(texts: list[str], limit: int = 1 << 19):
    start, total = 0, 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > limit:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def _document_frequencies(batches):
    import pyarrow as pa

    df, docs = np.zeros(BUCKETS, dtype=np.int64), 0
    seen = np.zeros(BUCKETS, dtype=bool)
    for batch in batches:
        texts = [x or "" for x in batch.column(0).to_pylist()]
        docs += len(texts)
        for s, e in _slices(texts):
            found, starts, ends, _ = grams(texts[s:e])
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                for g in found:
                    seen[g[a:b]] = True
                df += seen
                seen[:] = False
    some = np.flatnonzero(df)
    yield pa.record_batch([pa.array(np.append(some, -1), pa.int64()), pa.array(np.append(df[some], docs), pa.int64())], names=["bucket", "n"])


def fragment(text: str, order: int) -> str:
    """A part of text whose length and place follow from the row's hash, most often a short one."""
    size = 1 << (1 + order % FRAGMENT)
    start = (order >> 8) % max(1, len(text) - size + 1)
    return text[start : start + size]


def _featurise(batches):
    import pyarrow as pa

    for batch in batches:
        langs, order, texts = batch.column(0), batch.column(1), [x or "" for x in batch.column(2).to_pylist()]
        for s, e in _slices(texts):
            both = [y for t, o in zip(texts[s:e], order.slice(s, e - s).to_pylist(), strict=True) for y in (t, fragment(t, o))]
            found, starts, ends, letters = grams(both)
            ids, counts = [], []
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                total = np.bincount(np.concatenate([g[a:b] for g in found]), minlength=BUCKETS)
                some = np.flatnonzero(total)
                ids.append(some.astype("<i4").tobytes())  # packed: the driver holds a sample of these
                counts.append(total[some].astype("<i4").tobytes())
            twice = np.repeat(np.arange(s, e), 2)
            yield pa.record_batch([langs.take(pa.array(twice)), order.take(pa.array(twice)), pa.array(ids, pa.binary()), pa.array(counts, pa.binary()), pa.array(letters, pa.int64())], names=["lang", "o", "ids", "counts", "letters"])


@dataclass
class LanguageModel:
    """weights: of each language and bucket, times its IDF and the scale; a text's logit is their mean over its letters plus bias.

    Logits are divided by the temperature exp(a + b * log(letters)), (a, b) = calibration: the mean over few
    letters says less than one over many.
    """

    langs: list[str]
    weights: np.ndarray
    bias: np.ndarray
    calibration: tuple[float, float]

    def probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities of each text and language, its letters)."""
        out, count = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), dtype=np.int64)
        for s, e in _slices(texts):
            found, starts, ends, letters = grams(texts[s:e])
            count[s:e] = letters
            cut = np.column_stack([starts, ends]).ravel()
            for k, w in enumerate(self.weights):
                for g in found:
                    out[s:e, k] += np.add.reduceat(np.append(w[g], np.float32(0)), cut, dtype=np.float64)[::2]
        logits = (out / np.maximum(count, 1)[:, None] + self.bias) / temperature(self.calibration, count)[:, None]
        p = np.exp(logits - logits.max(axis=1, keepdims=True)) if self.langs else out
        return p / np.maximum(p.sum(axis=1, keepdims=True), 1e-300), count

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p, letters = self.probabilities(texts)
        best = p.argmax(axis=1)
        known = letters > 0
        names = [self.langs[i] if ok else UNKNOWN for i, ok in zip(best.tolist(), known.tolist(), strict=True)]
        return names, np.where(known, p.max(axis=1), 0.0)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, classes: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) by follow-the-regularised-leader with elastic net, row by row."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))
    eye, draw = np.eye(classes), np.random.default_rng(seed)

    def weights(z, root):
        w = -(z - np.clip(z, -L1, L1)) / ((BETA + root) / ALPHA + L2)
        return w  # no weight where L1 outweighs z

    for _ in range(EPOCHS):
        for i in draw.permutation(len(rows)):
            j, x = rows[i]
            zj, nj = z[j], n[j]
            root = np.sqrt(nj)
            w = weights(zj, root)
            logit = x @ w
            p = np.exp(logit - logit.max())
            g = np.outer(x, p / p.sum() - eye[target[i]])
            nj += g * g
            zj += g - (np.sqrt(nj) - root) / ALPHA * w
            z[j], n[j] = zj, nj
    w = weights(z, np.sqrt(n)).T
    return w[:, :-1], w[:, -1]


def temperature(calibration: tuple[float, float], letters: np.ndarray) -> np.ndarray:
    return np.exp(calibration[0] + calibration[1] * np.log(np.maximum(letters, 1)))


def calibrated(logits: np.ndarray, target: np.ndarray, letters: np.ndarray) -> tuple[float, float]:
    """The calibration with the least loss under smoothed labels: golden sections over a, for each b of a grid."""
    if not len(target):
        return 0.0, 0.0
    k = logits.shape[1]

    def loss(a: float, b: float) -> float:
        x = logits / temperature((a, b), letters)[:, None]
        x = x - x.max(axis=1, keepdims=True)
        x -= np.log(np.exp(x).sum(axis=1, keepdims=True))
        return -float(np.mean((1 - SMOOTHING) * x[np.arange(len(x)), target] + SMOOTHING / k * x.sum(axis=1)))

    ratio, best = (5**0.5 - 1) / 2, (np.inf, 0.0, 0.0)
    for b in np.arange(-10, 1) / 10:
        low, high = -6.0, 6.0
        for _ in range(40):
            x, y = high - ratio * (high - low), low + ratio * (high - low)
            low, high = (low, y) if loss(x, b) < loss(y, b) else (x, high)
        best = min(best, (loss((low + high) / 2, b), (low + high) / 2, float(b)))
    return best[1:]


def _kept_out(id_col: str):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2


def fit_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = SAMPLE_PER_LANG, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fits on documents with a language whose crc32 of the id as text, modulo 4, is not 2.

    Document frequencies come from all of these; the weights from per_lang rows of each language at
    most, and sample_rows of all, taken by a hash of the id; each serves whole and as a fragment. Rows with
    equal ids are sampled together or not at all. Only counts by bucket and this sample reach the driver.
    """
    usable = docs.where(F.col(lang_col).isNotNull() & ~_kept_out(id_col)).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    counts = dict(usable.groupBy("lang").count().collect())
    langs = sorted(counts)
    if not langs:
        return LanguageModel([], np.zeros((0, BUCKETS), np.float32), np.zeros(0), (0.0, 0.0))
    per_lang = max(1, min(per_lang, sample_rows // len(langs)))
    df = np.zeros(BUCKETS)
    total = 0
    for bucket, n in usable.select("text").mapInArrow(_document_frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        if bucket < 0:
            total = n
        else:
            df[bucket] = n
    idf = np.log((1 + total) / (1 + df)) + 1
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, 1.5 * per_lang / counts[k]))])
    order = F.xxhash64(F.col("id").cast("string"))
    sample = usable.where(F.pmod(order, F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)).select("lang", order.alias("o"), "text")
    rows = sample.mapInArrow(_featurise, "lang string, o long, ids binary, counts binary, letters long").where("letters > 0").collect()
    picked = [r for k in langs for r in sorted((r for r in rows if r["lang"] == k), key=lambda r: (r["o"] % 1048573, r["o"], -r["letters"]))[: 2 * per_lang]]
    vectors = []
    for r in picked:
        ids = np.frombuffer(r["ids"], "<i4").astype(np.int64)
        vectors.append((ids, np.frombuffer(r["counts"], "<i4") * idf[ids] / r["letters"]))
    if not vectors:
        return LanguageModel([], np.zeros((0, BUCKETS), np.float32), np.zeros(0), (0.0, 0.0))
    scale = 1 / np.mean([np.sqrt((x * x).sum()) for _, x in vectors])
    vectors = [(np.append(ids, BUCKETS), np.append(x * scale, 1.0)) for ids, x in vectors]
    target = np.array([langs.index(r["lang"]) for r in picked])
    held = np.array([r["o"] % 5 == 0 for r in picked]) if len(picked) >= 50 else np.zeros(len(picked), bool)
    w, bias = ftrl([v for v, h in zip(vectors, held, strict=True) if not h], target[~held], len(langs))
    logits = np.array([w[:, v[0][:-1]] @ v[1][:-1] + bias for v, h in zip(vectors, held, strict=True) if h]).reshape(-1, len(langs))
    letters = np.array([r["letters"] for r in picked])
    return LanguageModel(langs, (w * idf * scale).astype(np.float32), bias, calibrated(logits, target[held], letters[held]))


def predicted(docs: DataFrame, model: LanguageModel, text_col: str = "text", into: str = "language") -> DataFrame:
    """docs with a struct column into: (lang, score).

    A null text or one without a letter has lang 'und' and score 0. Only the text decides, the whole of it,
    so rows with equal texts get equal answers whatever their ids. Ties go to the language that sorts first.
    With no labelled row at all every text is 'und'. A column named into is an error, others stay as they are.
    """
    if into.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"docs has a column {into} already")

    def answer(text: pd.Series) -> pd.DataFrame:
        names, score = model.predict([x or "" for x in text])
        return pd.DataFrame({"lang": names, "score": score})

    call = F.pandas_udf(answer, "lang string, score double")
    return docs.withColumn(into, call(F.col(text_col).cast("string")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = predicted(docs.select("doc_id", "text"), fit_language_model(docs))
    held = F.coalesce(_kept_out("doc_id"), F.lit(False))
    return out.select("doc_id", held.alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
