"""Token counts in delta-maintained rollups: signed batches update additive totals, each batch once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import scratch_dir, slices, stored, table
from siftwell.llm.tokens import counter, tokenizer_path

# The versions of counters that need no vocabulary.
COUNTERS: dict[str, Callable[[Column], Column]] = {
    "words-1": lambda text: F.regexp_count(text, F.lit("[^ \\t\\n\\x0B\\f\\r]+")),
    "pieces-1": lambda text: F.regexp_count(text, F.lit("[A-Za-z]+|[0-9]|[^ \\t\\n\\x0B\\f\\rA-Za-z0-9]")),
}
#: The vocabularies that op6 counts by; a file's name is the tokenizer's version.
TOKENIZERS = ("word_bpe_49k.json", "byte_bpe_50k.tiktoken")
KEYS = ("source", "lang", "tokenizer")
TOTALS = ("documents", "tokens")
#: Batches that wait beside the latest snapshot of the totals before a new one is written.
PENDING = 8


def counted(docs: DataFrame, *tokenizers: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, source, lang, tokenizer, tokens) of every row and tokenizer; a null or empty text has 0 tokens.

    tokenizers are names of COUNTERS, which stay in the JVM, or paths of vocabulary files, whose ids of the
    whole text are counted; all files see each text once. Of a path only the file's name is the version.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    head = [F.col(id_col).alias("id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang")]
    out = None
    for name in (t for t in tokenizers if t in COUNTERS):
        part = docs.select(*head, F.lit(name).alias("tokenizer"), COUNTERS[name](text).cast("long").alias("tokens"))
        out = part if out is None else out.union(part)
    files = [t for t in tokenizers if t not in COUNTERS]
    if files:
        versions = [f.rsplit("/", 1)[-1] for f in files]
        import pandas as pd

        def lengths(batches):
            for texts in batches:
                texts = list(texts)
                yield pd.DataFrame({f"n{k}": [n for s, e in slices(texts) for n in counter(f).counts(texts[s:e])] for k, f in enumerate(files)}, dtype="int64")

        count = F.pandas_udf(lengths, ", ".join(f"n{k} long" for k in range(len(files))), F.PandasUDFType.SCALAR_ITER)
        # stored by the caller or not, the numbers are made before they are dealt to rows
        each = docs.select(*head, count(text).alias("n")).select("id", "source", "lang", F.explode(F.array(*[F.struct(F.lit(v).alias("tokenizer"), F.col(f"n.n{k}").alias("tokens")) for k, v in enumerate(versions)])).alias("c"))
        part = each.select("id", "source", "lang", "c.*")
        out = part if out is None else out.union(part)
    return out


def inserts(counts: DataFrame) -> DataFrame:
    """Each counted document as a change of +1 document and +tokens."""
    return counts.select(*KEYS, F.lit(1).cast("long").alias("documents"), "tokens")


def deletes(counts: DataFrame) -> DataFrame:
    """Each counted document as a change of -1 document and -tokens."""
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("documents"), (-F.col("tokens")).alias("tokens"))


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Counts that take the place of others, as the removal of the old and the arrival of the new ones."""
    return deletes(before).union(inserts(after))


class Rollup:
    """Totals by source, language and tokenizer version, maintained from signed batches.

    A batch is summed by key and written as a folder named by its id; Spark commits the folder with a
    _SUCCESS file. A folder without one is no batch and is written anew, and a committed id is not
    applied again, so a batch that is sent twice, or whose driver dies, counts once. When PENDING
    batches have come, their sums are added to those of the latest snapshot and a new snapshot is
    committed, which also lists all ids it holds; only then are the folders that it covers deleted. A
    crash in between leaves folders that the snapshot already lists, and these are not added again. So a
    read takes one snapshot and fewer than 2 * PENDING small folders, however many batches have come. What is
    kept grows with keys and ids, never with documents. Batches may arrive in any order. One writer at
    a time works on a path.

    Null sources, languages and token counts are keys or zeros like any other; an empty batch commits.
    Keys whose totals are all zero are left out. Batch ids hold letters, digits, - and _.
    """

    SCHEMA = ", ".join(["batch string", *[f"{k} string" for k in KEYS], *[f"{t} long" for t in TOTALS]])

    def __init__(self, spark: SparkSession, path: str, pending: int = PENDING):
        self.spark, self.path, self.pending = spark, path.rstrip("/"), pending

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return root, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm

    def _committed(self, kind: str) -> list[str]:
        """Names of the folders kind=name that are complete."""
        root, fs, jvm = self._fs()
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(n.removeprefix(f"{kind}=") for n in names if n.startswith(f"{kind}=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS")))

    def _read(self, *folders: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(*[f"{self.path}/{f}" for f in folders])

    def _state(self) -> tuple[str | None, set[str], list[str]]:
        """The latest snapshot, the ids it lists, and the batches that wait beside it."""
        last = max(self._committed("snapshot"), key=int, default=None)
        listed = set() if last is None else {r["batch"] for r in self._read(f"snapshot={last}").where("batch is not null").select("batch").collect()}
        return last, listed, [b for b in self._committed("batch") if b not in listed]

    def batches(self) -> list[str]:
        """Ids of the committed batches."""
        _, listed, waiting = self._state()
        return sorted(listed.union(waiting))

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Commits changes (KEYS and TOTALS) under batch_id; False if that was done before."""
        if not batch_id or not all(c.isascii() and (c.isalnum() or c in "-_") for c in batch_id):
            raise ValueError(f"no batch id: {batch_id!r}")
        last, listed, waiting = self._state()
        if batch_id in listed or batch_id in waiting:
            return False
        sums = changes.groupBy(*KEYS).agg(*[F.sum(F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in TOTALS])
        sums.select(F.lit(None).cast("string").alias("batch"), *KEYS, *TOTALS).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        if len(waiting) + 1 >= self.pending:
            self.compact()
        return True

    def compact(self) -> None:
        """Adds what waits to the totals of a new snapshot, and deletes the folders that it covers."""
        last, listed, waiting = self._state()
        if waiting:
            ids = self.spark.createDataFrame([(b,) for b in sorted(listed.union(waiting))], "batch string")
            ids = ids.select("batch", *[F.lit(None).cast("string").alias(k) for k in KEYS], *[F.lit(None).cast("long").alias(t) for t in TOTALS])
            sums = self.totals().select(F.lit(None).cast("string").alias("batch"), *KEYS, *TOTALS)
            new = 1 + int(last or 0)
            sums.union(ids).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/snapshot={new}")
            listed, last = listed.union(waiting), str(new)
        _, fs, jvm = self._fs()
        for name in [*[f"batch={b}" for b in self._committed("batch") if b in listed], *[f"snapshot={n}" for n in self._committed("snapshot") if n != last]]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, documents, tokens) over all committed batches."""
        last, _, waiting = self._state()
        rows = self._read(*([] if last is None else [f"snapshot={last}"]), *[f"batch={b}" for b in waiting]).where("documents is not null")
        sums = rows.groupBy(*KEYS).agg(*[F.sum(t).alias(t) for t in TOTALS])
        return sums.where(" or ".join(f"{t} <> 0" for t in TOTALS))


def _life(spark: SparkSession, counts: DataFrame, tokenizers: tuple[str, ...]) -> DataFrame:
    """The totals after a life of the table: documents arrive by their source, under the first tokenizer and then the
    others; short ones are taken back and sent again; counts of some sources stand wrong at first and are revised;
    batches are sent twice. At the end the totals are those of the whole table under every tokenizer."""
    rollup = Rollup(spark, scratch_dir(spark), pending=4)
    even = F.coalesce(F.col("source").rlike("[02468]$"), F.lit(False))
    first = counts.where(F.col("tokenizer") == tokenizers[0])
    rough = first.where(even).withColumn("tokens", F.col("tokens") + 1)
    rollup.apply("arrival-odd", inserts(first.where(~even)))
    rollup.apply("arrival-even", inserts(rough))
    rollup.apply("arrival-even", inserts(rough))
    rollup.apply("arrival-others", inserts(counts.where(F.col("tokenizer") != tokenizers[0])))
    rollup.apply("revision", revisions(rough, first.where(even)))
    short = counts.where("tokens < 100")
    rollup.apply("removal", deletes(short))
    rollup.apply("removal", deletes(short))
    rollup.apply("return", inserts(short))
    rollup.apply("revision", revisions(rough, first.where(even)))
    return rollup.totals()


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and documents by source, language and tokenizer, of all documents under both of TOKENIZERS."""
    counts = stored(counted(table(spark, sf_dir, "documents"), *map(tokenizer_path, TOKENIZERS)))  # numbers alone
    return _life(spark, counts, TOKENIZERS)


def token_rollup_by_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rollup under COUNTERS, which SQL can check."""
    counts = stored(counted(table(spark, sf_dir, "documents"), *COUNTERS))
    return _life(spark, counts, tuple(COUNTERS))


ORACLE = r"""
WITH d AS (SELECT source, lang, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS w,
  len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[0-9]|[^ \t\n\x0B\f\rA-Za-z0-9]')) AS p FROM documents)
SELECT source, lang, 'words-1' AS tokenizer, count(*) AS documents, CAST(sum(w) AS BIGINT) AS tokens FROM d GROUP BY ALL
UNION ALL SELECT source, lang, 'pieces-1', count(*), CAST(sum(p) AS BIGINT) FROM d GROUP BY ALL
"""
