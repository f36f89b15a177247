"""Labels from a pluggable labeller, kept by a hash of what was asked.

A labeller is a function from an iterator of (key, payload) pairs to (key, raw label or None) pairs; it
runs on the executors, one call for each partition, and may batch, retry and call a service as it likes.
A payload that it cannot label gives None and counts as failed; it never fails the task.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.functions.text import content_key
from siftwell.operators.store import cut, exists, kept, scratch

Labeller = Callable[[Iterator[tuple[str, str]]], Iterable[tuple[str, str | None]]]
Complete = Callable[[str, str], str]
SCHEMA = "step string, generation string, key string, label string"
#: Payloads that one task labels, and tasks at most.
ASKED_PER_TASK, MOST_TASKS = 200, 4096

# Tries of a call, and how long to wait between them.
ATTEMPTS, FIRST_WAIT, LONGEST_WAIT, JITTER = 5, 1.5, 30.0, 0.5


class Refused(Exception):
    """A service answered with an error status."""

    def __init__(self, status: int, message: str = ""):
        super().__init__(f"{status} {message}".strip())
        self.status = status


def retried(complete: Complete, attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep) -> Complete:
    """complete(system, user) with retries after lost connections, empty answers and the statuses 429 and 5xx.

    Other statuses are raised at once. The wait doubles from FIRST_WAIT to LONGEST_WAIT, and a little at random.
    """

    def call(system: str, user: str) -> str:
        for attempt in range(attempts):
            try:
                if answer := complete(system, user):
                    return answer
                error: Exception = ValueError("empty answer")
            except Refused as refused:
                if refused.status != 429 and refused.status < 500:
                    raise
                error = refused
            except (OSError, ValueError, IndexError, KeyError) as failed:
                error = failed
            if attempt + 1 < attempts:
                sleep(min(LONGEST_WAIT, FIRST_WAIT * 2**attempt) + random.uniform(0, JITTER))
        raise RuntimeError(f"no answer after {attempts} tries: {error}")

    return call


def http_complete(base_url: str, api_key: str, model: str, timeout: float = 90.0, extra: dict | None = None) -> Complete:
    """complete(system, user) by a chat-completions service; answers are JSON objects."""

    def call(system: str, user: str) -> str:
        import urllib.error
        import urllib.request

        messages = [{"role": "system", "content": system}, {"role": "user", "content": user}]
        body = {"model": model, "messages": messages, "response_format": {"type": "json_object"}, "temperature": 0, **(extra or {})}
        headers = {"Content-Type": "application/json", "Authorization": f"Bearer {api_key}"}
        request = urllib.request.Request(f"{base_url.rstrip('/')}/chat/completions", json.dumps(body).encode(), headers)
        try:
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return json.load(answer)["choices"][0]["message"]["content"]
        except urllib.error.HTTPError as error:
            raise Refused(error.code, str(error.reason)) from error

    return call


def prompted(complete: Complete, prompt: str, ok: Callable[[str], bool] | None = None, tries: int = 1, threads: int = 1) -> Labeller:
    """A labeller that asks complete with a prompt and each payload, threads at a time.

    An answer that is not ok is asked for again, tries times in all; then, and after an error, the label is None.
    """

    def one(pair: tuple[str, str]) -> tuple[str, str | None]:
        key, payload = pair
        for _ in range(tries):
            try:
                answer = complete(prompt, payload)
            except Exception:  # a failed call is a failed label, not a failed task
                return key, None
            if ok is None or ok(answer):
                return key, answer
        return key, None

    def label(pairs: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str | None]]:
        pairs = iter(pairs)
        with ThreadPoolExecutor(max(1, threads)) as pool:
            while part := list(islice(pairs, 16 * max(1, threads))):
                yield from pool.map(one, part)

    return label


def batched(complete: Complete, prompt: str, field: str, name: str, size: int, lenient: bool = False, threads: int = 1) -> Labeller:
    """A labeller that asks for size payloads at once: {field: [payload, ...]}, each with its key as name, answered by {"items": [...]}.

    The answer's names must be those asked for, each once; else all of the batch fails. lenient allows some to be missing.
    """

    def one(part: list[tuple[str, str]]) -> list[tuple[str, str | None]]:
        nothing = [(key, None) for key, _ in part]
        items = [{**json.loads(payload), name: key} for key, payload in part]
        try:
            found = json.loads(complete(prompt, json.dumps({field: items}, ensure_ascii=False, separators=(",", ":"))))["items"]
            by_key = {x[name]: {k: v for k, v in x.items() if k != name} for x in found}
        except Exception:  # as above
            return nothing
        asked = {key for key, _ in part}
        if len(by_key) != len(found) or by_key.keys() - asked or (asked - by_key.keys() and not lenient):
            return nothing
        return [(key, json.dumps(by_key[key], ensure_ascii=False) if key in by_key else None) for key, _ in part]

    def label(pairs: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str | None]]:
        pairs = iter(pairs)
        parts = iter(lambda: list(islice(pairs, size)), [])
        with ThreadPoolExecutor(max(1, threads)) as pool:
            while some := list(islice(parts, 4 * max(1, threads))):
                for out in pool.map(one, some):
                    yield from out

    return label


def label_key(step: str, model: str, prompt: str, payload: Column) -> Column:
    return content_key(F.lit(step), F.lit(model), F.lit(prompt), payload)


class LabelTable:
    """Labels as Parquet by step and generation (a fingerprint of prompts and settings); the first of a key counts.

    Labels of other generations stay in place but are not read, so a change of prompts starts afresh;
    compacted() writes what is live to a new place.
    """

    def __init__(self, spark: SparkSession, path: str, generation: str):
        self.spark, self.path, self.generation = spark, path, generation

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(f"{SCHEMA}, seq long").parquet(self.path).where(F.col("generation") == self.generation)

    def read(self, step: str) -> DataFrame:
        """(key, label) of a step."""
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], "key string, label string")
        return self._rows().where(F.col("step") == step).groupBy("key").agg(F.min_by("label", "seq").alias("label"))

    def append(self, step: str, labels: DataFrame) -> None:
        """Adds (key, label); a label that is null is not kept."""
        seq = F.lit(self.spark.sparkContext._jvm.System.currentTimeMillis()).alias("seq")
        rows = labels.where("label is not null").select(F.lit(step).alias("step"), F.lit(self.generation).alias("generation"), "key", "label", seq)
        rows.write.mode("append").partitionBy("step", "generation").parquet(self.path)

    def compacted(self, path: str) -> LabelTable:
        """A table at path with this generation's labels only, each key once; this one stays as it is."""
        out = LabelTable(self.spark, path, self.generation)
        if exists(self.spark, self.path):
            rows = self._rows().groupBy("step", "generation", "key").agg(F.min_by(F.struct("label", "seq"), "seq").alias("l"))
            rows.select("step", "generation", "key", "l.label", "l.seq").write.mode("overwrite").partitionBy("step", "generation").parquet(path)
        return out


def labelled(
    asked: DataFrame, table: LabelTable, step: str, labeller: Labeller, valid: Column | Callable[[DataFrame], DataFrame], per_task: int = ASKED_PER_TASK
) -> DataFrame:
    """asked (key, payload, ...) with label: known ones by a join, the others from the labeller, which are then kept.

    valid says whether a label (column label) may be used, as a column or as a function that adds a column ok; it may
    read other columns of asked that belong to the key. A known label that is not valid is asked again, and an
    answer that is not valid is null. Equal keys are asked once, per_task of them in a task.
    """
    checked = valid if callable(valid) else lambda df: df.withColumn("ok", F.coalesce(valid, F.lit(False)))
    known = checked(asked.join(table.read(step), "key")).where("ok").select("key").distinct()
    lacking = cut(asked.select("key", "payload").dropDuplicates(["key"]).join(known, "key", "left_anti"))
    n = lacking.count()
    if n:

        def run(batches):
            import pandas as pd

            def pairs():
                for pdf in batches:
                    yield from zip(pdf["key"], pdf["payload"], strict=True)

            keys, labels = [], []
            for key, label in labeller(pairs()):
                keys.append(key)
                labels.append(label)
                if len(keys) >= 1000:
                    yield pd.DataFrame({"key": keys, "label": labels})
                    keys, labels = [], []
            yield pd.DataFrame({"key": keys, "label": labels}, dtype=object)

        fresh = lacking.repartition(min(MOST_TASKS, -(-n // per_task)), "key").mapInPandas(run, "key string, label string")
        fresh = kept(fresh, scratch(lacking.sparkSession))
        good = checked(asked.join(fresh, "key")).where("ok").select("key", "label").dropDuplicates(["key"])
        table.append(step, good)
    out = checked(asked.join(table.read(step), "key", "left"))
    return out.withColumn("label", F.when(F.col("ok"), F.col("label"))).drop("ok")


def funnel_outcome(value_ok: Column, value_kind: Column, admitted: Column, route: Column, failed: Column) -> Column:
    """What becomes of a candidate after the value gate, the complexity gate and classification."""
    return (
        F.when(failed, "llm_failed").when(~value_ok, F.concat(F.lit("value:"), value_kind))
        .when(route == "reject", "policy_rejected").when(admitted, "hard").when(route == "complex", "ungrounded").otherwise("normal")
    )


def verify_outcome(votes: Column) -> Column:
    """Of votes admit, downgrade, reject or error in order: no vote or all admit keeps; the first other vote decides."""
    first = F.try_element_at(F.filter(votes, lambda v: v != "admit"), F.lit(1))
    return F.when(first.isNull(), "keep").when(first == "error", "failed").otherwise(first)


def majority(votes: DataFrame) -> DataFrame:
    """(id, is_complex, reason, errors) of votes (id, vote, complex, reason, error); a vote in error counts as complex, and as an error."""
    ballot = F.col("error") | F.col("complex")
    reasons = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(~ballot, F.struct("vote", "reason")))), lambda x: x["reason"]))
    out = votes.groupBy("id").agg((F.count_if(ballot) >= 2).alias("is_complex"), reasons.alias("r"), F.count_if("error").alias("errors"))
    return out.select("id", "is_complex", F.left(F.array_join("r", "; "), F.lit(120)).alias("reason"), "errors")


def audit_conclusion(results: DataFrame, max_ratio: float = 0.02, max_errors: float = 0.0) -> DataFrame:
    """One row (total, not_complex_ratio, error_ratio, passed); no rows at all pass."""
    n = F.greatest(F.count("*"), F.lit(1))
    shares = ((F.count_if(~F.col("is_complex")) / n).alias("not_complex_ratio"), (F.count_if(F.col("errors") > 0) / n).alias("error_ratio"))
    out = results.agg(F.count("*").alias("total"), *shares)
    return out.withColumn("passed", (F.col("not_complex_ratio") <= max_ratio) & (F.col("error_ratio") <= max_errors))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows with row_ord from 0 in the given order, without bringing all rows to one task.

    Rows are dealt by ranges of the order; each range counts on from the sizes of those before it.
    """
    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = cut(dealt.select("*", F.spark_partition_id().alias("part no"), F.monotonically_increasing_id().alias("place no")))
    sizes = dealt.groupBy("part no").agg(F.count("*").alias("n"))
    so_far = Window.orderBy("part no").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part no", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"))
    first = dealt.groupBy("part no").agg(F.min("place no").alias("first"))  # one task counts a range's ids up by one
    out = dealt.join(F.broadcast(before.join(first, "part no")), "part no")
    return out.withColumn("row_ord", F.col("before") + F.col("place no") - F.col("first")).drop("part no", "place no", "before", "first")
