"""Quality control of a deliverable: rules on every row, a judge on a sample, dataset rules, gold sets, a report and its lookups."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.operators import labels, quality
from siftwell.operators.store import cut, exists, read_text, write_text
from siftwell.plans import report
from siftwell.plans.state import Settings, State
from siftwell.sources import jsonl, sinks


def source_path(dataset: str, root: str = ".") -> str:
    return f"{root}/outputs/{dataset}/cleaned"


def qc_path(dataset: str, date: str, root: str = ".") -> str:
    return f"{root}/outputs/{dataset}/qc/{date}"


def read_gold(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    """(id, text, positive) of <dataset>_positive.jsonl and <dataset>_negative.jsonl below folder; an error if there is neither."""
    name = dataset.strip().lower()
    parts = []
    for kind in ("positive", "negative"):
        path = f"{folder}/{name}_{kind}.jsonl"
        if not exists(spark, path):
            raise ValueError(f"no gold set {path}")
        rows = jsonl.read_strict(spark, path, "trace_id string, input struct<text:string>")
        parts.append(rows.select(F.col("trace_id").alias("id"), F.coalesce("input.text", F.lit("")).alias("text"), F.lit(kind == "positive").alias("positive")))
    return parts[0].union(parts[1])


def run_quality(
    spark: SparkSession, source: str, folder: str, dataset: str, date: str, ratio: float = 0.05, seed: int = 42, labeller: labels.Labeller | None = None,
    gold: DataFrame | None = None, model: str = "offline", label_path: str | None = None, batch_id: str | None = None,
) -> dict:
    """Checks the rows below source and writes results, overview.json, report.md, sampled rows and bad lines to folder; gives the overview.

    Without a labeller nothing is sampled, and the release gate fails, as it does without a sampled hard row.
    """
    with sinks.Batch(spark, f"{folder}/logs", batch_id):
        good, bad = jsonl.read_records(spark, source)
        records = cut(quality.typed(jsonl.with_order(good)))
        bad = cut(bad)
        if not bad.isEmpty():
            jsonl.write_lines(bad, f"{folder}/bad_lines", order="line_number")
        rules = quality.run_dataset_rules(records)
        judged = spark.createDataFrame([], "row_ord long, verdict struct<question_quality:string,label_ok:boolean,difficulty_ok:boolean,reason:string>")
        if labeller is not None:
            s = State(spark, source, folder, Settings(labellers={"qc_judge": labeller}, model=model, label_path=label_path or f"{folder}/labels"))
            sample = quality.seeded_sample(records, ratio, seed).withColumn("payload", quality.judge_payload(records))
            judged = cut(s.labelled("qc_judge", sample, "verdict").select("row_ord", "verdict"))
        results = cut(quality.build_results(records, judged))
        out = quality.overview(results, dataset, date)
        sample = quality.sample_counts(results)
        residual = quality.residual_duplicates(records, "signature").first().asDict()
        found = None
        if gold is not None:
            rows = records.select(F.col("trace_id").alias("id"), F.coalesce("input.text", F.lit("")).alias("text"), (F.col("difficulty_level") == "hard").alias("hard"), "row_ord")
            found = quality.gold_report(gold, rows)
        verdict = results.select("sampled", (F.col("difficulty_level") == "hard").alias("hard"), F.col("judge.difficulty_ok").alias("difficulty_ok"), F.col("judge.error").alias("error"))
        gate = quality.release_gate(verdict, F.lit(residual["rate"]), F.lit(found is None or found["passed"])).first().asDict()
        out |= {
            "source": source, "skipped_bad_lines": bad.count(), "sample": {**sample, "ratio": ratio, "seed": seed}, "dataset_rules": rules,
            "quality_gate": {**gate, "residual": residual, "complex_policy_gold": found}, "generated_at": datetime.now(timezone.utc).isoformat(timespec="seconds"),
        }
        jsonl.write_lines(results, f"{folder}/results")
        if sample["count"]:
            jsonl.write_lines(results.where("sampled").select("row_ord", "id", "source_case_id", "category", "question", "judge"), f"{folder}/sampled")
        write_text(spark, f"{folder}/overview.json", json.dumps(out, ensure_ascii=False, indent=2, default=str))
        write_text(spark, f"{folder}/report.md", report.quality(out))
        return out


def overview(spark: SparkSession, dataset: str, date: str, root: str = ".") -> dict:
    """The overview of a check; FileNotFoundError if there was none."""
    return json.loads(read_text(spark, f"{qc_path(dataset, date, root)}/overview.json"))


def record_detail(spark: SparkSession, dataset: str, date: str, record_id: str, root: str = ".") -> dict:
    """The first row of a trace id, as it was read, and its result, if any; KeyError without such a row."""
    folder = qc_path(dataset, date, root)
    source = overview(spark, dataset, date, root)["source"] if exists(spark, f"{folder}/overview.json") else source_path(dataset, root)
    good, _ = jsonl.read_records(spark, source)
    row = good.where(F.get_json_object("json", "$.trace_id") == record_id).orderBy("file", "line_number").limit(1).collect()
    if not row:
        raise KeyError(record_id)
    result = []
    if exists(spark, f"{folder}/results"):
        result = jsonl.read_records(spark, f"{folder}/results")[0].where(F.get_json_object("json", "$.id") == record_id).orderBy("file", "line_number").limit(1).collect()
    return {"record": json.loads(row[0]["json"]), "qc": json.loads(result[0]["json"]) if result else None}


def main(argv: list[str] | None = None, labeller: labels.Labeller | None = None) -> int:
    """python -m siftwell.plans.quality run --dataset NAME --date DATE ...; 1 if the gold gate fails. labeller takes the place of a service."""
    p = argparse.ArgumentParser(prog="siftwell-quality")
    p.add_argument("command", choices=("run",))
    p.add_argument("--dataset", required=True)
    p.add_argument("--date", required=True)
    p.add_argument("--ratio", type=float, default=0.05)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--no-llm", action="store_true")
    p.add_argument("--gold-gate", action="store_true")
    p.add_argument("--gold-dir", default="gold")
    p.add_argument("--model", default="offline")
    p.add_argument("--concurrency", type=int, default=64)
    p.add_argument("--root", default=".")
    p.add_argument("--input")
    p.add_argument("--qc-dir")
    p.add_argument("--cache")
    p.add_argument("--batch-id")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("siftwell-quality").getOrCreate()
    try:
        source, folder = a.input or source_path(a.dataset, a.root), a.qc_dir or qc_path(a.dataset, a.date, a.root)
        if not exists(spark, source):
            raise ValueError(f"no input {source}")
        gold = read_gold(spark, a.gold_dir, a.dataset) if a.gold_gate else None
        if not a.no_llm and labeller is None:
            import os

            from siftwell.plans.run import chat_labellers

            complete = labels.http_complete(os.environ["OPENAI_BASE_URL"], os.environ["OPENAI_API_KEY"], a.model)
            labeller = chat_labellers(complete, threads=max(1, a.concurrency // max(1, spark.sparkContext.defaultParallelism)))["qc_judge"]
        out = run_quality(spark, source, folder, a.dataset, a.date, a.ratio, a.seed, None if a.no_llm else labeller, gold, a.model, a.cache, a.batch_id)
    except (ValueError, KeyError) as error:
        print(error, file=sys.stderr)
        return 1
    print(report.quality(out))
    return int(a.gold_gate and not out["quality_gate"]["passed"])


if __name__ == "__main__":
    sys.exit(main())
