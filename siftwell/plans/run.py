"""A run: chat logs in, a cleaned, labelled and de-duplicated question set and a summary out; and the command line."""

from __future__ import annotations

import argparse
import json
import os
import sys
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.functions import rules, text
from siftwell.operators import gates, labels, turns
from siftwell.operators.store import cut, delete, exists, write_text
from siftwell.plans import prompts, report
from siftwell.plans import stages as _stages
from siftwell.plans.asks import ASKS
from siftwell.plans.registry import get, names
from siftwell.plans.state import Settings, State
from siftwell.sources import dialects, jsonl, sinks

__all__ = ["Settings", "State", "default_labeller", "main", "run", "run_file", "suggest"]

# How many families or pairs a judge is asked about at once.
BATCHES = {"template_family": ("families", "family_id", 10, False), "dedup_pair": ("pairs", "id", 20, True)}
#: Tables of a stage that are written below diagnostics, in the order of the input.
DIAGNOSTICS = ("segments", "candidates", "judged", "verdicts", "deduped", "answer_gate_rejected")


def default_labeller(answer: dict) -> labels.Labeller:
    """Gives every payload the same answer: for offline runs and tests."""
    raw = json.dumps(answer, ensure_ascii=False)

    def label(pairs):
        for key, _ in pairs:
            yield key, raw

    return label


def chat_labellers(complete: labels.Complete, prompt_folder: str | None = None, threads: int = 8) -> dict[str, labels.Labeller]:
    """Labellers of all steps by one service: complete(system, user), with retries."""
    complete = labels.retried(complete)
    out = {}
    for step, ask in ASKS.items():
        prompt = prompts.resolve(step, prompt_folder)
        if step in BATCHES:
            field, name, size, lenient = BATCHES[step]
            out[step] = labels.batched(complete, prompt, field, name, size, lenient, threads)
        else:
            out[step] = labels.prompted(complete, prompt, _is_object, ask.tries, threads)
    return out


def _is_object(answer: str) -> bool:
    start, end = answer.find("{"), answer.rfind("}")
    try:
        return isinstance(json.loads(answer[start : end + 1]), dict)
    except ValueError:
        return False


def run(spark: SparkSession, source: str, folder: str, settings: Settings | None = None, batch_id: str | None = None) -> dict:
    """Runs the stages and publishes what is left: all, hard and normal rows, rejects, diagnostics and a summary.

    A run without sessions, or with session errors, fails and leaves earlier deliverables in place, as does one
    without rows. A run that was killed goes on after its last complete stage when it is started again with the
    same settings, sources and input. No two runs share a batch id at the same time.
    """
    s = State(spark, source, folder.rstrip("/"), settings or Settings())
    logs = s.settings.log_path or f"{s.folder}/logs"
    with sinks.Batch(spark, logs, batch_id) as batch:
        delete(spark, f"{s.folder}/diagnostics")
        waiting = list(s.settings.stages or names())
        for name in waiting:
            get(name)
        while waiting and s.restored(waiting[0]):
            waiting.pop(0)
        for name in waiting:
            s.stage = name
            get(name)(s)
            s.done(name)
        return _publish(s, batch)


def _publish(s: State, batch: sinks.Batch) -> dict:
    defaults = {k: 0 for k in _stages.COUNTS} | {k: {} for k in _stages.HISTOGRAMS}
    rows = next((s.tables[t] for t in ("final", "answered", "verified", "rows") if t in s.tables), None)
    success = bool(s.stats.get("total_sessions")) and not s.stats.get("session_errors")
    out = {**defaults, **s.stats, **(_stages.final_counts(rows) if rows is not None else {}), "success": success}
    if rows is not None:
        shown = _deliverable(rows)
        there = exists(s.spark, f"{s.folder}/cleaned")
        if not sinks.publish(shown, s.folder, success) or (there and not out["output_rows"]):
            out["output_preserved_previous"] = True
        if success:
            sinks.LineLog(s.spark, batch.path("business")).append(shown.drop("row_ord"))
    _diagnostics(s)
    out["logs"] = {"batch_id": batch.id, "business": batch.path("business")}
    write_text(s.spark, f"{s.folder}/summary.json", json.dumps(out, ensure_ascii=False, indent=2, sort_keys=True, default=str))
    s.forget()
    return out


def _deliverable(rows: DataFrame) -> DataFrame:
    """rows with the tools' inputs as the JSON that they were."""
    value = lambda x: F.coalesce(F.try_parse_json(x), x.cast("variant"))
    tool = lambda t: F.struct(t["name"].alias("name"), value(t["input"]).alias("input"), t["output"].alias("output"))
    step = lambda x: F.struct(x["plan"].alias("plan"), F.transform(x["tools"], tool).alias("tools"))
    return rows.withColumn("chain", F.transform("chain", step))


def _diagnostics(s: State) -> None:
    """What each stage has left out or decided, as JSON lines; empty tables are not written."""
    bad = s.tables.get("rejects")
    if bad is not None:
        if "adapt_failed" in s.tables:
            bad = bad.unionByName(s.tables["adapt_failed"], True)
        _lines(s, "bad_lines", bad.withColumn("row_ord", F.struct("file", "line_number")))
    if not s.settings.diagnostics:
        return
    for name in DIAGNOSTICS:
        if name in s.tables:
            table = s.tables[name]
            if name in ("segments", "candidates", "judged"):
                inside = "seg_idx" if name == "segments" else "idx"
                key = s.tables["sessions"].select(F.col("row_ord").alias("session"), F.col("session_key").alias("thread_id"))
                told = {
                    "segments": ["seg_idx", "start", "end", "topic"],
                    "candidates": ["idx", F.left("question", F.lit(200)).alias("question")],
                    "judged": ["idx", F.left("question", F.lit(200)).alias("question"), "outcome"]
                    + [c for c in ("value", "complexity", "classify") if c in table.columns],
                }[name]
                table = table.join(key, "session").select(F.struct("session", inside).alias("row_ord"), "thread_id", *told)
            _lines(s, name, table)
    if "judged" in s.tables:
        v = F.col("value")
        refused = (F.col("outcome") == "complexity_rejected") | (v["template_severity"] == "severe") | v["contains_embedded_prompt"]
        _lines(s, "judge_policy_rejected", s.tables["judged"].where(refused).select(F.struct("session", "idx").alias("row_ord"), "session_key", "idx", "question", "outcome"))
    gone = [
        s.tables[t].where(F.col(c) == x).select("row_ord", "source_case_id", "trace_id", F.lit(c).alias("by"), F.lit(x).alias("decision"))
        for t, c, x in (("deduped", "decision", "eval_template_family"), ("verdicts", "action", "reject")) if t in s.tables
    ]
    if gone:
        _lines(s, "complex_policy_rejected", gone[0] if len(gone) == 1 else gone[0].union(gone[1]))


def _lines(s: State, name: str, table: DataFrame) -> None:
    if not table.isEmpty():
        jsonl.write_lines(table, f"{s.folder}/diagnostics/{name}")


def suggest(spark: SparkSession, source: str, dialect: str = "auto", top: int = 10) -> list[dict]:
    """Thresholds to choose from for an input."""
    name = jsonl.sniff(spark, source) if dialect == "auto" else dialect
    good, _ = jsonl.read_records(spark, source)
    sessions, _ = dialects.adapt(jsonl.with_order(good).select("row_ord", "json"), name)
    first = turns.keep_first(cut(sessions), F.col("session_key"), F.col("row_ord"))
    t = first.select("mode", F.size("turns").alias("n"), F.posexplode("turns").alias("idx", "t")).select("mode", "n", "idx", "t.*")
    ok = rules.eligible(F.col("question"), F.col("answer"), F.col("status"), F.col("outcome")) & ((F.col("mode") != "last_only") | (F.col("idx") == F.col("n") - 1))
    chain, count = F.col("chain"), F.col("tool_count")
    features = t.select(
        ok.alias("eligible"), rules.reject_reason(text.normalize_question(F.col("question"))).alias("reason"), gates.chain_calls(chain, count).alias("calls"),
        gates.chain_steps(chain, count).alias("steps"), F.size(gates.chain_tools(chain, F.col("tool_names"))).alias("tools"),
    )
    return gates.suggestions([r.asDict() for r in gates.threshold_grid(features).collect()], name, top)


def run_file(
    input_path: str, output_dir: str | None = None, *, spark: SparkSession | None = None, format: str = "auto", model: str = "offline", concurrency: int = 256,
    stages: list[str] | None = None, post_enabled: bool = True, dedup_mode: str = "semantic", semantic_dedup_threshold: float | None = None,
    max_dedup_candidates: int = 20, dedup_threshold: float | None = None, verify_rounds_hard: int | None = None, work_dir: str | None = None,
    log_dir: str | None = None, batch_id: str | None = None, llm_enabled: bool = True, precheck_enabled: bool = True,
    precheck_min_chain_coverage: float | None = None, min_tool_calls: int | None = None, min_unique_tools: int | None = None,
    reject_rules: bool = True, api_key: str | None = None, base_url: str | None = None, llm_extra_body: dict | None = None,
    labellers: dict[str, labels.Labeller] | None = None, verbose: bool = False,
) -> dict:
    """run() by single options. Without labellers, and with llm_enabled, a chat service is asked: api_key and base_url, or
    OPENAI_API_KEY and OPENAI_BASE_URL, name it. concurrency is the number of calls at a time over all executors."""
    spark = spark or SparkSession.builder.appName("siftwell").getOrCreate()
    spark.sparkContext.setLogLevel("INFO" if verbose else "WARN")
    base = Settings()
    if llm_enabled and labellers is None:
        key, url = api_key or os.environ.get("OPENAI_API_KEY"), base_url or os.environ.get("OPENAI_BASE_URL")
        if not key or not url:
            raise ValueError("a run that asks a model needs OPENAI_API_KEY and OPENAI_BASE_URL, or api_key and base_url")
        threads = max(1, concurrency // max(1, spark.sparkContext.defaultParallelism))
        labellers = chat_labellers(labels.http_complete(url, key, model, extra=llm_extra_body), threads=threads)
    given = lambda value, default: default if value is None else value
    output_dir = output_dir or f"outputs/{os.path.basename(os.path.dirname(os.path.abspath(input_path)))}"
    settings = replace(
        base, dialect=format, gate=gates.Gate(min_tool_calls, 1, min_unique_tools, reject_rules), min_chain_coverage=given(precheck_min_chain_coverage, base.min_chain_coverage),
        precheck=precheck_enabled, post=post_enabled, dedup_mode=dedup_mode, threshold=given(dedup_threshold, base.threshold),
        candidate_threshold=given(semantic_dedup_threshold, base.candidate_threshold), max_candidates=max_dedup_candidates,
        verify_rounds=given(verify_rounds_hard, base.verify_rounds), labellers=(labellers or {}) if llm_enabled else {}, model=model,
        label_path=f"{work_dir}/labels" if work_dir else None, log_path=log_dir, stages=tuple(stages) if stages else None,
    )
    return run(spark, input_path, output_dir, settings, batch_id)


def audit(spark: SparkSession, source: str, labeller: labels.Labeller, folder: str, max_ratio: float = 0.02, max_errors: float = 0.0) -> tuple[dict, list[dict]]:
    """(conclusion, disputed rows, 100 at most) of three independent votes on each row of a complex deliverable."""
    good, bad = jsonl.read_records(spark, source)
    if not bad.isEmpty():
        jsonl.write_lines(bad, f"{folder}/bad_lines", order="line_number")
    rows = cut(jsonl.with_order(good).select(
        F.col("row_ord").alias("id"), F.get_json_object("json", "$.trace_id").alias("trace_id"), F.get_json_object("json", "$.category").alias("category"),
        F.coalesce(F.get_json_object("json", "$.input.text"), F.lit("")).alias("question"),
    ))
    s = State(spark, source, folder, Settings(labellers={"audit": labeller}, label_path=f"{folder}/audit-{sinks.new_batch_id()}"))
    asked = rows.withColumn("payload", F.to_json(F.struct("question")))
    votes = None
    for k in range(3):
        said = s.labelled("audit", asked, "audit", f"_{k}").select("id", F.lit(k).alias("vote"), "audit")
        votes = said if votes is None else votes.union(said)
    a = F.col("audit")
    why = F.coalesce(F.nullif(a["reason"], F.lit("")), a["route"])
    ballots = votes.select("id", "vote", F.coalesce(a["route"] == "complex", F.lit(False)).alias("complex"), why.alias("reason"), a.isNull().alias("error"))
    results = cut(labels.majority(ballots))
    out = labels.audit_conclusion(results, max_ratio, max_errors).first().asDict()
    disputed = results.where("not is_complex or errors > 0").join(rows, "id").orderBy("id").limit(100)
    return out, [r.asDict() for r in disputed.select(F.col("trace_id").alias("id"), "category", "reason", "errors").collect()]


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siftwell", description="Turns chat logs into a clean, labelled, de-duplicated question set.")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="run the stages on a JSON-lines input")
    r.add_argument("input")
    r.add_argument("output", nargs="?")
    r.add_argument("-o", "--output-dir")
    r.add_argument("--format", default="auto")
    r.add_argument("--model", default="offline")
    r.add_argument("--concurrency", type=int, default=256)
    r.add_argument("--stages", type=lambda x: x.split(","))
    r.add_argument("--no-post", action="store_true")
    r.add_argument("--work-dir")
    r.add_argument("--no-llm", action="store_true")
    r.add_argument("--skip-precheck", action="store_true")
    r.add_argument("--allow-no-chain", action="store_true")
    r.add_argument("--min-tool-calls", type=int)
    r.add_argument("--min-unique-tools", type=int)
    r.add_argument("--no-reject-rules", action="store_true")
    r.add_argument("--verify-rounds", type=int)
    r.add_argument("--dedup-mode", choices=("semantic", "lexical"), default="semantic")
    r.add_argument("--semantic-dedup-threshold", type=float)
    r.add_argument("--max-dedup-candidates", type=int, default=20)
    r.add_argument("--dedup-threshold", type=float)
    r.add_argument("--api-key")
    r.add_argument("--base-url")
    r.add_argument("--no-reasoning", action="store_true")
    c = sub.add_parser("precheck", help="profile an input")
    c.add_argument("input")
    c.add_argument("output", nargs="?", default="out")
    c.add_argument("--format", default="auto")
    c.add_argument("--min-chain-coverage", type=float, default=0.5)
    c.add_argument("--max-bad-line-ratio", type=float, default=0.01)
    g = sub.add_parser("suggest", help="thresholds to choose from for an input")
    g.add_argument("input")
    g.add_argument("--format", default="auto")
    g.add_argument("--top", type=int, default=10)
    a = sub.add_parser("audit", help="judge the rows of a complex deliverable again, by three votes")
    a.add_argument("input")
    a.add_argument("--folder", default="audit")
    a.add_argument("--max-ratio", type=float, default=0.02)
    a.add_argument("--max-error-ratio", type=float, default=0.0)
    a.add_argument("--model", default="offline")
    a.add_argument("--concurrency", type=int, default=64)
    for x in (r, g, a):
        x.add_argument("--log-dir")
        x.add_argument("--batch-id")
        x.add_argument("-v", "--verbose", action="store_true")
    return p


def main(argv: list[str] | None = None, labellers: dict[str, labels.Labeller] | None = None) -> int:
    """python -m siftwell.plans.run run | precheck | suggest | audit ...; 1 if that fails. labellers take the place of a service."""
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("siftwell").getOrCreate()
    try:
        if a.command == "suggest":
            found = suggest(spark, a.input, a.format, a.top)
            print(report.suggestions(found) if found else "nothing to suggest")
            return 0 if found else 1
        if a.command == "precheck":
            settings = Settings(dialect=a.format, min_chain_coverage=a.min_chain_coverage, max_bad_lines=a.max_bad_line_ratio, precheck=False, stages=("precheck",))
            out = run(spark, a.input, a.output, settings)
            print(report.precheck(out))
            return int(any(i["severity"] == "critical" for i in out["issues"]))
        if a.command == "audit":
            labeller = (labellers or {}).get("audit")
            if labeller is None:
                complete = labels.http_complete(os.environ["OPENAI_BASE_URL"], os.environ["OPENAI_API_KEY"], a.model)
                labeller = chat_labellers(complete, threads=max(1, a.concurrency // max(1, spark.sparkContext.defaultParallelism)))["audit"]
            out, disputed = audit(spark, a.input, labeller, a.folder, a.max_ratio, a.max_error_ratio)
            print(report.audit(out, disputed) if out["total"] else "no rows")
            return 0 if out["total"] and out["passed"] else 1
        out = run_file(
            a.input, a.output_dir or a.output, spark=spark, format=a.format, model=a.model, concurrency=a.concurrency, stages=a.stages, post_enabled=not a.no_post,
            dedup_mode=a.dedup_mode, semantic_dedup_threshold=a.semantic_dedup_threshold, max_dedup_candidates=a.max_dedup_candidates,
            dedup_threshold=a.dedup_threshold, verify_rounds_hard=a.verify_rounds, work_dir=a.work_dir, log_dir=a.log_dir, batch_id=a.batch_id,
            llm_enabled=not a.no_llm, precheck_enabled=not a.skip_precheck, precheck_min_chain_coverage=0.0 if a.allow_no_chain else None,
            min_tool_calls=a.min_tool_calls, min_unique_tools=a.min_unique_tools, reject_rules=not a.no_reject_rules, api_key=a.api_key, base_url=a.base_url,
            llm_extra_body={"thinking": {"type": "disabled"}} if a.no_reasoning else None, labellers=labellers, verbose=a.verbose,
        )
        print(json.dumps(out, ensure_ascii=False, indent=1, default=str))
        return 0 if out["success"] else 1
    except (ValueError, KeyError) as error:
        print(error, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
