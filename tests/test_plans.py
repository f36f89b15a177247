"""Whole runs over small files of sessions, with labels from stubs."""

import json

import pytest
from pyspark.sql import functions as F

from siftwell.operators.gates import Gate
from siftwell.plans import prompts, registry, run
from siftwell.plans import quality as qc
from siftwell.sources import sinks

ANSWER = "这是一个足够长的回答，" * 6 + "结束。"
SIGNATURE = {"goal": "G ", "subject_type": "s", "operations": ["b", "a", "a"], "data_dimensions": [], "temporal_shape": "t", "output_shape": []}
HARD = {
    "route": "complex", "complex_features": ["event_policy_impact", "unheard_of"], "exclusion_reasons": [], "evidence": [{"criterion": "event_policy_impact", "quote": "走势"}],
    "confidence": "high", "question_quality": "high", "semantic_signature": SIGNATURE,
}
CRITIC = {k: v for k, v in HARD.items() if k not in ("question_quality", "semantic_signature")}
NORMAL = {"route": "normal", "complex_features": [], "exclusion_reasons": ["simple_lookup"], "evidence": [], "confidence": "low"}
REJECT = {"route": "reject", "complex_features": [], "exclusion_reasons": ["eval_template"], "evidence": [], "confidence": "high"}
WORTHY = {"is_valuable": "true", "has_executable_task": True, "template_severity": "none"}


def turn(question, key="", tools=8, status="completed", answer=ANSWER):
    chain = [{"plan": "p", "tools": [{"name": f"t{k % 3}", "input": {"a": k}, "output": "o"} for k in range(tools)]}]
    return {"question": question, "answer": answer, "status": status, "chain": chain, "request_time": "2026-08-04 10:47:25", "trace_id": f"tr-{key}"}


def session(key, question, **more):
    return {"thread_id": key, "context": [turn(question, key, **more), 7]}


def by_question(*cases, default=None, field=None):
    """A labeller that answers by a word of what is asked: (word, answer) pairs, the first that fits."""

    def label(pairs):
        for key, payload in pairs:
            said = json.loads(payload)
            asked = said[field] if field else payload
            found = next((a for w, a in cases if w in json.dumps(asked, ensure_ascii=False)), default)
            yield key, found if found is None or isinstance(found, str) else json.dumps(found, ensure_ascii=False)

    return label


def labellers(**more):
    same = run.default_labeller
    return {
        "value": same(WORTHY), "complexity": same(HARD), "classify": same({"category_id": "03", "reason": "r"}), "verify": same(CRITIC),
        "template_family": same({"label": "natural_shared_phrase", "confidence": "high", "reason": "r"}), "dedup_pair": same({"label": "distinct"}), **more,
    }


def written(tmp_path, rows, *lines):
    source = tmp_path / "in.jsonl"
    source.write_text("\n".join([*[json.dumps(r, ensure_ascii=False) for r in rows], *lines]) + "\n", encoding="utf-8")
    return str(source)


def read(spark, path):
    return [json.loads(r["value"]) for r in spark.read.text(str(path)).collect()]


def test_a_run_from_lines_to_deliverables(spark, tmp_path):
    rows = [
        session("a", "请分析新能源行业未来三年的走势和主要风险"), session("a", "重复的会话不应该再次出现在结果里走势"), session("b", "请分析新能源行业未来三年的走势和主要风险!"),
        session("c", "比较两家公司的盈利能力和现金流走势如何", tools=1), session("d", "好的"), session("e", "失败的问题走势分析请给出完整步骤", status="failed"),
        session("f", "请详细说明宏观政策对债券市场走势的影响", answer="抱歉，我无法回答" + ANSWER), {"thread_id": "g", "context": []}, {"thread_id": "h", "context": "no array"},
        {"thread_id": "i", "context": [1]},
    ]
    source = written(tmp_path, rows, "", "{broken", "[1]")

    def pair(pairs):
        for key, payload in pairs:
            same = payload.count("新能源") == 2
            yield key, json.dumps({"label": "template_duplicate" if same else "distinct", "reason": "same"})

    out = run.run(spark, source, f"{tmp_path}/out", run.Settings(labellers=labellers(dedup_pair=pair), max_bad_lines=0.5))
    assert out["success"] and out["input_format"] == "session"
    want = {
        "input_duplicates": 1, "input_empty_sessions": 1, "input_bad_lines": 3, "total_sessions": 7, "empty_sessions": 1, "segments": 6, "candidates": 3,
        "complex_rows": 3, "semantic_dedup_candidates": 3, "semantic_dedup_removed": 1, "verify_complex_kept": 2, "answer_gate_rejected": 1, "output_rows": 1,
        "final_complex_rows": 1, "llm_failed": 0, "translate_failed": 0, "complex_feature_counts_final": {"event_policy_impact": 1},
    }
    assert {k: out[k] for k in want} == want
    got = read(spark, tmp_path / "out/complex")
    assert len(got) == 1 and len(got[0]) == 25
    row = got[0]
    assert row["category"] == "complex-topic/03-analysis-research" and row["request_time_ms"] == 1785811645000 and row["tools"] == ["t0", "t1", "t2"]
    assert row["chain"][0]["tools"][1]["input"] == {"a": 1} and row["meta"]["semantic_signature"]["operations"] == ["a", "b"]
    assert row["meta"]["semantic_signature"]["goal"] == "g" and row["meta"]["complexity_profile"]["verified_hard"] is True
    assert read(spark, tmp_path / "out/normal") == []
    bad = read(spark, tmp_path / "out/diagnostics/bad_lines")
    assert sorted((r["reason"], r["line_number"]) for r in bad) == [("adapt_failed", 9), ("invalid_json", 12), ("not_an_object", 13)]
    gone = read(spark, tmp_path / "out/diagnostics/deduped")
    assert [(r["trace_id"], r["dedup_of_trace_id"], r["method"], r["decision"]) for r in gone] == [("tr-b", "tr-a", "semantic_signature_llm", "template_duplicate")]
    assert read(spark, tmp_path / "out/diagnostics/answer_gate_rejected")[0]["reason"] == "refusal"
    assert json.loads((tmp_path / "out/summary.json").read_text())["logs"]["batch_id"] == out["logs"]["batch_id"]
    assert sinks.LineLog(spark, out["logs"]["business"]).read("complex").count() == 1
    stages = ("preclean", "rule_gate", "judge")
    again = run.run(spark, source, f"{tmp_path}/out", run.Settings(stages=stages))  # nothing is asked, so nothing comes out
    assert again["success"] and again["output_rows"] == 0 and again["output_preserved_previous"] and len(read(spark, tmp_path / "out/complex")) == 1


def test_segments_decide_what_came_before(spark, tmp_path):
    questions = ["请分析新能源行业走势和主要风险一", "请分析新能源行业走势和主要风险二", "请比较两家公司现金流走势差异三", "请比较两家公司现金流走势差异四"]
    rows = [{"thread_id": "a", "context": [turn(q, str(i)) for i, q in enumerate(questions)]}, session("b", "单独一个问题请分析走势和风险吧")]
    source = written(tmp_path, rows)
    for name, spans, n, want in (
        ("cut", [{"start": 0, "end": 1, "topic": "x"}, {"start": 2, "end": 2, "topic": "y"}], 3, {"tr-0": [], "tr-1": ["一"], "tr-2": ["一", "二"], "tr-3": ["三"], "tr-b": []}),
        ("whole", [{"start": 0, "end": 9, "topic": "x"}], 2, {"tr-0": [], "tr-1": ["一"], "tr-2": ["一", "二"], "tr-3": ["一", "二", "三"], "tr-b": []}),
    ):  # the first is repaired to end at 3, the second can't be
        s = run.State(spark, source, f"{tmp_path}/{name}", run.Settings(labellers={"segment": run.default_labeller({"segments": spans})}))
        for stage in ("preclean", "segment", "rule_gate"):
            s.stage = stage
            registry.get(stage)(s)
        assert s.stats["segments"] == n
        assert {r["trace_id"]: [c["question"][-1] for c in r["prior"]] for r in s.tables["candidates"].collect()} == want


def test_judging_and_verification_end_in_every_way(spark, tmp_path):
    words = ["留下", "降级", "拒绝", "失败", "错类", "普通", "无值", "模板", "坏标"]
    rows = [session(w, f"请分析{w}行业未来三年的走势和主要风险") for w in words]
    value = by_question(("无值", {"is_valuable": False}), ("模板", {**WORTHY, "template_severity": "severe"}), default=WORTHY)
    complexity = by_question(("普通", {**NORMAL, "question_quality": "low", "semantic_signature": SIGNATURE}), ("坏标", {**HARD, "evidence": [{"criterion": "event_policy_impact", "quote": "别处"}]}), default=HARD)
    verify = by_question(("降级", NORMAL), ("错类", NORMAL), ("拒绝", REJECT), ("失败", "no json"), default=CRITIC)
    # a category of the other half counts as no label
    after = by_question(("错类", {"category_id": "17"}), default={"category_id": "12", "reason": "new"})
    given = labellers(value=value, complexity=complexity, verify=verify, classify_normal_after_verify=after, translate=run.default_labeller({"translation": "x"}))
    out = run.run(spark, written(tmp_path, rows), f"{tmp_path}/out", run.Settings(labellers=given, dedup_enabled=False, verify_rounds=2))
    want = {
        "value_rejected": 2, "value_rejected_other": 1, "value_rejected_template": 1, "llm_failed": 1, "complex_rows": 5, "normal_rows": 1,
        "verify_complex_kept": 1, "verify_to_normal": 1, "verify_rejected_template": 1, "verify_failed": 2, "verify_uncertain": 1, "output_rows": 3,
        "translated": 0,  # nothing is translated after failures
    }
    assert {k: out[k] for k in want} == want
    got = {r["source_case_id"]: r for r in read(spark, tmp_path / "out/cleaned")}
    assert set(got) == {"留下", "降级", "普通"} and got["降级"]["category"] == "12-financial-logical-reasoning" and got["降级"]["meta"]["reason"] == "new"
    assert got["普通"]["category"] == "03-stock-diagnosis-and-data-lookup" and got["降级"]["meta"]["complexity_profile"]["route"] == "normal"
    verdicts = {r["source_case_id"]: r["action"] for r in read(spark, tmp_path / "out/diagnostics/verdicts")}
    assert verdicts == {"留下": "keep", "降级": "downgrade", "拒绝": "reject", "失败": "failed", "错类": "downgrade"}
    assert {r["session_key"] for r in read(spark, tmp_path / "out/diagnostics/judge_policy_rejected")} == {"模板"}
    assert [r["source_case_id"] for r in read(spark, tmp_path / "out/diagnostics/complex_policy_rejected")] == ["拒绝"]


def test_families_are_reviewed_before_rows_are_merged(spark, tmp_path):
    ask = lambda tail, i: f"请严格按照以下固定步骤完成{tail}的走势分析第{i}题"
    rows = [session(f"{t}{i}", ask(t * 9, i)) for t in "甲乙丙丁" for i in range(3)]
    verdict = lambda label, confidence="high": {"label": label, "confidence": confidence, "reason": "r"}
    family = by_question(
        ("丙丙", verdict("semantic_duplicate", "low")), ("甲甲", verdict("eval_template_family")), ("乙乙", verdict("semantic_duplicate")), ("丁丁", verdict("natural_shared_phrase")),
        default=verdict("natural_shared_phrase"), field="shared_phrases",
    )
    given = labellers(template_family=family, dedup_pair=run.default_labeller({"label": "exact_semantic", "reason": "r"}))
    out = run.run(spark, written(tmp_path, rows), f"{tmp_path}/out", run.Settings(labellers=given, post=True))
    got = {r["source_case_id"]: r["difficulty_level"] for r in read(spark, tmp_path / "out/cleaned")}
    # all 12 share a natural phrase, so those that the review leaves are not merged; doubtful families are normal
    assert got == {"乙0": "hard", "丙0": "normal", "丙1": "normal", "丙2": "normal", "丁0": "hard", "丁1": "hard", "丁2": "hard"}
    assert out["template_family_rejected"] == 1 and out["template_family_rejected_rows"] == 3 and out["template_family_duplicates"] == 2
    assert out["verify_uncertain"] == 3 and out["semantic_dedup_removed"] == 0 and out["dedup_removed"] == 5


def test_lexical_merging_and_translation(spark, tmp_path):
    rows = [session("a", "请分析新能源行业未来三年的走势和主要风险"), session("b", "请分析新能源行业未来三年的主要风险和走势"), session("c", "Please analyse 走势 of the whole market in the coming years")]
    given = labellers(translate=run.default_labeller({"translation": "翻译"}))
    out = run.run(spark, written(tmp_path, rows), f"{tmp_path}/lex", run.Settings(labellers=given, dedup_mode="lexical", threshold=0.5, verify_rounds=0))
    assert out["dedup_removed"] == 1 and out["translated"] == 1 and out["translate_skipped"] == 1
    done = {r["source_case_id"]: r["translation"] for r in read(spark, tmp_path / "lex/complex")}
    assert done["c"] == "翻译" and list(done.values()).count(None) == 1


def test_a_killed_run_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    source = written(tmp_path, [session("a", "请分析新能源行业未来三年的走势和主要风险")])
    ran = []
    stages = dict(registry._stages)

    def counted(name):
        def stage(s):
            ran.append(name)
            if name == "segment" and ran.count(name) == 1:
                raise KeyboardInterrupt
            stages[name](s)

        return stage

    monkeypatch.setattr(registry, "_stages", {n: counted(n) for n in stages})
    settings = run.Settings(stages=("precheck", "preclean", "segment", "rule_gate"))
    with pytest.raises(KeyboardInterrupt):
        run.run(spark, source, f"{tmp_path}/out", settings)
    out = run.run(spark, source, f"{tmp_path}/out", settings)
    assert ran == ["precheck", "preclean", "segment", "segment", "rule_gate"] and out["candidates"] == 1 and out["total_sessions"] == 1
    assert not (tmp_path / "out/state").exists()
    with pytest.raises(ValueError, match="in use"), sinks.Batch(spark, f"{tmp_path}/logs", "b"):
        run.run(spark, source, f"{tmp_path}/out", run.Settings(log_path=f"{tmp_path}/logs"), "b")
    with pytest.raises(ValueError):
        sinks.valid_batch_id("../x")


def test_a_bad_input_stops_before_any_label(spark, tmp_path):
    source = written(tmp_path, [{"thread_id": "a", "context": [{"question": "q", "answer": ""}]}])
    with pytest.raises(ValueError, match="no_eligible_turns"):
        run.run(spark, source, f"{tmp_path}/out")


def test_suggestions_hold_the_default(spark, tmp_path):
    source = written(tmp_path, [session(str(i), f"第{i}个问题请分析行业走势和风险", tools=i) for i in range(1, 14)])
    found = run.suggest(spark, source)
    assert sum(r["is_default"] for r in found) == 1
    assert next(r for r in found if r["is_default"])["candidates"] == 7
    assert Gate().for_dialect("chat").calls == 3


def record(i, text, **more):
    meta = {"reason": "r", "request_time": "", "run_id": "", "last_event_type": None, "semantic_signature": SIGNATURE, "complexity_profile": {"route": "complex"}}
    return {
        "capture_mode": "end2end", "user_cohort": "regular", "source_case_id": str(i), "answer_key": "", "trace_id": f"tr-{i}", "category": "complex-topic/03-analysis-research",
        "input": {"text": text, "image": "", "file": ""}, "context": [], "chain": [], "tools": ["t"], "raw_answer": ANSWER, "text_answer": ANSWER, "multimodal": [],
        "model_version": "", "release_id": "", "agent_mode": "", "translation": None, "user_id": "", "difficulty_level": "hard", "first_token_time_ms": 1.5,
        "finish_answer_time_ms": 2, "input_tokens": None, "output_tokens": 3, "request_time_ms": None, "meta": meta, **more,
    }


def test_the_command_line(spark, tmp_path, capsys):
    source = written(tmp_path, [session(str(i), f"请分析{x}行业未来三年的走势和主要风险") for i, x in enumerate("甲乙丙")])
    assert run.main(["run", source, "-o", f"{tmp_path}/none", "--no-llm", "--no-post", "--min-tool-calls", "2", "--stages", "precheck,preclean,rule_gate"]) == 0
    assert json.loads((tmp_path / "none/summary.json").read_text())["candidates"] == 3
    assert run.main(["suggest", source]) == 0
    empty = tmp_path / "empty.jsonl"
    empty.write_text("")
    assert run.main(["suggest", str(empty)]) == 1 and run.main(["precheck", str(empty), f"{tmp_path}/pre"]) == 1
    made = tmp_path / "complex.jsonl"
    made.write_text("\n".join(json.dumps(record(i, f"请分析{x}行业的走势")) for i, x in enumerate("甲乙丙")))
    audit = ["audit", str(made), "--folder", f"{tmp_path}/audit"]
    assert run.main(audit, {"audit": run.default_labeller(CRITIC)}) == 0
    assert run.main(audit, {"audit": by_question(("甲", NORMAL), ("乙", "nothing"), default=CRITIC)}) == 1
    said = capsys.readouterr().out
    assert "PASS: 3 rows" in said and "FAIL: 3 rows, 33.33% not complex, 33.33% undecided" in said and "| tr-0 | normal | 0 |" in said and "| tr-1 |  | 3 |" in said


def test_quality_control_of_a_deliverable(spark, tmp_path):
    rows = [record(i, f"请分析{x}行业未来三年的走势和主要风险") for i, x in enumerate("甲乙丙丁")]
    rows[1]["trace_id"], rows[2]["category"], rows[3]["tools"] = "", "nothing", "no list"
    rows.append({**rows[0], "extra": 1})
    made = tmp_path / "rows.jsonl"
    made.write_text("\n".join([*[json.dumps(r, ensure_ascii=False) for r in rows], "{"]), encoding="utf-8")
    gold = tmp_path / "gold"
    gold.mkdir()
    question = rows[0]["input"]["text"]
    (gold / "d_positive.jsonl").write_text("\n".join(json.dumps({"trace_id": t, "input": {"text": x}}) for t, x in (("tr-0", question), ("tr-9", "x"), ("tr-2", "other"))))
    (gold / "d_negative.jsonl").write_text(json.dumps({"trace_id": "tr-3", "input": {"text": rows[3]["input"]["text"]}}))
    good = {"question_quality": "high", "label_ok": True, "difficulty_ok": False, "reason": "r"}
    judge = by_question(("乙", {**good, "question_quality": "low", "difficulty_ok": True}), ("甲", "broken"), default=good)
    argv = ["run", "--dataset", "d", "--date", "0801", "--root", str(tmp_path), "--input", str(made), "--gold-gate", "--gold-dir", str(gold), "--ratio", "1"]
    assert qc.main(argv, judge) == 1
    out = qc.overview(spark, "d", "0801", str(tmp_path))
    assert out["total"] == 5 and out["skipped_bad_lines"] == 1 and out["status_counts"] == {"pass": 0, "fail": 2, "needs_review": 3}
    hits = {r["rule"]: r["failed"] for r in out["rule_hits"]}
    assert hits["structure"] == 1 and hits["category"] == 1 and hits["answer"] == 0 and len(hits) == 10
    assert out["sample"]["count"] == 5 and out["sample"]["judge_errors"] == 2 and out["sample"]["question_quality_low"] == 1
    found = out["quality_gate"]["complex_policy_gold"]
    assert found["missed_positive_ids"] == ["tr-9"] and found["positive_text_mismatch_ids"] == ["tr-2"] and found["negative_false_accept_ids"] == ["tr-3"]
    assert found["accepted"] == 1 and not out["quality_gate"]["passed"] and out["quality_gate"]["residual"]["families"] == 1
    rules = {r["rule"]: r for r in out["dataset_rules"]}
    assert len(rules) == 7 and not rules["near_duplicate"]["ok"] and rules["unknown_fields"]["evidence"] == ["extra"] and not rules["semantic_signature_duplicate"]["ok"]
    detail = qc.record_detail(spark, "d", "0801", "tr-2", str(tmp_path))
    assert detail["record"]["category"] == "nothing" and detail["qc"]["status"] == "fail"
    lines = [r["key"] for r in read(spark, tmp_path / "outputs/d/qc/0801/results")]
    assert lines[0] == "0|tr-0#1" and lines[1] == "line_2" and len(read(spark, tmp_path / "outputs/d/qc/0801/sampled")) == 5
    assert "## Release gate: FAIL" in (tmp_path / "outputs/d/qc/0801/report.md").read_text()
    with pytest.raises(KeyError):
        qc.record_detail(spark, "d", "0801", "none", str(tmp_path))
    with pytest.raises(FileNotFoundError):
        qc.overview(spark, "d", "0802", str(tmp_path))
    empty = tmp_path / "none.jsonl"
    empty.write_text("")
    assert qc.main([*argv[:7], "--input", str(empty), "--no-llm"]) == 0
    assert not qc.overview(spark, "d", "0801", str(tmp_path))["quality_gate"]["passed"]


def test_the_registries_refuse_doubles_and_strangers(tmp_path, monkeypatch):
    with pytest.raises(ValueError):
        registry.register("judge")(lambda s: None)
    with pytest.raises(ValueError):
        registry.get("nothing")
    with pytest.raises(ValueError):
        prompts.register("value", "x")
    with pytest.raises(KeyError):
        prompts.resolve("nothing")
    before = prompts.fingerprint()
    (tmp_path / "value.md").write_text("other")
    assert prompts.resolve("value", str(tmp_path)) == "other" and prompts.fingerprint(str(tmp_path)) != before
    monkeypatch.setenv(prompts.FOLDER_VARIABLE, str(tmp_path))
    assert prompts.resolve("value") == "other" and "complex-topic/01" in prompts.resolve("classify_complex")


def test_category_texts():
    found = prompts.parse_complex_examples("# Title\n### 01 First\nWhat it is.\nMore.\n示例：\n1. one\n- two\nrest\n### 02 Second\n")
    assert found == {"01": ("What it is. More. rest", ["one", "two"]), "02": ("", [])}
    for bad in ("### x", "body", "### 01 a\n### 01 b", "### 01 a\n## end\nbody"):
        with pytest.raises(ValueError):
            prompts.parse_complex_examples(bad)
    found = prompts.parse_normal_sections("## 01-a-b Name\n**What**: x\ny\n**Not**：\nz\n# end\n")
    assert found == {"01": ("Name", {"What": "x\ny", "Not": "z"})}
    for bad in ("## 01 a", "body"):
        with pytest.raises(ValueError):
            prompts.parse_normal_sections(bad)
    with pytest.raises(ValueError, match="01"):
        prompts.classify_prompt("hard", {"99": "x"})


def test_two_dialects_beside_a_third(spark, tmp_path):
    from siftwell.sources import dialects, jsonl

    chat = {"judge_data": {"case_id": "c", "input": {"text": "q"}, "context": [], "text_answer": "a"}}
    assert jsonl.sniff(spark, written(tmp_path, [chat])) == "chat"
    for bad in ([{"thread_id": "a"}], [chat, session("a", "q")], [{"x": 1}]):
        with pytest.raises(ValueError):
            jsonl.sniff(spark, written(tmp_path, bad))
    dialects.register("mail", ("subject",), lambda j: F.get_json_object(j, "$.subject") != "", lambda r: r)
    try:
        assert jsonl.sniff(spark, written(tmp_path, [{"subject": "s"}])) == "mail"
        with pytest.raises(ValueError):
            dialects.register("mail", (), lambda j: F.lit(True), lambda r: r)
    finally:
        dialects.unregister("mail")
