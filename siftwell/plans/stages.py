"""The stages of a run, from chat logs to rows of the deliverable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions import rules, text
from siftwell.operators import dedup, families, gates, labels, quality, turns
from siftwell.operators.store import cut
from siftwell.plans.registry import register
from siftwell.plans.state import State
from siftwell.sources import dialects, jsonl

# The names of the summary and what they hold where a stage has not run.
COUNTS = (
    "total_sessions", "input_bad_lines", "input_duplicates", "input_empty_sessions", "segments", "candidates", "complex_rows", "normal_rows",
    "value_rejected", "value_rejected_no_task", "value_rejected_not_self_contained", "value_rejected_template", "value_rejected_other",
    "llm_failed", "empty_sessions", "session_errors", "complexity_rejected", "verify_complex_kept", "verify_to_normal",
    "verify_rejected_template", "template_family_rejected", "template_family_rejected_rows", "template_family_candidates",
    "template_family_duplicates", "template_family_failed", "duplicate_removed", "verify_uncertain", "verify_failed", "final_complex_rows",
    "final_normal_rows", "answer_gate_rejected", "dedup_removed", "semantic_dedup_candidates", "semantic_dedup_removed",
    "semantic_dedup_failed", "translated", "translate_skipped", "translate_failed", "output_rows",
)
HISTOGRAMS = (
    "category_counts", "category_counts_normal", "complex_feature_counts_initial", "complex_feature_counts_final", "category_counts_final",
    "category_counts_normal_final",
)
#: Failures after which rows are neither merged nor translated.
FAILURES = ("llm_failed", "session_errors", "verify_failed", "template_family_failed", "semantic_dedup_failed")
WHOLE = "whole_session"
CRITIC = (
    "struct<route:string,complex_features:array<string>,exclusion_reasons:array<string>,"
    "evidence:array<struct<criterion:string,quote:string>>,confidence:string,reason:string>"
)


def histogram(rows: DataFrame, value: Column) -> dict[str, int]:
    """How often each value occurs, in order of the values; the values are of closed lists."""
    found = rows.groupBy(value.cast("string").alias("v")).count().where("v is not null").collect()
    return {r["v"]: r["count"] for r in sorted(found, key=lambda r: r["v"])}


def read(s: State) -> None:
    """records, rejects and adapted (row_ord, session_key, mode, reject, turns), once."""
    if "adapted" in s.tables:
        return
    good, bad = jsonl.read_records(s.spark, s.source)
    s.stats["input_format"] = jsonl.sniff(s.spark, s.source) if s.settings.dialect == "auto" else s.settings.dialect
    records = s.keep("records", jsonl.with_order(good))
    s.keep("rejects", bad)
    s.keep("adapted", dialects.adapted(records.select("row_ord", "json"), s.stats["input_format"]))


@register("precheck")
def precheck(s: State) -> None:
    """Profiles the input and stops the run on a critical issue."""
    read(s)
    n_bad, n_good = s.tables["rejects"].count(), s.tables["records"].count()
    turn = lambda x: F.struct(
        rules.eligible(x["question"], x["answer"], x["status"], x["outcome"]).alias("eligible"), (F.size(x["chain"]) > 0).alias("has_chain")
    )
    t = F.transform(F.coalesce("turns", F.array().cast(s.tables["adapted"].schema["turns"].dataType)), turn)
    shown = F.when(F.col("mode") == "last_only", F.slice(t, -1, 1)).otherwise(t)
    profile = turns.precheck_profile(s.tables["adapted"].select(F.col("session_key").alias("key"), shown.alias("turns")))
    s.stats |= profile.first().asDict() | {"lines": n_bad + n_good, "bad_lines": n_bad}
    counted = profile.withColumns({"lines": F.lit(n_bad + n_good), "bad_lines": F.lit(n_bad)})
    s.stats["issues"] = [r.asDict() for r in turns.precheck_issues(counted, s.settings.min_chain_coverage, s.settings.max_bad_lines).collect()]
    critical = [r["code"] for r in s.stats["issues"] if r["severity"] == "critical"]
    if s.settings.precheck and critical:
        raise ValueError("; ".join(critical))


@register("preclean")
def preclean(s: State) -> None:
    """The first record of each key; of these, sessions without a context are left out, and those that can't be adapted are rejected."""
    read(s)
    every = s.tables["adapted"]
    first = cut(turns.keep_first(every, F.col("session_key"), F.col("row_ord")))
    s.stats |= {"input_duplicates": every.count() - first.count(), "input_empty_sessions": first.where(F.col("reject") == dialects.EMPTY).count()}
    failed = first.where(F.col("reject") != dialects.EMPTY).select("row_ord", F.col("reject").alias("detail"))
    records = s.tables["records"]
    s.keep("adapt_failed", failed.join(records, "row_ord").select(F.lit("adapt_failed").alias("reason"), "detail", "file", "line_number", F.col("json").alias("record")))
    sessions = s.keep("sessions", first.where("reject is null").drop("reject"))
    s.stats |= {"total_sessions": sessions.count(), "input_bad_lines": s.tables["rejects"].count() + s.tables["adapt_failed"].count()}


@register("segment")
def segment(s: State) -> None:
    """Spans of each session by topic; one span where there is one turn, one candidate or no valid label."""
    sessions = s.tables["sessions"].withColumn("session", F.col("row_ord"))
    whole = F.array(F.struct(F.lit(0).alias("start"), (F.size("turns") - 1).alias("end"), F.lit(WHOLE).alias("topic")))
    spans = sessions.select("session", whole.alias("whole")).where("size(whole) > 0 and whole[0].end >= 0")
    if s.settings.segmentation and s.can_ask("segment"):
        each = dialects.turns_of(s.tables["sessions"].where(F.col("mode") == "all")).withColumnRenamed("row_ord", "session")
        said = s.labelled("segment", turns.segment_payload(each))
        spans = spans.join(said.select("session", turns.repaired_segments(F.col("segment.segments"), F.col("n")).alias("cut")), "session", "left")
        spans = spans.select("session", F.coalesce("cut", "whole").alias("whole"))
    out = spans.select("session", F.posexplode("whole").alias("seg_idx", "x")).select("session", "seg_idx", "x.*")
    s.stats["segments"] = s.keep("segments", out).count()


@register("rule_gate")
def rule_gate(s: State) -> None:
    """Turns that pass the gates, with the span that holds them and what came before."""
    sessions = s.tables["sessions"]
    t = sessions.select(F.col("row_ord").alias("session"), "session_key", "mode", F.size("turns").alias("n_turns"), F.posexplode("turns").alias("idx", "t"))
    t = t.select("session", "session_key", "mode", "n_turns", "idx", "t.*")
    gate = s.settings.gate.for_dialect(s.stats["input_format"])
    reason = rules.reject_reason(text.normalize_question(F.col("question")))
    t = t.withColumns({"reject": reason, "called": gates.chain_tools(F.col("chain"), F.col("tool_names"))})
    calls, steps = gates.chain_calls(F.col("chain"), F.col("tool_count")), gates.chain_steps(F.col("chain"), F.col("tool_count"))
    ok = gates.passes(gate, rules.eligible(F.col("question"), F.col("answer"), F.col("status"), F.col("outcome")), F.col("reject"), calls, steps, F.size("called"))
    last = (F.col("mode") != "last_only") | (F.col("idx") == F.col("n_turns") - 1)
    passed = t.where(last & ok).drop("reject", "n_turns")
    spans = s.tables["segments"] if "segments" in s.tables else s.spark.createDataFrame([], "session long, start int, end int, topic string")
    said = sessions.select(F.col("row_ord").alias("session"), F.transform("turns", lambda x: F.struct(x["question"].alias("question"), x["answer"].alias("answer"))).alias("said"))
    passed = turns.with_prior(turns.with_segments(passed, spans.select("session", "start", "end", "topic")), said)
    s.stats["candidates"] = s.keep("candidates", passed).count()


def _category(rows: DataFrame, half: str, label: str) -> DataFrame:
    """rows with difficulty_level, category_id, category and why, by a classification."""
    known = quality.taxonomy(rows.sparkSession).where(F.col("difficulty") == half).select("category_id", F.col("path").alias("category"))
    why = F.when(~rules.blank(F.col(f"{label}.reason")), F.col(f"{label}.reason"))
    out = rows.withColumns({"difficulty_level": F.lit(half), "category_id": F.col(f"{label}.category_id"), "why": why})
    return out.join(F.broadcast(known), "category_id", "left")


@register("judge")
def judge(s: State) -> None:
    """Value, then complexity of what has value, then a category of its half; a candidate without a valid label is dropped as failed."""
    c = s.tables["candidates"]
    now = F.to_json(F.struct(F.col("question").alias("current_question")))
    c = cut(s.labelled("value", c.withColumn("payload", now)))
    v = F.col("value")
    worth = rules.value_admissible(v["is_valuable"], v["has_executable_task"], v["self_contained"], v["template_severity"], v["contains_embedded_prompt"])
    kind = rules.value_rejection(v["has_executable_task"], v["self_contained"], v["template_severity"], v["contains_embedded_prompt"])
    c = c.withColumn("outcome", F.when(v.isNull(), "llm_failed").when(~worth, F.concat(F.lit("value_rejected_"), kind)))
    x = cut(s.labelled("complexity", c.where("outcome is null")))
    route = F.col("complexity.route")
    x = x.withColumn("outcome", F.when(route.isNull(), "llm_failed").when(route == "reject", "complexity_rejected"))
    left = x.where("outcome is null")
    hard = s.labelled("classify_complex", left.where(route == "complex"), "classify")
    normal = left.where(route != "complex").withColumn("payload", turns.judge_payload(F.col("prior"), F.col("question")))
    sorted_ = _category(hard, "hard", "classify").unionByName(_category(s.labelled("classify_normal", normal, "classify"), "normal", "classify"))
    sorted_ = cut(sorted_.withColumn("outcome", F.when(F.col("category").isNull(), "llm_failed").otherwise(F.col("difficulty_level"))))
    every = c.where("outcome is not null").unionByName(x.where("outcome is not null"), True).unionByName(sorted_, True)
    judged = s.keep("judged", every.drop("payload"))

    found = histogram(judged, F.col("outcome"))
    for kind in ("no_task", "not_self_contained", "template", "other"):
        s.stats[f"value_rejected_{kind}"] = found.get(f"value_rejected_{kind}", 0)
    s.stats["value_rejected"] = sum(n for k, n in found.items() if k.startswith("value_rejected"))
    s.stats |= {k: found.get(k, 0) for k in ("llm_failed", "complexity_rejected")} | {"complex_rows": found.get("hard", 0), "normal_rows": found.get("normal", 0)}
    s.stats["empty_sessions"] = s.tables["sessions"].where(F.size("turns") == 0).count()
    kept = judged.where(F.col("outcome").isin("hard", "normal"))
    s.stats["category_counts"] = histogram(kept.where("outcome = 'hard'"), F.col("category_id"))
    s.stats["category_counts_normal"] = histogram(kept.where("outcome = 'normal'"), F.col("category_id"))
    s.stats["complex_feature_counts_initial"] = histogram(kept.select(F.explode("complexity.complex_features").alias("f")), F.col("f"))
    s.keep("rows", _assembled(kept))


def _assembled(judged: DataFrame) -> DataFrame:
    """Rows of the deliverable, numbered in the order of the input."""
    j = labels.numbered(judged, "session", "idx")
    no_text, none = F.lit(""), F.lit(None).cast("string")
    x = F.col("complexity")
    profile = F.struct(
        *[x[n].alias(n) for n in ("route", "complex_features", "exclusion_reasons", "evidence", "confidence", "question_quality", "semantic_signature", "reason")],
        F.lit(None).cast("boolean").alias("verified_hard"), none.alias("verify_reason"), none.alias("normal_classification_reason"),
    )
    meta = F.struct(
        F.coalesce("why", "complexity.reason").alias("reason"), "request_time", "run_id", "last_event_type", profile.alias("complexity_profile"),
        x["semantic_signature"].alias("semantic_signature"), F.col("value").alias("value_profile"),
        F.col("value.contains_embedded_prompt").alias("contains_embedded_prompt"), none.alias("verify_reason"),
        none.alias("normal_classification_reason"), F.lit(None).cast("boolean").alias("translate_failed"),
    )
    filled = lambda a, b: F.when(F.col(a) != "", F.col(a)).otherwise(F.col(b))
    return j.select(
        "row_ord", F.when(F.size("chain") > 0, "full_link").otherwise("end2end").alias("capture_mode"), F.lit("regular").alias("user_cohort"),
        F.col("session_key").alias("source_case_id"), no_text.alias("answer_key"), "trace_id", "category",
        F.struct(F.col("question").alias("text"), no_text.alias("image"), no_text.alias("file")).alias("input"), F.col("prior").alias("context"),
        "chain", F.col("called").alias("tools"), filled("answer_full", "answer").alias("raw_answer"), filled("answer", "answer_full").alias("text_answer"),
        F.array().cast("array<string>").alias("multimodal"), *[no_text.alias(n) for n in ("model_version", "release_id", "agent_mode")],
        none.alias("translation"), "user_id", "difficulty_level", F.col("first_token_ms").alias("first_token_time_ms"),
        F.col("total_duration_ms").alias("finish_answer_time_ms"), "input_tokens", "output_tokens",
        text.epoch_millis(F.col("request_time")).alias("request_time_ms"), meta.alias("meta"),
    )


def ranked(rows: DataFrame) -> DataFrame:
    """(row_ord, text, trace_id, source_case_id, signature, rank, protected) of rows of the deliverable, for merging."""
    m = lambda name: F.col(f"meta.{name}")
    signature = F.coalesce(m("semantic_signature"), m("complexity_profile.semantic_signature"))
    scalars = [F.when(F.coalesce(signature[n], F.lit("")) != "", 1).otherwise(0) for n in ("goal", "subject_type", "temporal_shape")]
    lists = [F.when(F.coalesce(F.size(signature[n]), F.lit(0)) > 0, 1).otherwise(0) for n in ("operations", "data_dimensions", "output_shape")]
    severity = F.when(m("value_profile").isNull(), "none").otherwise(m("value_profile.template_severity"))
    embedded = F.coalesce(m("contains_embedded_prompt"), F.lit(False))
    rank = families.quality_rank(m("complexity_profile.question_quality"), severity, embedded, sum(scalars + lists, F.lit(0)), F.col("row_ord"))
    return rows.select("row_ord", F.col("input.text").alias("text"), "trace_id", "source_case_id", signature.alias("signature"), rank.alias("rank"))


def _drop_log(gone: DataFrame, every: DataFrame, *columns: Column) -> DataFrame:
    """What is told of dropped rows (row_ord, representative, ...): who they were and whom they repeat."""
    who = every.select("row_ord", "source_case_id", "trace_id", F.left("text", F.lit(200)).alias("text"))
    of = every.select(F.col("row_ord").alias("representative"), F.col("trace_id").alias("dedup_of_trace_id"))
    repeated = F.coalesce("dedup_of_trace_id", F.lit("")).alias("dedup_of_trace_id")
    return gone.join(who, "row_ord").join(of, "representative", "left").select("row_ord", "source_case_id", "trace_id", "text", repeated, *columns)


def _none(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def family_review(s: State, rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows that stay, actions (row_ord, action, representative), log of the dropped) after a review of rows that share phrases."""
    every = cut(ranked(rows))
    found, members = families.phrase_families(every.select("row_ord", "text"))
    found, members = cut(found), cut(members)
    asked = families.family_payloads(found, members, every)
    verdicts = cut(found.join(s.labelled("template_family", asked).select("family", "template_family.*"), "family"))
    actions = cut(families.family_actions(verdicts, members, every.select("row_ord", "rank")))
    gone = actions.where(F.col("action").isin("eval_template", "semantic_duplicate"))
    decision = F.when(F.col("action") == "eval_template", "eval_template_family").otherwise(F.col("action"))
    log = cut(_drop_log(gone, every, F.lit("template_family_llm").alias("method"), decision.alias("decision"), _none("reason"), F.lit(None).cast("double").alias("similarity")))
    n = histogram(actions, F.col("action"))
    s.stats |= {
        "template_family_candidates": found.count(), "template_family_failed": verdicts.where("label is null").count(),
        "template_family_rejected": verdicts.where("label = 'eval_template_family' and confidence <> 'low'").count(),
        "template_family_rejected_rows": n.get("eval_template", 0), "template_family_duplicates": n.get("semantic_duplicate", 0),
    }
    return rows.join(gone.select("row_ord"), "row_ord", "left_anti"), actions, log


def semantic_dedup(s: State, rows: DataFrame, protected: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, log of the dropped): equal texts; rows without a signature by their words; the others by judged pairs.

    A row goes only if it was itself judged to repeat the row that stays in its place. Failed pairs keep both.
    """
    every = cut(ranked(rows))
    same = dedup.exact_text_groups(every).withColumnRenamed("representative", "head")
    groups = cut(same.join(every.select("row_ord", "rank"), "row_ord"))
    best = cut(groups.groupBy("head").agg(F.min_by("row_ord", F.struct("rank", "row_ord")).alias("representative")))
    equal = groups.join(best, "head").where("row_ord <> representative").select("row_ord", "representative")
    logs = [_drop_log(equal, every, F.lit("exact_text").alias("method"), F.lit("exact_semantic").alias("decision"), F.lit("equal normal texts").alias("reason"), F.lit(1.0).alias("similarity"))]
    kept = cut(every.join(equal.select("row_ord"), "row_ord", "left_anti"))
    safe = s.spark.createDataFrame([], "row_ord long") if protected is None else protected.select("row_ord").distinct()

    unsigned = kept.where("signature is null").join(safe, "row_ord", "left_anti").select("row_ord", "text")
    words = cut(dedup.lexical_clusters(unsigned, s.settings.threshold)).where("not kept")
    method = F.concat(F.lit("lexical_fallback:"), F.col("method")).alias("method")
    logs.append(_drop_log(words, every, method, _none("decision"), _none("reason"), "similarity"))

    signed = cut(kept.where("signature is not null").withColumn("tokens", families.signature_tokens(F.col("signature"))))
    pairs = families.signature_candidates(signed, threshold=s.settings.candidate_threshold, most=s.settings.max_candidates)
    both = safe.select(F.col("row_ord").alias("a"), F.lit(True).alias("pa"))
    pairs = pairs.join(both, "a", "left").join(both.select(F.col("a").alias("b"), F.col("pa").alias("pb")), "b", "left")
    pairs = cut(pairs.where("pa is null or pb is null").select("a", "b", "similarity"))
    side = lambda k: signed.select(F.col("row_ord").alias(k), F.struct(F.col("text").alias("question"), F.col("signature").alias("semantic_signature")).alias(f"of {k}"))
    payload = F.to_json(F.struct(F.col("of a").alias("left"), F.col("of b").alias("right"), F.round("similarity", 6).alias("candidate_similarity")))
    asked = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "similarity", payload.alias("payload"))
    verdicts = cut(s.labelled("dedup_pair", asked).select("a", "b", "similarity", "dedup_pair.label", "dedup_pair.reason"))
    alike = verdicts.where("label is not null and label <> 'distinct'")
    flagged = signed.join(safe.withColumn("protected", F.lit(True)), "row_ord", "left").select("row_ord", "rank", F.coalesce("protected", F.lit(False)).alias("protected"))
    stars = cut(families.star_clusters(flagged, alike).where("row_ord <> representative"))
    of = stars.withColumns({"a": F.least("row_ord", "representative"), "b": F.greatest("row_ord", "representative")}).join(alike, ["a", "b"])
    logs.append(_drop_log(of, every, F.lit("semantic_signature_llm").alias("method"), F.col("label").alias("decision"), "reason", "similarity"))

    log = cut(logs[0].union(logs[1]).union(logs[2]))
    s.stats |= {
        "semantic_dedup_candidates": pairs.count(), "semantic_dedup_failed": verdicts.where("label is null").count(),
        "semantic_dedup_removed": log.where(F.col("method").isin("exact_text", "semantic_signature_llm")).count(),
    }
    return rows.join(log.select("row_ord"), "row_ord", "left_anti"), log


def _reclassified(s: State, rows: DataFrame) -> DataFrame:
    """rows with the struct classify of the normal half; null where that failed."""
    payload = turns.judge_payload(F.col("context"), F.col("input.text"))
    return s.labelled("classify_normal_after_verify", rows.withColumn("payload", payload), "classify").drop("payload")


@register("verify")
def verify(s: State) -> None:
    """Reviews families and merges rows that mean the same, then judges hard rows again by their question alone.

    A hard row stays hard if every round admits it. The first that does not decides: a rejected row goes, another
    is sorted anew among the normal ones, a failed one goes and is counted. Rows of doubtful families become normal unasked.
    """
    rows, spark = s.tables["rows"], s.spark
    logs, force = [], spark.createDataFrame([], "row_ord long")
    if s.settings.labellers and s.settings.post and s.settings.dedup_enabled and s.settings.dedup_mode == "semantic":
        protected = None
        if s.settings.family_review:
            rows, actions, log = family_review(s, rows)
            logs.append(log)
            force = cut(actions.where("action = 'force_normal'").select("row_ord"))
            protected = actions.where(F.col("action").isin("force_normal", "protect")).select("row_ord")
        rows, log = semantic_dedup(s, rows, protected)
        logs.append(log)
        s.stats["dedup_removed"] = sum(x.count() for x in logs)
        s.stats["duplicate_removed"] = s.stats.get("template_family_duplicates", 0) + log.count()
        s.stats["verify_corpus_review_done"] = True
    if logs:
        s.keep("deduped", logs[0] if len(logs) == 1 else logs[0].unionByName(logs[1]))
    rows = cut(rows)
    if not s.can_ask("verify"):
        s.keep("verified", rows)
        return

    open_ = rows.where("difficulty_level = 'hard'").join(force, "row_ord", "left_anti").select("row_ord", F.col("input.text").alias("question"))
    votes = None
    for k in range(1, s.settings.verify_rounds + 1):
        asked = open_.withColumn("payload", F.to_json(F.struct("question")))
        said = cut(s.labelled("verify" if k == 1 else "verify_again", asked, "critic", "" if k == 1 else f"_{k}").drop("payload"))
        vote = F.when(F.col("critic").isNull(), "error").when(F.col("critic.route") == "complex", "admit").when(F.col("critic.route") == "reject", "reject").otherwise("downgrade")
        said = cut(said.select("row_ord", "question", F.lit(k).alias("round"), vote.alias("vote"), "critic"))
        votes = said if votes is None else votes.union(said)
        open_ = said.where("vote = 'admit'").select("row_ord", "question")
    forced = force.withColumn("action", F.lit("downgrade")).withColumn("uncertain", F.lit(True))
    if votes is None:
        decided = forced.withColumn("critic", F.lit(None).cast(CRITIC))
    else:
        last = F.max_by(F.struct("vote", "critic"), "round").alias("last")
        in_order = F.transform(F.array_sort(F.collect_list(F.struct("round", "vote"))), lambda x: x["vote"])
        fold = votes.groupBy("row_ord").agg(labels.verify_outcome(in_order).alias("action"), last)
        doubt = (F.col("action") == "downgrade") & F.coalesce(F.col("last.critic.confidence") == "low", F.lit(False))
        decided = fold.select("row_ord", "action", doubt.alias("uncertain"), F.col("last.critic").alias("critic")).unionByName(forced, True)
    every = cut(rows.join(decided, "row_ord", "left"))
    down = cut(_reclassified(s, every.where("action = 'downgrade'")))
    s.keep("verified", _verified(every, down))
    _count_verified(s, every, down)


def _new_profile(critic: Column, **values: Column) -> Column:
    """meta with its complexity profile as the last critic sees it, and other fields replaced."""
    old = F.col("meta.complexity_profile")
    for name in ("route", "complex_features", "exclusion_reasons", "evidence", "confidence"):
        value = values.pop("route") if name == "route" else F.coalesce(critic[name], old[name])
        old = old.withField(name, value)
    for name in ("verified_hard", "verify_reason", "normal_classification_reason"):
        if name in values:
            old = old.withField(name, values[name])
    out = F.col("meta").withField("complexity_profile", old)
    for name in ("reason", "verify_reason", "normal_classification_reason"):
        if name in values:
            out = out.withField(name, values[name])
    return out


def _verified(every: DataFrame, down: DataFrame) -> DataFrame:
    """The rows that stay: normal ones as they are, admitted ones, and downgraded ones with a category of the normal half."""
    columns = [c for c in every.columns if c not in ("action", "uncertain", "critic")]
    plain = every.where("action is null").select(columns)
    critic = F.col("critic")
    kept = every.where("action = 'keep'").withColumn("meta", _new_profile(critic, route=F.lit("complex"), verified_hard=F.lit(True), verify_reason=critic["reason"]))
    known = F.broadcast(quality.taxonomy(every.sparkSession).where("difficulty = 'normal'").select("category_id", "path"))
    sure = down.withColumn("category_id", F.col("classify.category_id")).join(known, "category_id")
    why = F.coalesce(critic["reason"], F.lit("not confirmed as complex"))
    final = F.when(~rules.blank(F.col("classify.reason")), F.col("classify.reason")).otherwise(why)
    meta = _new_profile(critic, route=F.lit("normal"), verified_hard=F.lit(False), verify_reason=why, normal_classification_reason=final, reason=final)
    sure = sure.withColumns({"meta": meta, "difficulty_level": F.lit("normal"), "category": F.col("path")})
    return plain.unionByName(kept.select(columns)).unionByName(sure.select(columns))


def _count_verified(s: State, every: DataFrame, down: DataFrame) -> None:
    n = histogram(every, F.col("action"))
    failed = down.where("classify is null").count()
    s.stats |= {
        "verify_complex_kept": n.get("keep", 0), "verify_to_normal": n.get("downgrade", 0) - failed, "verify_rejected_template": n.get("reject", 0),
        "verify_failed": n.get("failed", 0) + failed, "verify_uncertain": down.where("uncertain and classify is not null").count(),
    }
    told = every.where("action is not null").select(
        "row_ord", "source_case_id", "trace_id", F.col("difficulty_level").alias("difficulty"), "category", F.left("input.text", F.lit(200)).alias("question"), "action",
        F.col("critic.route").alias("route"), F.col("critic.reason").alias("reason"),
    )
    s.keep("verdicts", told)


@register("answer_gate")
def answer_gate(s: State) -> None:
    reason = rules.answer_reason(F.col("input.text"), F.col("text_answer"), F.col("meta.last_event_type"))
    rows = cut(s.tables["verified"].withColumn("gate", reason))
    gone = rows.where("gate is not null")
    told = [F.left(c, F.lit(200)).alias(n) for c, n in (("input.text", "question"), ("text_answer", "answer"))]
    s.keep("answer_gate_rejected", gone.select("row_ord", "trace_id", "source_case_id", F.col("difficulty_level").alias("difficulty"), "category", *told, F.col("gate").alias("reason")))
    top = gone.groupBy(F.substring_index("gate", "(", 1).alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(8).collect()
    s.stats |= {"answer_rejects": {r["reason"]: r["n"] for r in top}, "answer_gate_rejected": gone.count()}
    s.keep("answered", rows.where("gate is null").drop("gate"))


@register("post")
def post(s: State) -> None:
    """Rows that repeat others go, unless that was done before; the others are translated where they need it.

    After a failure of an earlier step rows are neither merged nor translated.
    """
    rows = s.tables["answered"]
    if any(s.stats.get(f) for f in FAILURES) or not s.settings.post:
        s.keep("final", rows)
        return
    if s.settings.dedup_enabled and not s.stats.get("verify_corpus_review_done"):
        if s.settings.dedup_mode == "semantic" and s.settings.labellers:
            rows, log = semantic_dedup(s, rows)
        else:
            every = cut(ranked(rows))
            gone = cut(dedup.lexical_clusters(every.select("row_ord", "text"), s.settings.threshold)).where("not kept")
            log = cut(_drop_log(gone, every, "method", _none("decision"), _none("reason"), "similarity"))
            rows = rows.join(log.select("row_ord"), "row_ord", "left_anti")
        s.stats["dedup_removed"] = log.count()
        s.keep("deduped", log)
    if s.settings.translate and s.can_ask("translate"):
        need = rules.needs_translation(F.col("input.text"))
        asked = cut(rows.withColumn("payload", F.when(need, F.to_json(F.struct(F.col("input.text").alias("text"))))))
        some = cut(s.labelled("translate", asked.where("payload is not null")))
        new = F.col("translate.translation")
        lacks = new.isNull() & rules.blank(F.col("translation"))  # an earlier translation stays
        meta = F.col("meta").withField("translate_failed", F.when(lacks, True).otherwise(F.col("meta.translate_failed")))
        done = some.withColumns({"meta": meta, "translation": F.coalesce(new, F.when(~rules.blank(F.col("translation")), F.col("translation")))})
        failed = some.where("translate is null").count()
        s.stats |= {"translate_failed": failed, "translated": some.count() - failed, "translate_skipped": asked.where("payload is null").count()}
        rows = done.drop("translate", "payload").unionByName(asked.where("payload is null").drop("payload").withColumn("translation", F.lit(None).cast("string")))
    s.keep("final", rows)


def final_counts(rows: DataFrame) -> dict[str, object]:
    """What the summary says of the rows that are published."""
    level = histogram(rows, F.col("difficulty_level"))
    features = rows.select(F.explode("meta.complexity_profile.complex_features").alias("f"))
    hard = F.col("difficulty_level") == "hard"
    return {
        "final_complex_rows": level.get("hard", 0), "final_normal_rows": level.get("normal", 0), "output_rows": sum(level.values()),
        "complex_feature_counts_final": histogram(features, F.col("f")), "category_counts_final": histogram(rows.where(hard), F.col("category")),
        "category_counts_normal_final": histogram(rows.where(~hard), F.col("category")),
    }
