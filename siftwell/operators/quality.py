"""Quality control: rules on records, rules on the dataset, sampling, gold sets and the release gate."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions.rules import LIMITS, blank, refusal, stripped, truncated
from siftwell.functions.text import cjk_ratio, text_or_empty

# Limits of the dataset rules and of the release gate, and the taxonomy.
QUESTION_MIN, QUESTION_MAX = 5, 2000
EMPTY_RATE, SKEW, NEAR_CONSTANT, RESIDUAL, FALSE_ACCEPT = 0.10, 0.50, 0.90, 0.02, 0.02
COMPLEX_PREFIX = "complex-topic/"
COMPLEX = (
    ("01", "complex-topic/01-data-metrics-calculation"), ("02", "complex-topic/02-forecasting-and-projection"), ("03", "complex-topic/03-analysis-research"),
    ("04", "complex-topic/04-opportunity-discovery"), ("05", "complex-topic/05-asset-allocation"), ("06", "complex-topic/06-investment-decision"),
    ("07", "complex-topic/07-strategy-evaluation"), ("08", "complex-topic/08-goal-execution"), ("09", "complex-topic/09-action-output"),
)
NORMAL = tuple(
    (x[:2], x)
    for x in (
        "01-event-and-concept-stock-selection", "02-backtesting-data-extraction-and-calculation", "03-stock-diagnosis-and-data-lookup", "04-analysis-evaluation-and-self-judgment",
        "05-kyc-recommendation-suggestions", "06-compound-intent", "07-interactive-clarification", "08-information-and-knowledge-qa",
        "09-financial-performance-interpretation", "10-financial-common-sense-and-semantic-understanding", "11-instruction-following-ability", "12-financial-logical-reasoning",
        "13-time-awareness-ability", "14-complex-stock-selection", "15-stock-comprehensive-analysis-and-selection", "16-macro-information-qa",
    )
)


def taxonomy(spark) -> DataFrame:
    """(difficulty, category_id, path): a fixed table of 25 rows, small enough for any broadcast."""
    rows = [("hard", i, p) for i, p in COMPLEX] + [("normal", i, p) for i, p in NORMAL]
    return spark.createDataFrame(rows, "difficulty string, category_id string, path string")


def chain_fault(chain: Column) -> Column:
    """Whether a chain is missing or a step lacks its plan or tools, or a tool its name, input or output."""
    tool_ok = lambda t: t.isNotNull() & t["name"].isNotNull() & (t["name"] != "") & t["input"].isNotNull() & t["output"].isNotNull()
    step_ok = lambda s: s.isNotNull() & s["plan"].isNotNull() & s["tools"].isNotNull() & F.forall(s["tools"], tool_ok)
    return F.coalesce(~((F.size(chain) > 0) & F.forall(chain, step_ok)), F.lit(True))


def record_rules(c: dict[str, Column]) -> dict[str, Column]:
    """Whether a record passes each rule, by name. c has the columns a rule needs; rules without theirs are left out."""
    get = c.get
    out: dict[str, Column] = {}
    q, a = get("question"), get("answer")
    if q is not None:
        n = F.length(stripped(q))
        out["question"] = ~blank(q) & n.between(QUESTION_MIN, QUESTION_MAX) & ~F.contains(text_or_empty(q), F.lit("�"))
    if get("category") is not None:
        paths = [p for _, p in (*COMPLEX, *NORMAL)]
        out["category"] = F.coalesce(F.when(c["category"] == "other", c["difficulty"] == "normal").otherwise(c["category"].isin(*paths)), F.lit(False))
    if get("chain") is not None:
        out["chain"] = F.when(c["capture_mode"] == "end2end", F.coalesce(F.size(c["tools"]) > 0, F.lit(False))).otherwise(~chain_fault(c["chain"]))
    if a is not None:
        out["answer"] = ~blank(a) & (F.length(stripped(a)) >= LIMITS.answer_min)
        out["refusal"] = ~blank(a) & ~refusal(a)
        if q is not None:
            out["truncation"] = ~truncated(a, q)
    if get("event") is not None:
        out["event_type"] = c["event"].isNull() | (c["event"] == LIMITS.finished)
    if get("first_ms") is not None:
        late = F.coalesce(c["first_ms"] > c["finish_ms"], F.lit(False))
        negative = F.coalesce(c["input_tokens"] < 0, F.lit(False)) | F.coalesce(c["output_tokens"] < 0, F.lit(False))
        out["timing"] = ~late & ~negative
    if get("reason") is not None and q is not None:
        translated = ~blank(c["translation"])
        out["meta"] = ~blank(c["reason"]) & F.when(cjk_ratio(q) >= LIMITS.cjk_ratio, ~translated).otherwise(translated | F.coalesce(c["translate_failed"], F.lit(False)))
    return out


#: What a failed rule means.
DETAILS = {
    "structure": "a field has another type than the record format", "question": "the question is missing, too short, too long or broken",
    "category": "the category is not of the taxonomy, or not of this difficulty", "chain": "the chain is missing or has incomplete steps",
    "answer": "the answer is missing or too short", "refusal": "the answer is missing or refuses", "truncation": "the answer breaks off",
    "event_type": "the run did not finish", "timing": "the times or token counts can't be", "meta": "the reason is missing, or the translation does not fit the language",
}


def packed_rules(rules: dict[str, Column]) -> Column:
    """The rules as an array of (rule, ok, detail)."""
    detail = lambda k, ok: F.when(ok, "ok").otherwise(DETAILS.get(k, k))
    return F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("ok"), detail(k, v).alias("detail")) for k, v in rules.items()])


# The record format, by the kinds of values that its fields hold.
TEXTS = (
    "capture_mode", "user_cohort", "source_case_id", "answer_key", "trace_id", "category", "raw_answer", "text_answer", "model_version", "release_id",
    "agent_mode", "user_id", "difficulty_level",
)
NUMBERS = ("first_token_time_ms", "finish_answer_time_ms", "input_tokens", "output_tokens", "request_time_ms")
LISTS, OBJECTS, OPTIONAL_TEXTS = ("context", "chain", "tools", "multimodal"), ("input", "meta"), ("translation",)
FIELDS = (*TEXTS, *NUMBERS, *LISTS, *OBJECTS, *OPTIONAL_TEXTS)
STEP = "struct<plan:string,tools:array<struct<name:string,input:string,output:string>>>"
RECORD = (
    "capture_mode string, source_case_id string, trace_id string, category string, input struct<text:string>, tools array<string>, "
    f"chain array<{STEP}>, raw_answer string, text_answer string, translation string, difficulty_level string, first_token_time_ms double, "
    "finish_answer_time_ms double, input_tokens double, output_tokens double, meta struct<reason:string,last_event_type:string,"
    "translate_failed:boolean,semantic_signature:string,complexity_profile:string>"
)
CONTENT_FIELDS = ("text_answer", "raw_answer", "input.text", "category", "tools", "meta.reason")
KEY_FIELDS = ("trace_id", "source_case_id", "category", "input.text", "text_answer", "meta.reason")
NEAR_DUPLICATE = 0.85


def structure_ok(record: Column) -> Column:
    """Whether a JSON object's fields, where present, hold what the record format says."""
    v = F.try_parse_json(record)
    kind = lambda path: F.schema_of_variant(F.try_variant_get(v, path, "variant"))
    holds = lambda name, pattern: F.coalesce(kind(f"$.{name}").rlike(pattern), F.lit(True))
    number = r"\A(?:VOID|BIGINT|DOUBLE|FLOAT|DECIMAL.*)\z"
    each = [holds(n, r"\ASTRING\z") for n in (*TEXTS, "input.text", "input.image", "input.file", "meta.request_time", "meta.run_id")]
    each += [holds(n, number) for n in NUMBERS] + [holds(n, r"\AARRAY<") for n in LISTS] + [holds(n, r"\AOBJECT<") for n in OBJECTS]
    each += [holds(n, r"\A(?:STRING|VOID)\z") for n in (*OPTIONAL_TEXTS, "meta.reason", "meta.last_event_type")]
    each += [holds("tools", r"\AARRAY<(?:STRING|VOID)>\z"), holds("context", r"\AARRAY<(?:OBJECT<.*>|VOID)>\z")]
    out = v.isNotNull()
    for ok in each:
        out = out & ok
    return out


def typed(records: DataFrame) -> DataFrame:
    """records (row_ord, line_number, json) as columns of the record format, with signature (canonical), key and rules."""
    r = records.withColumn("r", F.from_json("json", RECORD)).select("row_ord", "line_number", "json", "r.*")
    signature = F.get_json_object("json", "$.meta.semantic_signature")
    columns = {
        "question": F.col("input.text"), "category": F.col("category"), "difficulty": F.col("difficulty_level"), "chain": F.col("chain"),
        "capture_mode": F.col("capture_mode"), "tools": F.col("tools"), "answer": F.coalesce(F.nullif("text_answer", F.lit("")), "raw_answer"),
        "event": F.col("meta.last_event_type"), "first_ms": F.col("first_token_time_ms"), "finish_ms": F.col("finish_answer_time_ms"),
        "input_tokens": F.col("input_tokens"), "output_tokens": F.col("output_tokens"), "reason": F.col("meta.reason"),
        "translation": F.col("translation"), "translate_failed": F.col("meta.translate_failed"),
    }
    rules = {"structure": structure_ok(F.col("json")), **record_rules(columns)}
    canonical = F.when(signature.startswith("{"), F.to_json(F.from_json(signature, _SIGNATURE)))
    key = record_key(F.col("source_case_id"), F.col("trace_id"), F.col("line_number"))
    return r.withColumns({"rules": packed_rules(rules), "signature": canonical, "key": key})


_SIGNATURE = "data_dimensions array<string>, goal string, operations array<string>, output_shape array<string>, subject_type string, temporal_shape string"


def field_value(record: Column, dotted: str) -> Column:
    """A field of a JSON object by its dotted path, as text; lists and objects as compact JSON, null where there is none."""
    return F.get_json_object(record, f"$.{dotted}")


def near_duplicate_rate(rows: DataFrame, threshold: float = NEAR_DUPLICATE) -> DataFrame:
    """(row_ord, representative, similarity) of rows (row_ord, text) that repeat another by their words."""
    from siftwell.operators.dedup import lexical_clusters

    return lexical_clusters(rows.select("row_ord", "text"), threshold).where("not kept").select("row_ord", "representative", "similarity")


def _constant(rows: DataFrame) -> tuple[bool, str, list[str]]:
    flat = rows.select(*[field_value(F.col("json"), f).alias(f.replace(".", "_")) for f in CONTENT_FIELDS])
    bad = [r for r in constant_fields(flat, flat.columns).collect() if not r["ok"]]
    told = [f"{r['field']}: {r['distinct_values']} values, the first in {r['top_share']:.0%}" for r in sorted(bad, key=lambda r: r["field"])]
    return not told, "; ".join(told) or "ok", told


def _near_duplicates(rows: DataFrame) -> tuple[bool, str, list[str]]:
    found = near_duplicate_rate(rows.select("row_ord", F.col("input.text").alias("text")))
    n = found.count()
    who = rows.select("row_ord", F.coalesce("trace_id", F.lit("")).alias("trace_id"))
    shown = found.join(who, "row_ord").join(who.toDF("representative", "of"), "representative").orderBy("row_ord").limit(20).collect() if n else []
    return n == 0, f"{n} rows repeat another", [f"{r['trace_id']} repeats {r['of']}: {r['similarity']:.3f}" for r in shown]


def _signatures(rows: DataFrame) -> tuple[bool, str, list[str]]:
    found = residual_duplicates(rows, "signature").first()
    who = F.slice(F.array_sort(F.collect_list(F.struct("row_ord", "trace_id"))), 1, 8)
    first = rows.where("signature is not null").groupBy("signature").agg(F.count("*").alias("n"), F.min("row_ord").alias("first")).where("n > 1")
    shown = first.orderBy("first").limit(20).join(rows, "signature").groupBy("first").agg(who.alias("w")).orderBy("first").collect() if found["families"] else []
    told = f"{found['families']} families, {found['redundant']} redundant rows, {found['rate']:.2%}"
    return found["ok"], told, [", ".join(x["trace_id"] or "" for x in r["w"]) for r in shown]


def _lengths(rows: DataFrame) -> tuple[bool, str, list[str]]:
    flat = rows.select(F.col("input.text").alias("question"), F.col("text_answer").alias("answer"))
    found = [length_outliers(flat, "question", QUESTION_MIN, QUESTION_MAX).first(), length_outliers(flat, "answer", LIMITS.answer_min, None).first()]
    told = [f"{r['field']}: {r['too_short']} too short, {r['too_long']} too long" for r in found if r["too_short"] or r["too_long"]]
    return not told, "; ".join(told) or "ok", told


def _skew(rows: DataFrame) -> tuple[bool, str, list[str]]:
    found = category_shares(rows, "category").orderBy(F.desc("n"), "category").collect()
    unused = sorted(r["category_id"] for r in unused_categories(rows, "category").collect())
    told = f"the largest category has {found[0]['share']:.0%}" + (f"; without a row: {', '.join(unused)}" if unused else "")
    return found[0]["share"] <= SKEW, told, [f"{r['category']}: {r['n']}" for r in found]


def _empty(rows: DataFrame) -> tuple[bool, str, list[str]]:
    value = lambda f: field_value(F.col("json"), f)
    flat = rows.select(*[F.when(value(f) != "[]", value(f)).alias(f.replace(".", "_")) for f in KEY_FIELDS])
    told = [f"{r['field']}: {r['empty_rate']:.0%} empty" for r in empty_rates(flat, flat.columns).collect() if not r["ok"]]
    return not told, "; ".join(told) or "ok", told


def _unknown(rows: DataFrame) -> tuple[bool, str, list[str]]:
    found = sorted(r["name"] for r in unknown_fields(rows, "json", FIELDS).collect())
    return True, f"unknown fields: {', '.join(found)}" if found else "ok", found


#: Rules on all rows of typed(); more can be added. Each gives whether it holds, in words, and evidence.
DATASET_RULES = {
    "constant_field": _constant, "near_duplicate": _near_duplicates, "semantic_signature_duplicate": _signatures, "length_outlier": _lengths,
    "category_skew": _skew, "empty_field_rate": _empty, "unknown_fields": _unknown,
}


def run_dataset_rules(rows: DataFrame) -> list[dict]:
    """(rule, ok, detail, evidence) of every dataset rule; without rows all hold."""
    if rows.isEmpty():
        return [{"rule": name, "ok": True, "detail": "no rows", "evidence": []} for name in DATASET_RULES]
    return [dict(zip(("rule", "ok", "detail", "evidence"), (name, *check(rows)), strict=True)) for name, check in DATASET_RULES.items()]


def judge_payload(rows: DataFrame) -> Column:
    """What the quality judge is asked about a row of typed()."""
    names = F.filter(F.flatten(F.transform("chain", lambda s: F.coalesce(F.transform(s["tools"], lambda t: t["name"]), F.array().cast("array<string>")))), lambda x: x.isNotNull())
    return F.to_json(F.struct(
        F.col("input.text").alias("question"), F.col("category").alias("label"), F.col("difficulty_level"),
        F.col("meta.complexity_profile").alias("complexity_profile"), F.size(F.coalesce("chain", F.array().cast(f"array<{STEP}>"))).alias("chain_hops"),
        F.slice(F.array_distinct(F.coalesce(names, F.array().cast("array<string>"))), 1, 10).alias("tools"),
    ))


def build_results(rows: DataFrame, judged: DataFrame) -> DataFrame:
    """(row_ord, id, key, ..., status, sampled, rules, judge) of rows of typed(); judged is (row_ord, verdict) of the sampled ones."""
    kind = "struct<question_quality:string,label_ok:boolean,difficulty_ok:boolean,reason:string>"
    of = rows.join(judged.select("row_ord", F.lit(True).alias("sampled"), F.col("verdict").cast(kind).alias("v")), "row_ord", "left")
    v, sampled = F.col("v"), F.coalesce("sampled", F.lit(False))
    error = F.when(sampled & v.isNull(), "no valid verdict")
    told = F.struct(*[v[n].alias(n) for n in ("question_quality", "label_ok", "difficulty_ok", "reason")], error.alias("error"))
    failed = F.exists("rules", lambda r: ~r["ok"])
    return of.select(
        "row_ord", "key", F.coalesce(F.nullif("trace_id", F.lit("")), "key").alias("id"), F.coalesce("source_case_id", F.lit("")).alias("source_case_id"),
        F.coalesce("category", F.lit("")).alias("category"), F.coalesce("difficulty_level", F.lit("")).alias("difficulty_level"),
        F.left(F.coalesce("input.text", F.lit("")), F.lit(80)).alias("question"),
        status(failed, sampled, v["question_quality"], v["label_ok"], v["difficulty_ok"], error).alias("status"), sampled.alias("sampled"), "rules",
        F.when(sampled, told).alias("judge"),
    )


def sample_counts(results: DataFrame) -> dict:
    """What the judge has said of the sampled rows, counted."""
    j, s = F.col("judge"), F.col("sampled")
    says = lambda c: F.count_if(s & F.coalesce(c, F.lit(False)))
    return results.agg(
        F.count_if(s).alias("count"), says(j["question_quality"] == "high").alias("question_quality_high"), says(j["question_quality"] == "low").alias("question_quality_low"),
        says(j["label_ok"]).alias("label_ok"), says(~j["label_ok"]).alias("label_not_ok"), says(j["difficulty_ok"]).alias("difficulty_ok"),
        says(~j["difficulty_ok"]).alias("difficulty_not_ok"), says(j["error"].isNotNull()).alias("judge_errors"),
    ).first().asDict()


def status(failed: Column, sampled: Column, quality: Column, label_ok: Column, difficulty_ok: Column, error: Column) -> Column:
    """fail by any rule; of sampled rows needs_review by a bad verdict or none; else pass."""
    doubt = (quality == "low") | ~label_ok | ~difficulty_ok | (error.isNotNull() & (error != ""))
    return F.when(failed, "fail").when(sampled & F.coalesce(doubt, F.lit(False)), "needs_review").otherwise("pass")


def constant_fields(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(field, distinct_values, top_share, ok): a field with one value, or one value in NEAR_CONSTANT of the rows, fails."""
    each = rows.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x")).select("x.*")
    counts = each.groupBy("field", "value").agg(F.count("*").alias("n"))
    out = counts.groupBy("field").agg(F.count("*").alias("distinct_values"), (F.max("n") / F.sum("n")).alias("top_share"))
    return out.withColumn("ok", (F.col("distinct_values") > 1) & (F.col("top_share") < NEAR_CONSTANT))


def empty_rates(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(field, empty_rate, ok): null or '' in more than EMPTY_RATE of the rows fails."""
    rates = rows.agg(*[F.avg((F.coalesce(F.col(f).cast("string"), F.lit("")) == "").cast("int")).alias(f) for f in fields])
    out = rates.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("empty_rate")) for f in fields])).alias("x")).select("x.*")
    return out.withColumn("ok", F.col("empty_rate") <= EMPTY_RATE)


def length_outliers(rows: DataFrame, field: str, low: int, high: int | None) -> DataFrame:
    """One row (field, too_short, too_long); missing texts have length 0."""
    n = F.length(text_or_empty(F.col(field)))
    return rows.agg(F.count_if(n < low).alias("too_short"), F.count_if(n > high if high is not None else F.lit(False)).alias("too_long")).select(F.lit(field).alias("field"), "too_short", "too_long")


def category_shares(rows: DataFrame, category: str) -> DataFrame:
    """(category, n, share) of every category."""
    counts = rows.groupBy(F.coalesce(F.col(category).cast("string"), F.lit("")).alias("category")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select("category", "n", (F.col("n") / F.col("total")).alias("share"))


def unused_categories(rows: DataFrame, category: str) -> DataFrame:
    """Ids of the complex half of the taxonomy without a row."""
    used = rows.where(F.col(category).startswith(COMPLEX_PREFIX)).select(F.substring_index(F.substring_index(category, "/", -1), "-", 1).alias("category_id")).distinct()
    return taxonomy(rows.sparkSession).where("difficulty = 'hard'").select("category_id").join(used, "category_id", "left_anti")


def residual_duplicates(rows: DataFrame, signature: str) -> DataFrame:
    """One row (signed, families, redundant, rate, ok) of equal signatures, over all rows."""
    groups = rows.groupBy(signature).agg(F.count("*").alias("n"))
    known = F.col(signature).isNotNull()
    total = lambda n: F.sum(F.when(known, n).otherwise(0))
    out = groups.agg(
        total(F.col("n")).alias("signed"), F.count_if(known & (F.col("n") > 1)).alias("families"), total(F.col("n") - 1).alias("redundant"), F.sum("n").alias("total")
    )
    rate = F.coalesce(F.col("redundant") / F.greatest("total", F.lit(1)), F.lit(0.0))
    return out.select(F.coalesce("signed", F.lit(0)).alias("signed"), "families", F.coalesce("redundant", F.lit(0)).alias("redundant"), rate.alias("rate"), (rate <= RESIDUAL).alias("ok"))


def unknown_fields(records: DataFrame, json_col: str, known: tuple[str, ...]) -> DataFrame:
    """Top-level names of JSON objects that are not known; those that begin with _ are ignored."""
    names = records.select(F.explode(F.json_object_keys(json_col)).alias("name")).distinct()
    return names.where(~F.col("name").isin(*known) & ~F.col("name").startswith("_"))


def sample_indices(n: int, ratio: float, seed: int) -> list[int]:
    """Row numbers of a seeded sample without replacement: at least one, rounded half to even."""
    if ratio <= 0 or not n:
        return []
    return sorted(random.Random(seed).sample(range(n), min(n, max(1, round(n * ratio)))))


def seeded_sample(rows: DataFrame, ratio: float, seed: int) -> DataFrame:
    """rows (row_ord from 0) of the seeded sample. What is drawn are row numbers alone, on the driver."""
    picked = sample_indices(rows.count(), ratio, seed)
    ids = rows.sparkSession.createDataFrame([(i,) for i in picked], "row_ord long")
    return rows.join(ids, "row_ord", "left_semi")


def gold_matches(gold: DataFrame, output: DataFrame) -> DataFrame:
    """gold (id, text, positive) with hard and same: how the last row of output (id, text, hard, row_ord) with its id came out."""
    last = output.where("id is not null and id <> ''").groupBy("id").agg(F.max_by(F.struct("text", "hard"), "row_ord").alias("o"))
    same = F.coalesce(F.col("o.text"), F.lit("")) == F.coalesce(F.col("text"), F.lit(""))
    return gold.join(last, "id", "left").select("id", "positive", F.coalesce("o.hard", F.lit(False)).alias("hard"), same.alias("same"))


def gold_result(gold: DataFrame, output: DataFrame) -> DataFrame:
    """One row of counts for gold against output, see gold_matches.

    A positive must come out hard with the same text; a negative must not come out hard.
    """
    pos, hard, same = F.col("positive"), F.col("hard"), F.col("same")
    out = gold_matches(gold, output).agg(
        F.count_if(pos).alias("positives"), F.count_if(pos & hard & same).alias("accepted"), F.count_if(pos & ~hard).alias("missed"),
        F.count_if(pos & hard & ~same).alias("positive_text_mismatches"), F.count_if(~pos).alias("negatives"),
        F.count_if(~pos & hard).alias("false_accepts"), F.count_if(~pos & hard & ~same).alias("negative_text_mismatches"),
    )
    recall = F.when(F.col("positives") > 0, F.col("accepted") / F.col("positives")).otherwise(1.0)
    return out.withColumn("recall", recall).withColumn("passed", (F.col("recall") == 1.0) & (F.col("false_accepts") == 0))


def gold_report(gold: DataFrame, output: DataFrame, shown: int = 100) -> dict:
    """The counts, and the first ids of each kind of fault."""
    from siftwell.operators.store import cut

    each = cut(gold_matches(gold, output))
    faults = {
        "missed_positive_ids": "positive and not hard", "positive_text_mismatch_ids": "positive and hard and not same",
        "negative_false_accept_ids": "not positive and hard", "negative_text_mismatch_ids": "not positive and hard and not same",
    }
    ids = {k: [r["id"] for r in each.where(f).orderBy("id").limit(shown).collect()] for k, f in faults.items()}
    return gold_result(gold, output).first().asDict() | ids


def release_gate(results: DataFrame, residual_rate: Column, gold_passed: Column) -> DataFrame:
    """One row: results (sampled, hard, difficulty_ok, error) pass with sampled hard rows, few false accepts, no errors, few residual duplicates and a passed gold set."""
    s = F.col("sampled")
    wrong = F.coalesce(~F.col("difficulty_ok"), F.lit(False))
    out = results.agg(
        F.count_if(s).alias("sampled"), F.count_if(s & F.col("hard")).alias("sampled_hard"), F.count_if(s & F.col("hard") & wrong).alias("false_accepts"),
        F.count_if(s & F.col("error").isNotNull()).alias("judge_errors"),
    )
    rate = F.col("false_accepts") / F.greatest("sampled_hard", F.lit(1))
    passed = (F.col("sampled_hard") > 0) & (rate <= FALSE_ACCEPT) & (F.col("judge_errors") == 0) & (residual_rate <= RESIDUAL) & gold_passed
    return out.select("*", rate.alias("false_accept_rate"), passed.alias("passed"))


def overview(results: DataFrame, dataset: str, date: str, flagged: int = 100) -> dict:
    """Counts over results (row_ord, id, category, status, rules: array of rule and ok), and the first rows that did not pass.

    Only counts by status, rule and category and at most `flagged` rows reach the driver.
    """
    each = results.select(F.explode("rules").alias("r")).select("r.*")
    hits = each.groupBy("rule").agg(F.count_if("ok").alias("passed"), F.count_if(~F.col("ok")).alias("failed")).orderBy("rule")
    failed = F.array_join(F.transform(F.filter("rules", lambda r: ~r["ok"]), lambda r: r["rule"]), ", ")
    told = [c for c in ("source_case_id", "question", "judge") if c in results.columns]
    shown = results.where("status <> 'pass'").orderBy("row_ord").limit(flagged).select("id", "category", "status", failed.alias("failed_rules"), *told)
    counts = {s: 0 for s in ("pass", "fail", "needs_review")} | {r["status"]: r["count"] for r in results.groupBy("status").count().collect()}
    return {
        "dataset": dataset, "date": date, "total": sum(counts.values()), "status_counts": counts, "rule_hits": [r.asDict() for r in hits.collect()],
        "categories": [r.asDict() for r in category_shares(results, "category").orderBy(F.desc("n"), "category").collect()], "flagged": [r.asDict(recursive=True) for r in shown.collect()],
    }


def record_detail(results: DataFrame, record_id: str) -> dict:
    """The first result of an id; KeyError if there is none."""
    found = results.where(F.col("id") == record_id).orderBy("row_ord").limit(1).collect()
    if not found:
        raise KeyError(record_id)
    return found[0].asDict(recursive=True)


def record_key(case_id: Column, trace_id: Column, line: Column) -> Column:
    """What names a record: case and trace with its line, or the line alone where there is no trace."""
    text = F.coalesce(line.cast("string"), F.lit("?"))
    mark = F.when(line.isNotNull(), F.concat(F.lit("#"), line.cast("string"))).otherwise("")
    return F.when(F.coalesce(trace_id, F.lit("")) != "", F.concat(F.coalesce(case_id, F.lit("")), F.lit("|"), trace_id, mark)).otherwise(F.concat(F.lit("line_"), text))


def parse_taxonomy(lines: list[str]) -> list[tuple[str, str, str, str]]:
    """(difficulty, category_id, path, name) of lines such as '01  complex-topic/01-x  Name' and '01-y  Name'; anything else is an error."""
    out = []
    for line in (x.strip() for x in lines):
        if not line:
            continue
        parts = line.split(None, 2) if line.split(None, 1)[0].isdigit() else line.split(None, 1)
        if len(parts) == 3 and parts[1].startswith(COMPLEX_PREFIX):
            out.append(("hard", parts[0], parts[1], parts[2]))
        elif len(parts) == 2 and parts[0][:2].isdigit() and parts[0][2:3] == "-":
            out.append(("normal", parts[0][:2], parts[0], parts[1]))
        else:
            raise ValueError(f"no category: {line!r}")
    keys = [x[:2] for x in out]
    if len(set(keys)) != len(keys):
        raise ValueError("a category id occurs twice")
    return out


def missing_and_extra(found: list[str], expected: list[str]) -> tuple[list[str], list[str]]:
    """Ids that are expected but not found, and the other way round."""
    return sorted(set(expected) - set(found)), sorted(set(found) - set(expected))
