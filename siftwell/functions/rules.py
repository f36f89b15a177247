"""Rules on rows as columns: eligibility, noise, answers, labels and their checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftwell.functions.text import CJK, cjk_count, cjk_ratio, grounded, text_or_empty

# Texts without a task of their own, patterns of noise, refusals, and the closed lists of labels (FEATURES, EXCLUSIONS, TEMPLATE_EXCLUSIONS).
LOW_VALUE = (
    "好的", "好", "要", "需要", "可以", "是", "否", "嗯", "恩", "对", "行", "继续",
    "帮我", "看看", "分析一下", "转人工", "客服", "1", "2", "3", "A", "B", "a", "b",
    "ok", "OK", "PC", "PC端",
)
PAGE_CONTEXT = r"(?iu)图片是用户所处网页截图|Pageinfo|page_info_prompt|当前用户query|供你总结|不要透露你根据截图|忽略图右侧对话框|<\|上下文历史\|>|<\|用户问题\|>"
SUBMISSION = "\\A您好,请按以下Step1,Step2,Step3步骤,完成[“\"]?提交"
FOLLOW_UP = r"\A(?:继续|接着|再来|那|这个|那个|这些|上述|上面|刚才|前面|上一[个条轮]|前述|这[个些])[\s,，。!?！？]*\z"
CODE = r"\A[A-Za-z]?\p{Nd}+(?:\.\p{Nd}+)?(?:\.[A-Za-z]+)?\z"
ASCII_TOKEN = r"\A[A-Za-z0-9_.\-]{1,15}\z"
REFUSALS = (
    r"(?iu)抱歉[,，]?(?:我)?无法(?:回答|提供|满足)",
    r"(?iu)(?:我)?(?:不能|无法|拒绝)(?:回答|提供|满足|执行)",
    r"(?iu)我不(?:能|会)(?:回答|说)",
    r"(?iu)I['\u2019]?m sorry",
    r"(?iu)(?:I )?(?:cannot|can't|won't|will not) (?:answer|help|provide|comply)",
    r"(?iu)refus(?:e|ed) to (?:answer|provide|respond)",
    r"(?iu)as an AI (?:assistant|language model)",
    r"(?iu)(?:not|unable) (?:able|allowed|able to) to (?:answer|provide|respond)",
)
DANGLING = (",", "，", ":", "：", "-", "—", "–")
FEATURES = (
    "natural_multi_condition_screen", "position_context_decision", "multi_dimension_attribution", "cross_period_entity_research",
    "strategy_scenario_evaluation", "event_policy_impact", "multi_method_technical_analysis", "macro_industry_transmission",
    "historical_simulation_statistics", "stateful_tracking_execution", "artifact_action",
)
EXCLUSIONS = ("simple_lookup", "simple_filter_ranking", "single_formula", "generic_recommendation", "absolute_unverifiable", "insufficient_depth", "eval_template", "embedded_prompt")
TEMPLATE_EXCLUSIONS = ("eval_template", "embedded_prompt")


@dataclass(frozen=True)
class Limits:
    """Thresholds of the rules."""

    question_min: int = 6
    question_max: int = 2000
    symbol_cjk: int = 2
    symbol_length: int = 12
    answer_min: int = 50
    cjk_ratio: float = 0.3
    finished: str = "runFinished"


LIMITS = Limits()


def blank(text: Column) -> Column:
    return F.length(F.regexp_replace(text_or_empty(text), r"(?U)[\s\x1C-\x1F]+", "")) == 0


def stripped(text: Column) -> Column:
    return F.regexp_replace(text_or_empty(text), r"(?U)\A[\s\x1C-\x1F]+|[\s\x1C-\x1F]+\z", "")


def eligible(question: Column, answer: Column, status: Column | None = None, outcome: Column | None = None) -> Column:
    """A turn that ended well, with a question and an answer; no status or outcome counts as well."""
    ok = ~blank(question) & ~blank(answer)
    for value, good in ((status, "completed"), (outcome, "success")):
        if value is not None:
            ok = ok & (value.isNull() | (value == good))
    return ok


def reject_reason(normal: Column, limits: Limits = LIMITS) -> Column:
    """Why a normalised question is noise, by the first rule that holds; '' if none."""
    zh, n = cjk_count(normal), F.length(normal)
    return (
        F.when(normal == "", "blank")
        .when(normal.rlike(PAGE_CONTEXT), "embedded_page_or_prompt_context")
        .when(normal.rlike(SUBMISSION), "submission_template_fragment")
        .when(n > limits.question_max, f"too_long_gt{limits.question_max}")
        .when(normal.isin(*LOW_VALUE), "low_value_common")
        .when(normal.rlike(FOLLOW_UP), "context_only_followup")
        .when(normal.rlike(CODE), "number_or_code_only")
        .when(normal.rlike(ASCII_TOKEN), "ascii_token_only")
        .when(n < limits.question_min, "too_short")
        .when((zh <= limits.symbol_cjk) & (n <= limits.symbol_length), "mostly_symbol_short")
        .otherwise("")
    )


def refusal(answer: Column) -> Column:
    out = F.lit(False)
    for pattern in REFUSALS:
        out = out | text_or_empty(answer).rlike(pattern)
    return out


def truncated(answer: Column, question: Column) -> Column:
    """An answer that ends on a sign that more should follow, given a question."""
    return (text_or_empty(question) != "") & F.right(stripped(answer), F.lit(1)).isin(*DANGLING)


def answer_reason(question: Column, answer: Column, event: Column | None = None, limits: Limits = LIMITS) -> Column:
    """Why an answer is not fit, by the first rule that holds; null if it is."""
    text = stripped(answer)
    event = F.lit(None).cast("string") if event is None else event
    return (
        F.when(event != limits.finished, F.concat(F.lit("last_event_type="), event))
        .when(text == "", "empty_answer")
        .when(refusal(answer), "refusal")
        .when(F.length(text) < limits.answer_min, F.concat(F.lit("answer_too_short("), F.length(text).cast("string"), F.lit(f"<{limits.answer_min})")))
        .when(truncated(answer, question), "truncated_dangling_punctuation")
    )


def needs_translation(text: Column, limits: Limits = LIMITS) -> Column:
    return ~blank(text) & (cjk_ratio(text) < limits.cjk_ratio)


def value_admissible(valuable: Column, task: Column, contained: Column, severity: Column, embedded: Column) -> Column:
    return valuable & task & contained & (severity != "severe") & ~embedded


def value_rejection(task: Column, contained: Column, severity: Column, embedded: Column) -> Column:
    return F.when(embedded | (severity == "severe"), "template").when(~task, "no_task").when(~contained, "not_self_contained").otherwise("other")


def known_only(values: Column, allowed: tuple[str, ...]) -> Column:
    """Values of a closed list, sorted, each once."""
    return F.array_sort(F.array_distinct(F.filter(F.coalesce(values, F.array().cast("array<string>")), lambda v: v.isin(*allowed))))


def route_consistent(route: Column, features: Column, exclusions: Column, criteria: Column, confidence: Column, quality: Column | None = None) -> Column:
    """Whether a routing label does not contradict itself."""
    template = F.arrays_overlap(exclusions, F.array(*map(F.lit, TEMPLATE_EXCLUSIONS)))
    sure = confidence != "low"
    if quality is not None:
        sure = sure & (quality != "low")
    complex_ok = (F.size(features) > 0) & (F.size(exclusions) == 0) & sure & (F.size(F.array_except(features, criteria)) == 0)
    normal_ok = (F.size(features) == 0) & (F.size(exclusions) > 0) & ~template
    reject_ok = (F.size(features) == 0) & template
    return F.when(route == "complex", complex_ok).when(route == "normal", normal_ok).when(route == "reject", reject_ok).otherwise(False)


def admits_hard(route: Column, quotes: Column, question: Column) -> Column:
    """Only the complex route is hard, and only with quotes from the question."""
    return (route == "complex") & grounded(quotes, question)


def has_cjk(text: Column) -> Column:
    return text_or_empty(text).rlike(CJK)
