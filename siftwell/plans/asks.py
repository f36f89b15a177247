"""What each step gets back from a labeller, and which answers count.

Every label is a JSON object, also between code fences. Strict labels may have no other names than those of their
schema; values outside the closed lists make a label invalid, but unknown features, exclusions and evidence are left
out before that. An invalid label is no label: it is asked for again in the next run, and its row counts as failed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftwell.functions import rules, text
from siftwell.operators import quality, turns

LEVELS = ("low", "medium", "high")
SEVERITIES = ("none", "light", "severe")
ROUTES = ("complex", "normal", "reject")
# The answers of the family, pair and quality judges.
FAMILY_LABELS = ("eval_template_family", "semantic_duplicate", "natural_shared_phrase")
PAIR_LABELS = ("exact_semantic", "template_duplicate", "distinct")
QUALITIES = ("high", "low")

SIGNATURE = "struct<goal:string,subject_type:string,operations:array<string>,data_dimensions:array<string>,temporal_shape:string,output_shape:array<string>>"
_VALUE = "is_valuable string, has_executable_task string, self_contained string, template_severity string, contains_embedded_prompt string, reason string"
_EVIDENCE = "array<struct<criterion:string,quote:string>>"
_POLICY = f"route string, complex_features array<string>, exclusion_reasons array<string>, evidence {_EVIDENCE}, confidence string"


@dataclass(frozen=True)
class Ask:
    """A step: its schema, whether other names are errors, how raw answers are cleaned, and which cleaned ones are valid."""

    step: str
    schema: str
    valid: Callable[[Column], Column]
    strict: bool = False
    clean: Callable[[Column], Column] = lambda x: x
    tries: int = 5

    def read(self, rows: DataFrame, name: str) -> DataFrame:
        """rows (label, ...) with the cleaned label in a struct column; null if there is no object, or one with names that a strict step doesn't know.

        Column by column, so that an answer is parsed once and not for each place that looks at it.
        """
        out = rows.withColumn("object", text.json_text(F.col("label"))).withColumn("parsed", F.from_json("object", self.schema))
        if self.strict:
            names = [f.name for f in StructType.fromDDL(self.schema).fields]
            known = F.size(F.array_except(F.json_object_keys("object"), F.array(*map(F.lit, names)))) == 0
            out = out.withColumn("parsed", F.when(known, F.col("parsed")))
        return out.withColumn(name, self.clean(F.col("parsed"))).drop("object", "parsed")

    def checked(self, rows: DataFrame) -> DataFrame:
        """rows (label, ...) with ok: whether the label counts."""
        return self.read(rows, "clean").withColumn("ok", F.coalesce(self.valid(F.col("clean")), F.lit(False))).drop("clean")


def _clean_value(x: Column) -> Column:
    flag = lambda name, default: F.when(x[name].isNull(), F.lit(default)).otherwise(text.lax_boolean(x[name])).alias(name)
    return F.when(
        x.isNotNull(),
        F.struct(
            text.lax_boolean(x["is_valuable"]).alias("is_valuable"), flag("has_executable_task", True), flag("self_contained", True),
            F.coalesce(x["template_severity"], F.lit("none")).alias("template_severity"), flag("contains_embedded_prompt", False), x["reason"].alias("reason"),
        ),
    )


def _valid_value(x: Column) -> Column:
    flags = ("is_valuable", "has_executable_task", "self_contained", "contains_embedded_prompt")
    out = x["template_severity"].isin(*SEVERITIES)
    for name in flags:
        out = out & x[name].isNotNull()
    return out


def _clean_policy(x: Column, *more: str) -> Column:
    known = F.filter(F.coalesce(x["evidence"], F.array().cast(_EVIDENCE)), lambda e: e["criterion"].isin(*rules.FEATURES, *rules.EXCLUSIONS))
    fields = [
        x["route"].alias("route"), rules.known_only(x["complex_features"], rules.FEATURES).alias("complex_features"),
        rules.known_only(x["exclusion_reasons"], rules.EXCLUSIONS).alias("exclusion_reasons"), known.alias("evidence"), x["confidence"].alias("confidence"),
    ]
    if "semantic_signature" in more:
        s = x["semantic_signature"]
        scalar = lambda name: F.lower(rules.stripped(s[name])).alias(name)
        listed = lambda name: F.array_sort(F.array_distinct(F.coalesce(s[name], F.array().cast("array<string>")))).alias(name)
        signature = F.struct(scalar("goal"), scalar("subject_type"), listed("operations"), listed("data_dimensions"), scalar("temporal_shape"), listed("output_shape"))
        fields += [x["question_quality"].alias("question_quality"), F.when(s.isNotNull(), signature).alias("semantic_signature")]
    return F.when(x.isNotNull(), F.struct(*fields, x["reason"].alias("reason")))


def _valid_policy(x: Column, question: Column, quality_of: Column | None = None) -> Column:
    """A consistent route; the complex one with quotes that stand in the question."""
    criteria = F.transform(x["evidence"], lambda e: e["criterion"])
    out = rules.route_consistent(x["route"], x["complex_features"], x["exclusion_reasons"], criteria, x["confidence"], quality_of)
    quotes = F.transform(x["evidence"], lambda e: F.coalesce(e["quote"], F.lit("")))
    out = out & F.forall(quotes, lambda q: ~rules.blank(q))
    return out & x["confidence"].isin(*LEVELS) & ((x["route"] != "complex") | text.grounded(quotes, question))


def _valid_complexity(x: Column) -> Column:
    s = x["semantic_signature"]
    whole = s.isNotNull() & (s["goal"] != "") & (s["subject_type"] != "") & (s["temporal_shape"] != "")
    return _valid_policy(x, F.col("question"), x["question_quality"]) & x["question_quality"].isin(*LEVELS) & whole


def _classify(difficulty: str) -> Callable[[Column], Column]:
    ids = [i for i, _ in (quality.COMPLEX if difficulty == "hard" else quality.NORMAL)]
    return lambda x: x["category_id"].isin(*ids)


_CLASSIFY = "category_id string, reason string"
_clean_verify = _clean_policy


def _flags(x: Column) -> Column:
    return x["question_quality"].isin(*QUALITIES) & x["label_ok"].isNotNull() & x["difficulty_ok"].isNotNull()


#: Columns that valid reads beside the label: n (turns) for segment; question for complexity, verify, verify_again and audit.
ASKS = {
    a.step: a
    for a in (
        Ask("segment", "segments array<struct<start:int,end:int,topic:string>>", lambda x: turns.repaired_segments(x["segments"], F.col("n")).isNotNull(), tries=3),
        Ask("value", _VALUE, _valid_value, clean=_clean_value),
        Ask(
            "complexity", f"{_POLICY}, question_quality string, semantic_signature {SIGNATURE}, reason string", _valid_complexity, True,
            lambda x: _clean_policy(x, "semantic_signature"),
        ),
        Ask("classify_complex", _CLASSIFY, _classify("hard")),
        Ask("classify_normal", _CLASSIFY, _classify("normal")),
        Ask("classify_normal_after_verify", _CLASSIFY, _classify("normal")),
        Ask(
            "template_family", "label string, confidence string, reason string",
            lambda x: x["label"].isin(*FAMILY_LABELS) & x["confidence"].isin(*LEVELS) & ~rules.blank(x["reason"]), True,
        ),
        Ask("dedup_pair", "label string, reason string", lambda x: x["label"].isin(*PAIR_LABELS), True),
        Ask("verify", f"{_POLICY}, reason string", lambda x: _valid_policy(x, F.col("question")), True, _clean_verify),
        Ask("verify_again", f"{_POLICY}, reason string", lambda x: _valid_policy(x, F.col("question")), True, _clean_verify),
        Ask("translate", "translation string", lambda x: ~rules.blank(x["translation"]), tries=1),
        Ask("qc_judge", "question_quality string, label_ok boolean, difficulty_ok boolean, reason string", _flags, tries=1),
        Ask("audit", f"{_POLICY}, reason string", lambda x: _valid_policy(x, F.col("question")), True, _clean_verify, tries=1),
    )
}
