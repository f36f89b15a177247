"""Dialects of chat logs, and their records as sessions of turns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = "struct<plan:string,tools:array<struct<name:string,input:string,output:string>>>"
TURN = (
    "question string, answer string, answer_full string, trace_id string, run_id string, chain array<" + STEP + ">, request_time string, first_token_ms double, total_duration_ms double, "
    "input_tokens long, output_tokens long, user_id string, status string, outcome string, last_event_type string, tool_names string, tool_count long"
)
#: Why a session without a context is left out.
EMPTY = "empty_context"


@dataclass(frozen=True)
class Dialect:
    """markers: top-level names that a record of the dialect has; valid: whether they hold what they should, of (json);
    adapt: (row_ord, json) to (row_ord, session_key, mode, reject, turns)."""

    markers: tuple[str, ...]
    valid: Callable[[Column], Column]
    adapt: Callable[[DataFrame], DataFrame]


_registry: dict[str, Dialect] = {}


def register(name: str, markers: tuple[str, ...], valid: Callable[[Column], Column], adapt: Callable[[DataFrame], DataFrame]) -> None:
    """Adds a dialect; a name can be taken once. Those that came first are recognised first."""
    if name in _registry:
        raise ValueError(f"dialect {name} is registered already")
    _registry[name] = Dialect(markers, valid, adapt)


def unregister(name: str) -> None:
    del _registry[name]


def names() -> list[str]:
    return list(_registry)


def dialect_of(record: Column) -> Column:
    """The dialect of a JSON object, '' if it has no dialect's names; a half or ill-typed set of names is 'invalid'."""
    keys = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))
    has = lambda name: F.array_contains(keys, name)
    out, some = F.lit(None).cast("string"), F.lit(False)
    for name, dialect in _registry.items():
        whole = F.coalesce(dialect.valid(record), F.lit(False))
        for marker in dialect.markers:
            whole, some = whole & has(marker), some | has(marker)
        out = F.coalesce(out, F.when(whole, name))
    return F.coalesce(out, F.when(some, "invalid"), F.lit(""))


def adapted(records: DataFrame, dialect: str) -> DataFrame:
    """(row_ord, session_key, mode, reject, turns) of records (row_ord, json); reject tells why one can't be a session."""
    if dialect not in _registry:
        raise ValueError(f"no dialect {dialect}")
    return _registry[dialect].adapt(records)


def adapt(records: DataFrame, dialect: str) -> tuple[DataFrame, DataFrame]:
    """(sessions: row_ord, session_key, mode, turns; rejects: row_ord, reason) of records (row_ord, json)."""
    out = adapted(records, dialect)
    return out.where("reject is null").drop("reject"), out.where("reject is not null").select("row_ord", F.col("reject").alias("reason"))


def turns_of(sessions: DataFrame) -> DataFrame:
    """(row_ord, session_key, mode, idx, ...) of every turn."""
    return sessions.select("row_ord", "session_key", "mode", F.posexplode("turns").alias("idx", "t")).select("row_ord", "session_key", "mode", "idx", "t.*")


def _text(json: Column, path: str) -> Column:
    """A value as text: null and absent become '', other values their JSON."""
    return F.coalesce(F.get_json_object(json, path), F.lit(""))


def _first(*values: Column) -> Column:
    """The first that is neither null nor empty, else ''."""
    return F.coalesce(*[F.when(v != "", v) for v in values], F.lit(""))


def _items(json: Column, path: str) -> Column:
    """An array's items as JSON, null if the value is no array."""
    raw = F.get_json_object(json, path)
    return F.when(F.ltrim(raw).startswith("["), F.try_parse_json(raw).cast("array<variant>"))


def _chain(json: Column, path: str) -> Column:
    raw = F.get_json_object(json, path)
    return F.coalesce(F.when(F.ltrim(raw).startswith("["), F.from_json(raw, f"array<{STEP}>")), F.array().cast(f"array<{STEP}>"))


def _turn(**values: Column) -> Column:
    """A turn of TURN's fields; those not given are empty, or null where they are no texts."""
    fields = []
    for part in _fields():
        name, kind = part
        value = values.get(name)
        if value is None:
            value = F.lit("") if kind == "string" and name not in ("status", "outcome", "last_event_type") else F.lit(None)
            value = F.array() if kind.startswith("array") else value
        fields.append(value.cast(kind).alias(name))
    return F.struct(*fields)


def _fields() -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in _schema()]


def _schema():
    from pyspark.sql.types import StructType

    return StructType.fromDDL(TURN)


def _adapt_session(records: DataFrame) -> DataFrame:
    """Sessions of all their turns; items of context that are no objects are skipped, context that is no array is rejected."""
    j = F.col("json")
    items = _items(j, "$.context")

    def turn(t: Column) -> Column:
        absent = lambda name: ~F.array_contains(F.json_object_keys(t), name)
        value = lambda name: F.get_json_object(t, f"$.{name}")
        a, full = _text(t, "$.answer"), _text(t, "$.answer_full")
        blank_first = lambda *names: F.coalesce(*[F.when(F.trim(value(n)) != "", value(n)) for n in names], F.lit(""))
        return _turn(
            question=_text(t, "$.question"), answer=_first(a, full), answer_full=_first(full, a), trace_id=_text(t, "$.trace_id"), run_id=_text(t, "$.run_id"), chain=_chain(t, "$.chain"),
            request_time=blank_first("request_time", "question_at"), first_token_ms=value("first_token_ms").try_cast("double"),
            total_duration_ms=value("total_duration_ms").try_cast("double"), input_tokens=value("input_tokens").try_cast("long"), output_tokens=value("output_tokens").try_cast("long"),
            user_id=_text(t, "$.user_id"), status=F.when(absent("status"), "completed").otherwise(value("status")), outcome=F.when(absent("outcome"), "success").otherwise(value("outcome")),
            last_event_type=value("last_event_type"), tool_names=blank_first("tool_names", "tool_names_text"), tool_count=value("tool_count").try_cast("long"),
        )

    objects = F.transform(F.filter(items, lambda v: F.schema_of_variant(v).startswith("OBJECT")), lambda v: F.to_json(v))
    nothing = F.coalesce(F.get_json_object(j, "$.context"), F.lit("")).isin("", "[]", "{}", "false", "0")
    reject = F.when(nothing, EMPTY).when(items.isNull(), "adapt_failed: context is no array")
    return records.select("row_ord", _text(j, "$.thread_id").alias("session_key"), F.lit("all").alias("mode"), reject.alias("reject"), F.transform(objects, turn).alias("turns"))


def _adapt_chat(records: DataFrame) -> DataFrame:
    """One question with the turns before it; only the last is a candidate. An earlier turn that is no object rejects the record."""
    j = F.col("json")
    prior = _items(j, "$.judge_data.context")
    odd = F.exists(prior, lambda v: ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)))
    data = F.get_json_object(j, "$.judge_data")
    said = F.transform(prior, lambda v: F.to_json(v))
    before = F.transform(said, lambda t: _turn(question=_text(t, "$.question"), answer=_text(t, "$.answer")))
    raw_input = F.get_json_object(j, "$.judge_data.input")
    own = F.when(F.ltrim(raw_input).startswith("{"), _text(j, "$.judge_data.input.text")).otherwise(F.coalesce(raw_input, F.lit("")))
    text, raw = _text(j, "$.judge_data.text_answer"), _text(j, "$.judge_data.raw_answer")
    number = lambda name: F.get_json_object(j, f"$.judge_data.meta.{name}")
    last = _turn(
        question=_first(own, _text(j, "$.question")), answer=_first(text, raw), answer_full=_first(raw, text),
        trace_id=_first(_text(j, "$.judge_data.trace_id"), _text(j, "$.trace_id")), chain=_chain(j, "$.judge_data.chain"),
        request_time=_text(j, "$.judge_data.meta.request_time"), first_token_ms=number("first_token_time_cost").try_cast("double"),
        total_duration_ms=number("finish_answer_time_cost").try_cast("double"), input_tokens=number("input_tokens").try_cast("long"),
        output_tokens=number("output_tokens").try_cast("long"), user_id=_text(j, "$.judge_data.meta.user_id"), status=F.lit("completed"), outcome=F.lit("success"),
    )
    reject = F.when(~F.coalesce(F.ltrim(data).startswith("{"), F.lit(False)), "adapt_failed: no judge_data")
    reject = reject.when(prior.isNull(), "adapt_failed: context is no array").when(odd, "adapt_failed: a turn is no object")
    key = _first(_text(j, "$.judge_data.case_id"), _text(j, "$.trace_id"))
    return records.select("row_ord", key.alias("session_key"), F.lit("last_only").alias("mode"), reject.alias("reject"), F.concat(before, F.array(last)).alias("turns"))


def _is(record: Column, name: str, kind: str) -> Column:
    return F.schema_of_variant(F.try_parse_json(F.get_json_object(record, f"$.{name}"))).startswith(kind)


def _session_valid(record: Column) -> Column:
    return (F.coalesce(F.get_json_object(record, "$.thread_id"), F.lit("")) != "") & _is(record, "context", "ARRAY")


register("session", ("thread_id", "context"), _session_valid, _adapt_session)
register("chat", ("judge_data",), lambda record: _is(record, "judge_data", "OBJECT"), _adapt_chat)
