"""Conversations as turns: pairing, distinct records, segments and what came before a turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.functions.rules import blank
from siftwell.functions.text import content_key


def paired_turns(messages: DataFrame, session: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(session, idx, question, answer) of each user message and the message after it, if an assistant's.

    idx counts a session's user messages from 0. A message without an answer has an empty one.
    """
    w = Window.partitionBy(session).orderBy(order)
    step = messages.select(session, order, role, text, F.lead(role).over(w).alias("next_role"), F.lead(text).over(w).alias("next_text"))
    asked = step.where(F.col(role) == "user")
    return asked.select(
        F.col(session).alias("session"),
        (F.row_number().over(Window.partitionBy(session).orderBy(order)) - 1).alias("idx"),
        F.coalesce(text, F.lit("")).alias("question"),
        F.when(F.col("next_role") == "assistant", F.coalesce("next_text", F.lit(""))).otherwise("").alias("answer"),
    )


def keep_first(rows: DataFrame, key: Column, order: Column) -> DataFrame:
    """The first row of each key, in the given order; rows with a null or empty key all stay.

    Only keys travel twice: the first place of each key is an aggregate that is summed up before the
    shuffle, so a key that fills a third of the rows costs no task more than others.
    """
    spare = "keep first key", "keep first order"
    marked = rows.withColumns({spare[0]: F.coalesce(key.cast("string"), F.lit("")), spare[1]: order})
    first = marked.where(F.col(spare[0]) != "").groupBy(spare[0]).agg(F.min(spare[1]).alias("first place"))
    joined = marked.join(first, spare[0], "left")
    return joined.where((F.col(spare[0]) == "") | (F.col(spare[1]) == F.col("first place"))).select(rows.columns)


def last_turns(turns: DataFrame, keep: Column | None = None) -> DataFrame:
    """Each session's last turn, if it passes keep; an earlier one never takes its place."""
    n = F.max("idx").over(Window.partitionBy("session"))
    out = turns.withColumn("last idx", n).where(F.col("idx") == F.col("last idx")).drop("last idx")
    return out if keep is None else out.where(keep)


def repaired_segments(segments: Column, n: Column, slack: int = 2) -> Column:
    """Spans (start, end, topic) of a session made to touch and to cover 0 .. n - 1; null if that moves ends by more than slack.

    Spans are taken in order of their starts; one that begins or ends outside the session, or has no topic, makes
    all of them null. A topic that comes again takes in all that lies between.
    """
    kind = "array<struct<start:int,end:int,topic:string>>"
    spans = F.array_sort(F.transform(segments, lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"), F.trim(s["topic"]).alias("topic"))))
    inside = F.forall(spans, lambda s: F.coalesce((s["start"] >= 0) & (s["start"] <= s["end"]) & (s["end"] < n) & (s["topic"] != ""), F.lit(False)))
    # at: where the next span begins; due: where it should, by what was given; moved: by how much the ends have been moved
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("due"), F.lit(0).alias("moved"), F.array().cast(kind).alias("out"))

    def step(acc: Column, s: Column) -> Column:
        end = F.greatest(s["end"], acc["at"])
        made = F.struct(acc["at"].alias("start"), end.alias("end"), s["topic"].alias("topic"))
        moved = acc["moved"] + F.abs(s["start"] - acc["due"])
        return F.struct((end + 1).alias("at"), (s["end"] + 1).alias("due"), moved.alias("moved"), F.concat(acc["out"], F.array(made)).alias("out"))

    folded = F.aggregate(spans, zero, step)
    moved = folded["moved"] + F.abs(folded["due"] - n)
    last = F.size(folded["out"])
    whole = F.transform(
        folded["out"],
        lambda s, i: F.struct(s["start"].alias("start"), F.when(i == last - 1, n - 1).otherwise(s["end"]).cast("int").alias("end"), s["topic"].alias("topic")),
    )
    return F.when((F.size(segments) > 0) & inside & (moved <= slack), merged_topics(whole))


def merged_topics(spans: Column) -> Column:
    """Spans in which a topic that comes again reaches from its first place to its last."""

    def step(acc: Column, s: Column) -> Column:
        same = F.filter(acc, lambda x: x["topic"] == s["topic"])
        start = F.coalesce(F.try_element_at(same, F.lit(1))["start"], s["start"])
        joined = F.struct(start.alias("start"), s["end"].alias("end"), s["topic"].alias("topic"))
        return F.concat(F.filter(acc, lambda x: x["start"] < start), F.array(joined))

    return F.aggregate(spans, F.array().cast("array<struct<start:int,end:int,topic:string>>"), step)


def with_segments(turns: DataFrame, segments: DataFrame) -> DataFrame:
    """turns with start, end and topic of the span (session, start, end, topic) that holds idx; all in one where there is none."""
    s = segments.select(F.col("session").alias("span session"), "start", "end", "topic")
    inside = (F.col("session") == F.col("span session")) & F.col("idx").between(F.col("start"), F.col("end"))
    return turns.join(s, inside, "left").drop("span session").withColumns({"start": F.coalesce("start", F.lit(0)), "topic": F.coalesce("topic", F.lit(""))})


def asked_and_answered(turns: DataFrame) -> DataFrame:
    """(session, said): each session's questions and answers in order, as one array."""
    grouped = turns.groupBy("session").agg(F.array_sort(F.collect_list(F.struct("idx", "question", "answer"))).alias("said"))
    return grouped.select("session", F.transform("said", lambda t: F.struct(t["question"].alias("question"), t["answer"].alias("answer"))).alias("said"))


def with_prior(turns: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """turns (session, idx from 0, start) with prior: the questions and answers before each turn, in order.

    They come from the turn's own span; a turn that opens a span sees all earlier turns of its session.
    sessions (session, said) holds all turns of each; turns may be few of them. Each session's texts are
    gathered once, so what this makes is the result and no more.
    """
    sessions = asked_and_answered(turns) if sessions is None else sessions
    first = F.when(F.col("idx") == F.col("start"), 0).otherwise(F.col("start"))
    prior = F.slice("said", (first + 1).cast("int"), F.greatest(F.col("idx") - first, F.lit(0)).cast("int"))
    return turns.join(sessions, "session").withColumn("prior", prior).drop("said")


def judge_payload(prior: Column, question: Column) -> Column:
    """What a labeller is asked: earlier questions and the current one, as compact JSON."""
    return F.to_json(F.struct(F.transform(prior, lambda p: p["question"]).alias("prior_questions"), question.alias("current_question")))


def segment_payload(turns: DataFrame) -> DataFrame:
    """(session, n, payload) of all questions of each session with more than one turn."""
    grouped = turns.groupBy("session").agg(F.array_sort(F.collect_list(F.struct("idx", "question"))).alias("t"))
    return grouped.where(F.size("t") > 1).select("session", F.size("t").alias("n"), F.to_json(F.struct(F.col("t").alias("questions"))).alias("payload"))


def session_content_key(session_key: Column, mode: Column, turns: Column) -> Column:
    """A hash of all that a session says: its key, mode and every turn's texts, times, states and tools, in order."""
    names = ("trace_id", "question", "answer", "request_time", "status", "outcome", "tool_names", "tool_count")
    said = F.transform(turns, lambda t: content_key(*[t[n] for n in names], F.to_json(t["chain"])))
    return content_key(session_key, mode, F.array_join(said, ""))


def precheck_profile(sessions: DataFrame) -> DataFrame:
    """One row of counts over sessions (key, turns: array of eligible and has_chain); null turns are an empty context."""
    turns = F.coalesce("turns", F.array().cast(sessions.schema["turns"].dataType))
    good = F.filter(turns, lambda t: t["eligible"])
    keyed = F.col("key").isNotNull() & (F.col("key") != "")
    return sessions.agg(
        F.count("*").alias("records"),
        (F.count_if(keyed) - F.count_distinct(F.when(keyed, F.col("key")))).alias("duplicate_records"),
        F.count_if(F.size(turns) == 0).alias("empty_context_records"),
        F.coalesce(F.sum(F.size(turns)), F.lit(0)).alias("turns"),
        F.coalesce(F.sum(F.size(good)), F.lit(0)).alias("eligible_turns"),
        F.coalesce(F.sum(F.size(F.filter(good, lambda t: t["has_chain"]))), F.lit(0)).alias("turns_with_chain"),
    )


def precheck_issues(profile: DataFrame, min_coverage: float = 0.5, max_bad: float = 0.01) -> DataFrame:
    """(severity, code, n) of what is wrong with a profile that also has lines and bad_lines."""
    bad = F.col("bad_lines") / F.greatest(F.col("lines"), F.lit(1))
    none = F.col("eligible_turns") == 0
    low = ~none & (F.col("turns_with_chain") / F.greatest(F.col("eligible_turns"), F.lit(1)) < min_coverage)
    issue = lambda when, severity, code, n: F.when(when, F.struct(severity.alias("severity"), F.lit(code).alias("code"), n.cast("long").alias("n")))
    rows = F.array(
        issue((F.col("bad_lines") > 0) & (bad > max_bad), F.lit("critical"), "bad_line_ratio_exceeded", F.col("bad_lines")),
        issue((F.col("bad_lines") > 0) & (bad <= max_bad), F.lit("warning"), "bad_lines", F.col("bad_lines")),
        issue(F.col("duplicate_records") > 0, F.lit("warning"), "duplicate_records", F.col("duplicate_records")),
        issue(F.col("empty_context_records") > 0, F.lit("warning"), "empty_context_records", F.col("empty_context_records")),
        issue(none, F.lit("critical"), "no_eligible_turns", F.lit(0)),
        issue(low, F.lit("critical"), "missing_chain", F.col("eligible_turns") - F.col("turns_with_chain")),
    )
    return profile.select(F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("i")).select("i.*")


def unanswered(answer: Column) -> Column:
    return blank(answer)
