"""Tool-call gates, their defaults by dialect, and the grid of thresholds to choose from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Least tool calls and distinct tools by dialect, and the axes of the grid.
DEFAULTS = {"session": (7, 2), "chat": (3, 2)}
CALLS, TOOLS, REJECT = (0, 1, 2, 3, 4, 5, 7, 10, 15), (1, 2, 3, 5), (True, False)


@dataclass(frozen=True)
class Gate:
    """Thresholds; those left out follow the dialect."""

    calls: int | None = None
    steps: int = 1
    tools: int | None = None
    reject_rules: bool = True
    enabled: bool = True

    def for_dialect(self, name: str) -> Gate:
        calls, tools = DEFAULTS.get(name, DEFAULTS["session"])
        return Gate(calls if self.calls is None else self.calls, self.steps, tools if self.tools is None else self.tools, self.reject_rules, self.enabled)


def chain_calls(chain: Column, tool_count: Column) -> Column:
    """Tool calls of a chain (array of steps with tools), or the count given where there is no chain."""
    counted = F.aggregate(chain, F.lit(0).cast("long"), lambda a, s: a + F.coalesce(F.when(s["tools"].isNotNull(), F.size(s["tools"])), F.lit(0)))
    return F.when(F.size(chain) > 0, counted).otherwise(F.coalesce(tool_count.cast("long"), F.lit(0)))


def chain_steps(chain: Column, tool_count: Column) -> Column:
    return F.when(F.size(chain) > 0, F.size(chain)).otherwise((F.coalesce(tool_count, F.lit(0)) > 0).cast("int"))


def chain_tools(chain: Column, tool_names: Column) -> Column:
    """Distinct tool names in order of their first use; a comma-separated list serves where the chain names none."""
    clean = lambda names: F.array_distinct(F.filter(F.transform(names, lambda x: F.trim(F.coalesce(x, F.lit("")))), lambda x: x != ""))
    named = clean(F.flatten(F.transform(chain, lambda s: F.coalesce(F.transform(s["tools"], lambda t: t["name"]), F.array().cast("array<string>")))))
    return F.when(F.size(named) > 0, named).otherwise(clean(F.split(F.coalesce(tool_names, F.lit("")), ",")))


def passes(gate: Gate, eligible: Column, reason: Column, calls: Column, steps: Column, tools: Column) -> Column:
    """Whether a turn is a candidate; a disabled gate asks for eligibility only."""
    if not gate.enabled:
        return eligible
    ok = eligible & (calls >= gate.calls) & (steps >= gate.steps) & (tools >= gate.tools)
    return ok & (reason == "") if gate.reject_rules else ok


def threshold_grid(features: DataFrame, calls=CALLS, tools=TOOLS, reject=REJECT) -> DataFrame:
    """(min_calls, min_tools, reject_rules, candidates, total_turns) of every combination of thresholds.

    features has eligible, reason, calls, steps and tools for each turn. Turns are first counted by their
    values, capped at the axes' largest, so the grid meets a table whose size the axes bound.
    """
    spark = features.sparkSession
    top_calls, top_tools = max(calls), max(tools)
    small = features.groupBy(
        (F.col("eligible") & (F.col("steps") >= 1)).alias("ok"), (F.col("reason") == "").alias("clean"),
        F.least(F.col("calls"), F.lit(top_calls)).alias("calls"), F.least(F.col("tools"), F.lit(top_tools)).alias("tools"),
    ).agg(F.count("*").alias("n"))
    grid = spark.createDataFrame([(c, t, r) for c in calls for t in tools for r in reject], "min_calls int, min_tools int, reject_rules boolean")
    hit = F.col("ok") & (F.col("calls") >= F.col("min_calls")) & (F.col("tools") >= F.col("min_tools")) & (F.col("clean") | ~F.col("reject_rules"))
    # at most 4 * (largest calls + 1) * (largest tools + 1) rows meet the grid's
    met = grid.join(F.broadcast(small), F.lit(True), "left")
    return met.groupBy("min_calls", "min_tools", "reject_rules").agg(F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("candidates"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_turns"))


def suggestions(grid: list[dict], dialect: str = "session", top: int = 10) -> list[dict]:
    """Of the grid's rows, top ones spread evenly over different candidate counts; the default is always among them."""
    calls, tools = DEFAULTS.get(dialect, DEFAULTS["session"])
    order = sorted(grid, key=lambda r: (CALLS.index(r["min_calls"]), TOOLS.index(r["min_tools"]), not r["reject_rules"]))
    seen, kept = set(), []
    for r in order:
        default = r["min_calls"] == calls and r["min_tools"] == tools and bool(r["reject_rules"])
        if r["candidates"] in seen and not default:
            continue
        seen.add(r["candidates"])
        kept.append({**r, "ratio": r["candidates"] / r["total_turns"] if r["total_turns"] else 0.0, "is_default": default})
    kept.sort(key=lambda r: r["candidates"])
    if len(kept) <= top:
        return kept
    picked = [kept[round(i * (len(kept) - 1) / (top - 1))] for i in range(top)]
    if not any(r["is_default"] for r in picked):
        picked = sorted([*picked, next(r for r in kept if r["is_default"])], key=lambda r: r["candidates"])
    return picked
