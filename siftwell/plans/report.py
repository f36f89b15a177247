"""Small results as text: issues, suggestions, audits and quality overviews."""

from __future__ import annotations


def table(rows: list[dict], columns: list[str]) -> str:
    """Rows as a Markdown table."""
    cell = lambda v: f"{v:.3f}" if isinstance(v, float) else str(v).replace("|", "\\|").replace("\n", " ")
    lines = [columns, ["---"] * len(columns), *[[cell(r.get(c, "")) for c in columns] for r in rows]]
    return "\n".join("| " + " | ".join(x) + " |" for x in lines)


def precheck(stats: dict) -> str:
    names = ("lines", "bad_lines", "records", "duplicate_records", "empty_context_records", "turns", "eligible_turns", "turns_with_chain")
    shown = "\n".join(f"- {n}: {stats[n]}" for n in names if n in stats)
    issues = stats.get("issues", [])
    return f"# Precheck\n\n{shown}\n\n" + (table(issues, ["severity", "code", "n"]) if issues else "No issues.")


def suggestions(rows: list[dict]) -> str:
    marked = [{**r, "default": "*" if r["is_default"] else ""} for r in rows]
    return table(marked, ["min_calls", "min_tools", "reject_rules", "candidates", "ratio", "default"])


def audit(conclusion: dict, disputed: list[dict]) -> str:
    head = f"{'PASS' if conclusion['passed'] else 'FAIL'}: {conclusion['total']} rows, {conclusion['not_complex_ratio']:.2%} not complex, {conclusion['error_ratio']:.2%} undecided"
    return head + ("\n\n" + table(disputed, ["id", "reason", "errors"]) if disputed else "")


def quality(overview: dict) -> str:
    """A quality overview: status, rules, categories, the sample, the release gate and the rows that need a look."""
    counts = ", ".join(f"{k} {v}" for k, v in sorted(overview["status_counts"].items()))
    parts = [f"# Quality of {overview['dataset']}, {overview['date']}", f"{overview['total']} rows: {counts}"]
    if gate := overview.get("quality_gate"):
        shown = {k: v for k, v in gate.items() if not isinstance(v, dict) and v is not None}
        parts += [f"## Release gate: {'PASS' if gate['passed'] else 'FAIL'}", "\n".join(f"- {k}: {v}" for k, v in shown.items())]
    if sample := overview.get("sample"):
        parts += ["## Sample", "\n".join(f"- {k}: {v}" for k, v in sample.items())]
    parts += ["## Rules", table(overview["rule_hits"], ["rule", "passed", "failed"])]
    if overview.get("dataset_rules"):
        parts.append(table(overview["dataset_rules"], ["rule", "ok", "detail"]))
    parts += ["## Categories", table(overview["categories"], ["category", "n", "share"])]
    if overview["flagged"]:
        parts += ["## Flagged", table(overview["flagged"], ["id", "status", "failed_rules"])]
    return "\n\n".join(parts) + "\n"
