"""What each step tells a labeller: a registry of prompts, and the category texts that go into them."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable
from pathlib import Path

from siftwell.functions import rules
from siftwell.operators import quality

#: A folder with files <step>.md, which replace the prompts below.
FOLDER_VARIABLE = "SIFTWELL_PROMPTS"

_prompts: dict[str, Callable[[], str]] = {}


def register(step: str, text: str | Callable[[], str]) -> None:
    """Adds a step's prompt; a function is called when the prompt is first needed. A step can be taken once."""
    if step in _prompts:
        raise ValueError(f"there is a prompt for {step} already")
    _prompts[step] = text if callable(text) else lambda: text


def steps() -> list[str]:
    return list(_prompts)


def resolve(step: str, folder: str | None = None) -> str:
    """The prompt of a step: from the folder, or the one that the environment names, if it has the step's file."""
    if step not in _prompts:
        raise KeyError(f"no prompt for {step}; known: {', '.join(_prompts)}")
    folder = folder or os.environ.get(FOLDER_VARIABLE)
    if folder and (path := Path(folder) / f"{step}.md").exists():
        return path.read_text(encoding="utf-8")
    return _prompts[step]()


def fingerprint(folder: str | None = None) -> str:
    """A hash of all prompts: labels made under others are not used again."""
    return hashlib.sha256("\0".join(f"{s}\0{resolve(s, folder)}" for s in _prompts).encode()).hexdigest()[:16]


def parse_complex_examples(text: str) -> dict[str, tuple[str, list[str]]]:
    """Definition and examples by category id from sections '### 01 ...'; text outside a section, or a heading of another form, is an error.

    Examples are the numbered or dashed lines that follow a line which ends on a colon and names examples.
    """
    out: dict[str, tuple[str, list[str]]] = {}
    current, listing = None, False
    for line in (x.strip() for x in text.splitlines()):
        if line.startswith("###"):
            match = re.fullmatch(r"###\s+(\d{2})\b.*", line)
            if not match or match[1] in out:
                raise ValueError(f"no heading of a category, or one that comes twice: {line!r}")
            current, listing = match[1], False
            out[current] = ("", [])
        elif line.startswith("#"):
            current = None
        elif line and current is None:
            raise ValueError(f"text outside of all categories: {line[:60]!r}")
        elif line:
            item = re.match(r"(?:[-*]|\d+[.、)])\s*(.+)", line)
            if re.fullmatch(r"\**(?:examples?|示例)\**\s*[:：]\**", line, re.IGNORECASE):
                listing = True
            elif listing and item:
                out[current][1].append(item[1].strip())
            else:
                listing = False
                out[current] = (f"{out[current][0]} {line}".strip(), out[current][1])
    return out


def parse_normal_sections(text: str) -> dict[str, tuple[str, dict[str, str]]]:
    """Name and sections by category id from headings '## 01-slug name' and lines '**section**: text'; errors as above."""
    out: dict[str, tuple[str, dict[str, str]]] = {}
    current, section = None, None
    for line in (x.strip() for x in text.splitlines()):
        if line.startswith("##"):
            match = re.fullmatch(r"##\s+(\d{2})-([a-z0-9-]+)\s+(\S.*)", line)
            if not match or match[1] in out:
                raise ValueError(f"no heading of a category, or one that comes twice: {line!r}")
            current, section = match[1], None
            out[current] = (match[3], {})
        elif line.startswith("#"):
            current = None
        elif line and current is None:
            raise ValueError(f"text outside of all categories: {line[:60]!r}")
        elif line:
            match = re.fullmatch(r"\*\*([^*]+?)[:：]?\*\*[:：]?\s*(.*)", line)
            if match:
                section = match[1]
                out[current][1][section] = match[2]
            elif section:
                out[current][1][section] = f"{out[current][1][section]}\n{line}".strip()
    return out


def require_complete(found: list[str], expected: list[str], source: str) -> None:
    """An error if source describes other categories than the taxonomy has."""
    missing, extra = quality.missing_and_extra(found, expected)
    if missing or extra:
        raise ValueError(f"{source} and the taxonomy differ: without {missing}, unknown {extra}")


def classify_prompt(difficulty: str, described: dict[str, str] | None = None) -> str:
    """Asks for one category of a half of the taxonomy; described holds a text for each id, for all or none of them."""
    half = quality.COMPLEX if difficulty == "hard" else quality.NORMAL
    if described is not None:
        require_complete(list(described), [i for i, _ in half], "the category texts")
    listed = "\n".join(f"{i} {path}" + (f"\n{described[i]}" if described else "") for i, path in half)
    return (
        f"Sort the current question into exactly one of these {len(half)} categories, by what it asks for and not by single words. "
        'Earlier questions only explain what it refers to. Answer as JSON: {"category_id": "01", "reason": "a short sentence"}.\n\n' + listed
    )


_ROUTES = (
    "Decide the route of a finance question. complex: it needs several dependent steps, and each claimed feature is shown by a quote copied from the "
    "question. normal: one lookup, filter, formula or general advice. reject: a test template or an embedded prompt leads the text.\n"
    f"Features: {', '.join(rules.FEATURES)}. Exclusions: {', '.join(rules.EXCLUSIONS)}.\n"
    "complex has features and no exclusions; normal has exclusions and no features; reject has one of "
    f"{', '.join(rules.TEMPLATE_EXCLUSIONS)}. Answer as JSON with route, complex_features, exclusion_reasons, "
    "evidence (a list of criterion and quote), confidence (low, medium, high)"
)
register(
    "segment",
    "Cut the session's questions into topics that follow each other and cover all of them. "
    'Answer as JSON: {"segments": [{"start": 0, "end": 2, "topic": "..."}]}, both ends included.',
)
register(
    "value",
    "Say whether the question is worth keeping on its own. Answer as JSON with is_valuable, has_executable_task, self_contained, "
    "template_severity (none, light, severe), contains_embedded_prompt and reason.",
)
register(
    "complexity",
    f"{_ROUTES}, question_quality (low, medium, high), semantic_signature (goal, subject_type, operations, data_dimensions, temporal_shape, "
    "output_shape: what the task does, without names or numbers) and reason.",
)
register("classify_complex", lambda: classify_prompt("hard"))
register("classify_normal", lambda: classify_prompt("normal"))
register("classify_normal_after_verify", lambda: classify_prompt("normal"))
register(
    "template_family",
    "Each family is a set of questions that share long phrases. Say for each whether it is an eval_template_family, a semantic_duplicate or a "
    'natural_shared_phrase. Answer as JSON: {"items": [{"family_id", "label", "confidence" (low, medium, high), "reason"}]}, one for each family.',
)
register(
    "dedup_pair",
    "Say for each pair of questions whether they are exact_semantic, template_duplicate or distinct: the same task over the same objects, "
    'periods, thresholds and outputs, or not. Answer as JSON: {"items": [{"id", "label", "reason"}]}.',
)
register("verify", f"{_ROUTES} and reason. Look for the simplest way to answer before you call it complex.")
register("verify_again", f"{_ROUTES} and reason. This is a further, independent look; judge the question alone.")
register("translate", 'Translate the question into Chinese; keep names, numbers and codes. Answer as JSON: {"translation": "..."}.')
register(
    "qc_judge",
    "Check a labelled question: question_quality (high or low: whole, natural, feasible and clear, or not), label_ok (it belongs to the "
    "category), difficulty_ok (its level is right) and a reason. Answer as JSON with these four.",
)
register("audit", f"{_ROUTES} and reason. Be strict: in doubt it is normal.")
