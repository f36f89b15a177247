"""Settings of a run from a YAML or JSON file."""

from __future__ import annotations

import json
from dataclasses import fields
from pathlib import Path

from siftwell.operators.gates import Gate
from siftwell.plans.state import Settings

_PLAIN = {f.name for f in fields(Settings)} - {"labellers", "gate", "stages"}
_RATIOS = ("min_chain_coverage", "max_bad_lines", "threshold", "candidate_threshold")
_LEAST = {"verify_rounds": 0, "max_candidates": 1}
_PATHS = ("label_path", "log_path", "prompt_folder")


def load(path: str) -> Settings:
    """The settings in a file; names that are not known, and numbers out of their ranges, are errors. Relative paths start at the file's folder."""
    raw = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        said = json.loads(raw)
    else:
        try:
            import yaml
        except ImportError as error:
            raise RuntimeError("YAML settings need the yaml package; JSON ones do not") from error
        said = yaml.safe_load(raw) or {}
    return from_dict(said, str(Path(path).resolve().parent))


def from_dict(said: dict, base: str = ".") -> Settings:
    unknown = set(said) - _PLAIN - {"gate", "stages"}
    if unknown:
        raise ValueError(f"no such settings: {', '.join(sorted(unknown))}")
    for name in _RATIOS:
        if not 0 <= said.get(name, 0) <= 1:
            raise ValueError(f"{name} must lie between 0 and 1")
    for name, least in _LEAST.items():
        if said.get(name, least) < least:
            raise ValueError(f"{name} must be {least} at least")
    if said.get("dedup_mode", "semantic") not in ("semantic", "lexical"):
        raise ValueError("dedup_mode is semantic or lexical")
    values = {k: v for k, v in said.items() if k in _PLAIN}
    for name in _PATHS:
        path = values.get(name)
        if path and "://" not in path and not path.startswith("/"):
            values[name] = f"{base}/{path}"
    if "gate" in said:
        values["gate"] = Gate(**said["gate"])
    if "stages" in said:
        values["stages"] = tuple(said["stages"])
    return Settings(**values)
