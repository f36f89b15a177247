"""Named stages in order, each from one state to the next."""

from __future__ import annotations

from collections.abc import Callable

_stages: dict[str, Callable] = {}


def register(name: str):
    """Adds a stage at the end; a name can be taken once."""

    def add(stage: Callable) -> Callable:
        if name in _stages:
            raise ValueError(f"stage {name} is registered already")
        _stages[name] = stage
        return stage

    return add


def get(name: str) -> Callable:
    if name not in _stages:
        raise ValueError(f"no stage {name}; known: {', '.join(_stages)}")
    return _stages[name]


def names() -> list[str]:
    return list(_stages)
