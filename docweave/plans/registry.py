"""Named operators: registration, lookup by regular expressions over whole names, and their context."""

from __future__ import annotations

import inspect
import os
import re
from collections.abc import Callable
from dataclasses import dataclass, fields
from typing import Any

_OPERATORS: dict[str, Callable[..., Any]] = {}


def operator(name: str):
    """Registers a function under a name; a second function of that name is refused."""

    def wrap(function):
        if _OPERATORS.setdefault(name, function) is not function:
            raise ValueError(f"operator {name} exists")
        return function

    return wrap


def discover(patterns: list[str] | None = None) -> dict[str, Callable[..., Any]]:
    """Operators whose whole name fits any of the patterns; all without patterns."""
    return {n: f for n, f in sorted(_OPERATORS.items()) if patterns is None or any(re.fullmatch(p, n) for p in patterns)}


def call(name: str, context: dict[str, Any], **arguments: Any) -> Any:
    """Calls an operator with what its parameters name in the arguments or the context."""
    function = _OPERATORS[name]
    wanted = inspect.signature(function).parameters
    unknown = set(arguments) - set(wanted)
    if unknown:
        raise TypeError(f"unexpected arguments {sorted(unknown)} for {name}")
    given = {p: context[p] for p in wanted if p in context and p not in arguments}
    missing = [p for p, s in wanted.items() if p not in given and p not in arguments and s.default is inspect.Parameter.empty]
    if missing:
        raise TypeError(f"missing {missing} for {name}")
    return function(**given, **arguments)


@dataclass
class EngineConfig:
    """Settings, which environment variables with the prefix DOCWEAVE_ replace."""

    data: str = "."
    workdir: str = "work"
    artifacts: str = "artifacts"
    batch_text_length: int = 10_000
    pages_per_batch: int = 200

    @classmethod
    def from_environment(cls, environment: dict[str, str] | None = None) -> EngineConfig:
        environment = os.environ if environment is None else environment
        found = {f.name: type(f.default)(environment[f"DOCWEAVE_{f.name.upper()}"]) for f in fields(cls) if f"DOCWEAVE_{f.name.upper()}" in environment}
        return cls(**found)
