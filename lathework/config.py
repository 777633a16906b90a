"""Configuration of a run: defaults, a YAML file, a profile, and the environment, in this order."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any


@dataclass(frozen=True)
class Extraction:
    min_length: int = 50
    max_length: int = 10_000
    include_functions: bool = True
    include_full_files: bool = True


@dataclass(frozen=True)
class Deduplication:
    enabled: bool = True
    min_output_length: int = 50
    max_repetition: int = 3
    remove_similar: bool = False
    similarity_threshold: float = 0.85


@dataclass(frozen=True)
class Quality:
    min_instruction_length: int = 10
    max_instruction_length: int = 500
    min_output_length: int = 50
    max_output_length: int = 10_000


@dataclass(frozen=True)
class Config:
    name: str = "dataset"
    version: str = "1"
    output_format: str = "alpaca"
    sources: tuple[dict, ...] = ()
    extraction: Extraction = field(default_factory=Extraction)
    deduplication: Deduplication = field(default_factory=Deduplication)
    quality: Quality = field(default_factory=Quality)

    @property
    def full_name(self) -> str:
        return f"{self.name}-{self.version}"

    def enabled_sources(self) -> list[dict]:
        return [s for s in self.sources if s.get("enabled", True)]


#: Environment variables that override settings, with their place and type.
ENVIRONMENT: dict[str, tuple[str, Callable[[str], Any]]] = {
    "LATHEWORK_NAME": ("name", str), "LATHEWORK_VERSION": ("version", str), "LATHEWORK_FORMAT": ("output_format", str), "LATHEWORK_MIN_OUTPUT": ("deduplication.min_output_length", int),
    "LATHEWORK_MAX_REPETITION": ("deduplication.max_repetition", int), "LATHEWORK_SIMILARITY": ("deduplication.similarity_threshold", float), "LATHEWORK_MAX_LENGTH": ("extraction.max_length", int),
}


def deep_merge(base: Mapping, over: Mapping) -> dict:
    """Mappings merge; lists of named mappings merge by name; anything else is replaced."""
    out = dict(base)
    for key, value in over.items():
        old = out.get(key)
        if isinstance(old, Mapping) and isinstance(value, Mapping):
            out[key] = deep_merge(old, value)
        elif isinstance(old, list) and isinstance(value, list) and all(isinstance(x, Mapping) and "name" in x for x in [*old, *value]):
            named = {x["name"]: x for x in old}
            for x in value:
                named[x["name"]] = deep_merge(named.get(x["name"], {}), x)
            out[key] = list(named.values())
        else:
            out[key] = value
    return out


def _build(cls: type, raw: Mapping):
    known = {f.name: f for f in fields(cls)}
    values = {}
    for key, value in raw.items():
        if key not in known:
            continue  # unknown keys are ignored
        default = known[key].default_factory() if callable(known[key].default_factory) else None
        values[key] = _build(type(default), value) if isinstance(value, Mapping) and default is not None else tuple(value) if isinstance(value, list) else value
    return cls(**values)


def env_file(path: str | Path, environ: Mapping[str, str] = os.environ) -> dict[str, str]:
    """The environment with the settings of a file (``KEY=value`` lines, ``#`` comments) that it doesn't have itself."""
    out: dict[str, str] = {}
    if Path(path).exists():
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            key, sign, value = line.strip().partition("=")
            if sign and not key.startswith("#"):
                out.setdefault(key.strip(), value.strip())
    return out | dict(environ)


def load(path: str | Path | None = None, profile: str | None = None, environ: Mapping[str, str] = os.environ) -> Config:
    """The configuration of a file (none: defaults), with a profile of its ``profiles`` over it."""
    raw: dict = {}
    if path:
        import yaml

        raw = yaml.safe_load(Path(path).read_text()) or {}
    profiles = raw.pop("profiles", {}) or {}
    if profile:
        if profile not in profiles:
            raise KeyError(f"no profile {profile}")
        raw = deep_merge(raw, profiles[profile])
    for variable, (place, kind) in ENVIRONMENT.items():
        if variable in environ:
            *parents, last = place.split(".")
            at = raw
            for p in parents:
                at = at.setdefault(p, {})
            at[last] = kind(environ[variable])
    return _build(Config, raw)
