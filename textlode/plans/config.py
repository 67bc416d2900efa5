"""Run configuration from YAML or JSON, with required sections and exact keys."""

from __future__ import annotations

import json
from dataclasses import fields
from pathlib import Path

from .stages import Settings


def load(path: str, sections: tuple[str, ...] = ("chunking",)) -> dict:
    """A mapping with the required sections."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        found = json.loads(text)
    else:
        import yaml

        found = yaml.safe_load(text)
    if not isinstance(found, dict) or (missing := [s for s in sections if not isinstance(found.get(s), dict)]):
        raise ValueError(f"{path} lacks sections: {missing if isinstance(found, dict) else list(sections)}")
    return found


def settings(section: dict) -> Settings:
    """Settings of a section; unknown keys are errors, absent ones take defaults."""
    known = {f.name for f in fields(Settings)}
    if unknown := sorted(set(section) - known):
        raise ValueError(f"unknown settings: {unknown}")
    return Settings(**{k: tuple(v) if isinstance(v, list) else v for k, v in section.items()})


def inside(root: str, path: str) -> Path:
    """``path`` below ``root``; anything outside is an error."""
    whole = (Path(root) / path).resolve()
    if not whole.is_relative_to(Path(root).resolve()):
        raise ValueError(f"{path} lies outside {root}")
    return whole
