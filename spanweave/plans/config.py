"""Settings of stages: JSON files with typed, checked values."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping

#: The key under which a loaded configuration keeps the folder that its paths are relative to.
ROOT = "config_root"


def load(path: str) -> dict:
    """A stage's settings from a JSON file, with the folder its paths are relative to."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    if not isinstance(found, dict):
        raise ValueError(f"{path} must hold an object, got {type(found).__name__}")
    return {**found, ROOT: os.path.dirname(os.path.abspath(path))}


def load_all(folder: str, names: Mapping[str, str]) -> dict[str, dict]:
    """Settings of each stage whose file (``names``: stage to file) is in the folder; others have none."""
    return {stage: load(os.path.join(folder, file)) for stage, file in names.items() if os.path.isfile(os.path.join(folder, file))}


def number(config: Mapping, key: str, default: float, least: float | None = None) -> float:
    """A number; truth values and text are none."""
    value = config.get(key, default)
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        raise ValueError(f"{key} must be a number, got {type(value).__name__}")
    if least is not None and value < least:
        raise ValueError(f"{key} must be at least {least}, got {value}")
    return float(value)


def whole(config: Mapping, key: str, default: int, least: int | None = None) -> int:
    found = number(config, key, default, least)
    if found != int(found):
        raise ValueError(f"{key} must be a whole number, got {found}")
    return int(found)


def flag(config: Mapping, key: str, default: bool) -> bool:
    value = config.get(key, default)
    if not isinstance(value, bool):
        raise ValueError(f"{key} must be true or false, got {type(value).__name__}")
    return value


def text(config: Mapping, key: str, default: str) -> str:
    value = config.get(key, default)
    if not isinstance(value, str):
        raise ValueError(f"{key} must be text, got {type(value).__name__}")
    return value


def path(config: Mapping, key: str) -> str | None:
    """A path, relative to the settings' own folder; none where it is not given."""
    value = config.get(key)
    if value is None:
        return None
    said = text(config, key, "")
    return said if os.path.isabs(said) or ROOT not in config else os.path.normpath(os.path.join(config[ROOT], said))
