"""Configurations and plans of a run: small documents, on the driver."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
from collections.abc import Callable

from .documents import object_of
from .writers import write_atomically


def symmetric_range(value):
    """A single angle, as old configurations have it, is a range about 0; ranges stay."""
    return (-value / 2.0, value / 2.0) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


def moved_key(document: dict, old: tuple[str, str], new: tuple[str, str]) -> dict:
    """A key of a section, where it has moved to another section. Both places with different values are an error; nothing is changed in place."""
    section = document.get(old[0])
    if not isinstance(section, dict) or old[1] not in section:
        return document
    value, target = section[old[1]], dict(document.get(new[0]) or {})
    if target.get(new[1]) is not None and target[new[1]] != value:
        raise ValueError(f"{'.'.join(new)} conflicts with {'.'.join(old)}")
    return document | {old[0]: {k: v for k, v in section.items() if k != old[1]}, new[0]: target | {new[1]: value}}


def or_default(value, default):
    """A value that is missing or null takes its default."""
    return default if value is None else value


def fingerprint(document) -> str:
    """The SHA-256 of a document, whatever the order of its keys."""
    return hashlib.sha256(json.dumps(document, sort_keys=True, ensure_ascii=False, allow_nan=False).encode()).hexdigest()


def load_or_create_plan(path: str, settings: dict, make: Callable[[], list[dict]], least: int) -> list[dict]:
    """The captures of a plan. A saved one has to be of the same settings, and its own hash has to be that of its captures; a new one needs at least so many captures, and is written before anything is done by it."""
    now = fingerprint(settings)
    if os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            saved = object_of(f.read(), path)
        if saved.get("settings") != now:
            raise ValueError("the saved plan is of other settings")
        if saved.get("plan") != fingerprint(saved.get("captures")):
            raise ValueError("the saved plan's hash isn't that of its captures")
        return saved["captures"]
    captures = make()
    if len(captures) < least:
        raise ValueError(f"the plan has only {len(captures)} captures, and needs {least}")
    write_atomically(path, json.dumps({"settings": now, "plan": fingerprint(captures), "captures": captures}, ensure_ascii=False, indent=2) + "\n")
    return captures


def write_resolved(settings: dict, path: str) -> None:
    """The settings that a run works with, beside its results."""
    write_atomically(path, json.dumps(settings, ensure_ascii=False, indent=2, sort_keys=True) + "\n")


def protect(folder: str, overwrite: bool, owned: tuple[str, ...]) -> list[str]:
    """Makes room for a run's output: what it owns in the folder is deleted if it may overwrite; else it is an error that it is there. Other files stay. Returns what was deleted."""
    there = [x for x in owned if os.path.lexists(os.path.join(folder, x))]
    if there and not overwrite:
        raise FileExistsError(f"{folder} has {', '.join(there)}")
    for x in there:
        path = os.path.join(folder, x)
        shutil.rmtree(path) if os.path.isdir(path) and not os.path.islink(path) else os.remove(path)
    os.makedirs(folder, exist_ok=True)
    return there


def remove_rejected(folder: str, name: str) -> bool:
    """Deletes the folder of what was rejected. A link is never followed, and something else of that name is an error."""
    path = os.path.join(folder, name)
    if os.path.islink(path):
        raise ValueError(f"{path} is a link")
    if not os.path.exists(path):
        return False
    if not os.path.isdir(path):
        raise ValueError(f"{path} is no folder")
    shutil.rmtree(path)
    return True


def base_pose(**sources):
    """The first pose that is there, and where it came from; the order of the arguments is that of precedence."""
    for name, pose in sources.items():
        if pose is not None:
            return pose, name
    raise ValueError("no pose is given")
