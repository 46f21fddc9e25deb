"""Settings of a run from a JSON or YAML file, a ``.env`` beside it and the environment, the last of them first.

    raw: s3a://bucket/raw           KINLOOM_RAW=...
    out: /data/out                  KINLOOM_OUT=...
    blocking:
      max_posting_list_size: 200    KINLOOM_BLOCKING__MAX_POSTING_LIST_SIZE=200
"""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from pathlib import Path

from ..operators.blocking import Blocking
from ..operators.pairs import Negatives
from .pipelines import Run

PREFIX = "KINLOOM_"


def read_env(path: Path) -> dict[str, str]:
    """The assignments of a .env file; comments and what is no assignment are left out."""
    if not path.exists():
        return {}
    lines = (line.strip().removeprefix("export ").partition("=") for line in path.read_text(encoding="utf-8").splitlines())
    return {k.strip(): v.strip().strip("\"'") for k, eq, v in lines if eq and not k.startswith("#")}


def read_file(path: Path) -> dict:
    if not path.exists():
        return {}
    content = path.read_text(encoding="utf-8")
    if path.suffix == ".json":
        return json.loads(content or "{}")
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError(f"{path}: YAML needs the yaml package; JSON does not") from e
    return yaml.safe_load(content) or {}


def _put(tree: dict, path: list[str], value: str) -> None:
    for part in path[:-1]:
        tree = tree.setdefault(part, {})
    try:
        tree[path[-1]] = json.loads(value)
    except ValueError:
        tree[path[-1]] = value


def load(path: str | None = None, environment: Mapping[str, str] | None = None) -> dict:
    """The merged settings; ``path`` defaults to KINLOOM_SETTINGS, and a missing file counts as empty."""
    environment = dict(os.environ if environment is None else environment)
    file = Path(path or environment.get(f"{PREFIX}SETTINGS", "settings.yaml"))
    tree = read_file(file)
    for source in (read_env(file.parent / ".env"), environment):
        for key, value in source.items():
            if key.startswith(PREFIX) and key != f"{PREFIX}SETTINGS":
                _put(tree, key.removeprefix(PREFIX).lower().split("__"), value)
    return tree


def run_of(settings: dict) -> Run:
    """A run; names that it doesn't know are left out, a missing root is an error."""
    known = {k: settings[k] for k in ("raw", "out", "normal", "version", "commit") if k in settings}
    negatives = {k: v for k, v in settings.get("negatives", {}).items() if k in Negatives.__dataclass_fields__}
    return Run(**known, settings=Blocking.from_dict(settings.get("blocking", {})), negatives=Negatives(**negatives))
