"""Small driver-side state: prompts, generations, synthetic records. None of it grows with the corpus."""

from __future__ import annotations

import hashlib
import json
import os
from pathlib import Path

import yaml


def active_prompts(folder: str, env: dict[str, str] | None = None) -> dict[str, dict]:
    """pass -> {version, text, sha256}; a file named by the environment overrides, and is recorded so."""
    env = os.environ if env is None else env
    out = {}
    for name, entry in yaml.safe_load((Path(folder) / "registry.yaml").read_text()).items():
        override = env.get(f"PROMPT_FILE_{name.upper()}")
        text = Path(override).read_text() if override else (Path(folder) / entry["file"]).read_text()
        out[name] = {"version": "override" if override else str(entry["active"]), "text": text, "sha256": hashlib.sha256(text.encode()).hexdigest()}
    return out


def generation(folder: str, current: int | None = None) -> int:
    """The store's generation; written on first use, and an error where it is another one."""
    path = Path(folder) / "generation.json"
    if not path.exists():
        if current is None:
            raise ValueError("no generation")
        path.write_text(json.dumps({"generation": current}))
    found = json.loads(path.read_text()).get("generation")
    if not isinstance(found, int) or isinstance(found, bool) or (current is not None and found != current):
        raise ValueError(f"generation {found!r} is not {current!r}")
    return found


def synthetic_record(title: str, body: str, **header) -> tuple[str, str]:
    """(file name, text) of a record named by the hash of its body."""
    head = yaml.safe_dump({"schema": "record/1", "title": title, **header}, sort_keys=True, allow_unicode=True)
    return f"{hashlib.sha256(body.encode()).hexdigest()}.md", f"---\n{head}---\n{body}"
