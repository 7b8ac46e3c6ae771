"""Driver-side inputs of an evaluation: files bound by hash, prompts held fast for a run, configurations kept by fingerprint, accepted baselines.

None of it grows with the corpus.
"""

from __future__ import annotations

import fcntl
import hashlib
import json
import os
import re
from dataclasses import dataclass
from pathlib import Path
from types import MappingProxyType

import yaml

from .digests import canonical_json, fingerprint
from .registry import active_prompts

#: Names of this engine's own documents.
CONFIGS, BASELINE, MANIFEST = "folioscope/configurations/1", "folioscope/baseline/1", "folioscope/predictions/1"


def hashed_document(path: str | Path) -> tuple[dict, str]:
    """A YAML or JSON mapping and the SHA-256 of the very bytes it was read from."""
    raw = Path(path).read_bytes()
    document = yaml.safe_load(raw.decode("utf-8"))
    if not isinstance(document, dict):
        raise ValueError(f"{path} is no mapping")
    return document, hashlib.sha256(raw).hexdigest()


def predictions(path: str | Path, cases: list[str], only: str | None = None) -> dict[str, tuple[dict, str]]:
    """case -> (prediction, hash). A manifest names a file for each case, relative to itself and inside its folder; any other document is the one case's prediction."""
    path = Path(path)
    document, digest = hashed_document(path)
    wanted = [c for c in cases if only in (None, c)]
    if not wanted:
        raise ValueError(f"unknown case {only}")
    if document.get("schema") != MANIFEST:
        if len(wanted) > 1:
            raise ValueError("one prediction can't stand for several cases")
        return {wanted[0]: (document, digest)}
    files, home = document.get("predictions"), path.parent.resolve()
    out = {}
    for case in wanted:
        name = files.get(case) if isinstance(files, dict) else None
        if not isinstance(name, str) or not name or Path(name).is_absolute() or not (home / name).resolve().is_relative_to(home):
            raise ValueError(f"case {case} needs a file inside the manifest's folder")
        out[case] = hashed_document(home / name)
    return out


@dataclass(frozen=True)
class Pinned:
    """The prompts of a run, read once: later changes of the files or the environment don't reach it."""

    passes: MappingProxyType

    @classmethod
    def read(cls, folder: str, env: dict[str, str] | None = None) -> Pinned:
        return cls(MappingProxyType({k: MappingProxyType(v) for k, v in active_prompts(folder, env).items()}))

    def provenance(self) -> list[dict[str, str]]:
        return [{"pass": k, "version": v["version"], "sha256": v["sha256"]} for k, v in sorted(self.passes.items())]


def fingerprints(schema: object, code: list[str | Path], config: object) -> dict[str, str]:
    """What an extraction rests on: hashes of its output schema, of its source files in order of name, and of its configuration."""
    files = {Path(p).name: hashlib.sha256(Path(p).read_bytes()).hexdigest() for p in code}
    return {"schema": fingerprint(schema), "code": fingerprint(files), "config": fingerprint(config)}


def _configurations(path: Path) -> dict[str, dict]:
    """The registry's entries, each under its own fingerprint; one without a schema is a plain map of them, as old ones were."""
    document = json.loads(path.read_text())
    found = document.get("configurations") if document.get("schema") == CONFIGS else document if "schema" not in document else None
    if not isinstance(found, dict) or any(not re.fullmatch("[0-9a-f]{64}", k) or fingerprint(v) != k for k, v in found.items()):
        raise ValueError(f"{path} is no valid registry")
    return found


def register(folder: str | Path, configuration: dict) -> str:
    """Keep a configuration under its fingerprint. Writers wait for each other, and readers see a whole file."""
    home = Path(folder)
    home.mkdir(parents=True, exist_ok=True)
    path, key = home / "configurations.json", fingerprint(configuration)
    with open(home / ".lock", "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        found = _configurations(path) if path.exists() else {}
        if key in found and canonical_json(found[key]) != canonical_json(configuration):
            raise ValueError(f"{key} stands for two configurations")
        whole = {"schema": CONFIGS, "configurations": dict(sorted((found | {key: configuration}).items()))}
        new = path.with_suffix(f".{os.getpid()}")
        new.write_text(json.dumps(whole, indent=2, sort_keys=True))
        os.replace(new, path)
    return key


def registered(folder: str | Path) -> dict[str, dict]:
    return _configurations(Path(folder) / "configurations.json")


def accept_baseline(path: str | Path, rates: dict[str, dict], hashes: dict[str, str], by: str) -> None:
    """Make these dimension counts ({dimension: {passed, total}}) what later runs are held against; bound to its inputs' hashes and to who accepted it."""
    if not by.strip() or not hashes:
        raise ValueError("a baseline needs who accepts it and what it rests on")
    Path(path).write_text(json.dumps({"schema": BASELINE, "accepted_by": by, "hashes": hashes, "dimensions": rates}, indent=2, sort_keys=True))


def against_baseline(path: str | Path, rates: dict[str, dict], hashes: dict[str, str]) -> dict[str, str]:
    """dimension -> better, worse or unchanged. A baseline of other inputs is stale, and an error."""
    accepted = json.loads(Path(path).read_text())
    if accepted.get("schema") != BASELINE or accepted["hashes"] != hashes:
        raise ValueError("the baseline is of other inputs")
    share = lambda x: None if not x or not x["total"] else x["passed"] / x["total"]
    out = {}
    for name in sorted(accepted["dimensions"].keys() | rates.keys()):
        old, new = share(accepted["dimensions"].get(name)), share(rates.get(name))
        out[name] = "unchanged" if old == new else "better" if old is None or (new is not None and new > old) else "worse"
    return out
