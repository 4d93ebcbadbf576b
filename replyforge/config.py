"""Column names and run limits that callers may rename or tune."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

import yaml


@dataclass(frozen=True)
class StatusSets:
    """Status values of a sample record (fixed values)."""

    skip: tuple[str, ...] = ("completed",)
    resume: tuple[str, ...] = ("processing", "error", "max_rounds", "resume")
    write: tuple[str, ...] = ("completed", "error", "max_rounds")


@dataclass(frozen=True)
class FieldNames:
    """Names of the record columns plus the two best-of-N limits."""

    response_key: str = "response"
    meta_response_key: str = "meta_response"
    error_key: str = "error"
    id_key: str | tuple[str, ...] = "id"
    prompt_key: str = "prompt"
    history_key: str = "history"
    status_key: str = "status"
    save_prompt: bool = True
    save_meta_response: bool = True
    max_rounds: int = 30
    bon: int = 1
    statuses: StatusSets = field(default_factory=StatusSets)

    @property
    def id_columns(self) -> list[str]:
        return [self.id_key] if isinstance(self.id_key, str) else list(self.id_key)


# Best-of-N is spelled "BoN" in the YAML files.
_YAML_NAMES = {"BoN": "bon"}


def load_config(path: str) -> FieldNames:
    """Read a YAML run configuration; keys this library does not use are ignored."""
    with open(path, encoding="utf-8") as handle:
        raw = yaml.safe_load(handle) or {}
    known = {f.name for f in fields(FieldNames)} - {"statuses"}
    values = {_YAML_NAMES.get(k, k): v for k, v in raw.items()}
    values = {k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k in known}
    return FieldNames(**values)
