"""Settings: overlay of values on dataclasses, and rules that are checked when a plan is built."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any


def overlay(base: Any, values: dict[str, Any]) -> Any:
    """base with values put over it: unknown keys raise, nested settings recurse, dictionaries merge; checked once at the end."""
    known, new = {f.name: f for f in fields(base)}, {}
    for key, value in values.items():
        if key not in known:
            raise ValueError(f"unknown setting {key!r}; known: {', '.join(sorted(known))}")
        old = getattr(base, key)
        new[key] = overlay(old, value) if is_dataclass(old) else old | value if isinstance(old, dict) and isinstance(value, dict) else value
    return replace(base, **new)


@dataclass(frozen=True)
class Curation:
    """Settings of curation, with their rules."""

    chunk_size: int = 1000
    chunk_overlap: int = 100
    train: float = 0.8
    validation: float = 0.1
    threshold: float = 0.5
    weights: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not 0 <= self.chunk_overlap < self.chunk_size:
            raise ValueError("chunk_overlap has to be smaller than chunk_size")
        if min(self.train, self.validation) < 0 or self.train + self.validation > 1:
            raise ValueError("fractions can't be negative or exceed 1 together")
        if not 0 <= self.threshold <= 1:
            raise ValueError("threshold has to be from 0 to 1")
        if any(w < 0 for w in self.weights.values()):
            raise ValueError("weights can't be negative")


def export_paths(folder: str, stem: str) -> dict[str, str]:
    """The three outputs of a run; stem has to be a plain file stem."""
    if not stem or stem != stem.strip() or any(c in stem for c in "/\\") or stem in (".", ".."):
        raise ValueError(f"{stem!r} isn't a plain file stem")
    return {k: f"{folder.rstrip('/')}/{stem}{tail}" for k, tail in (("accepted", ""), ("audit", "_audit"), ("summary", "_summary"))}
