"""Settings given by the user: watched entities, mapping rules, write targets."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

# The change kinds, in enumeration order (the position is the stored code).
CHANGE_KINDS = ("Insert", "Update", "Delete", "Snapshot", "SchemaChange", "Heartbeat")


@dataclass(frozen=True)
class Entity:
    """A watched table: its name, key columns, optional extra predicate and watermark column."""

    name: str
    key: tuple[str, ...] = ()
    filter: str | None = None
    watermark: str = "updated_at"


@dataclass(frozen=True)
class Rule:
    """One mapping rule for a source column."""

    source: str
    target: str | None = None
    type: str | None = None
    exclude: bool = False
    is_key: bool = False
    static: object | None = None
    concepts: Mapping[str, str] | None = None


@dataclass(frozen=True)
class Target:
    """A driver that may receive write commands."""

    driver: str
    source_type: str
    subjects: tuple[str, ...] = ()
    enabled: bool = True
    writable: bool = True


def check_rules(rules: Iterable[Rule]) -> None:
    """Raise ValueError for rules that cannot be compiled."""
    seen: set[str] = set()
    for rule in rules:
        if not rule.source or not rule.source.strip():
            raise ValueError("a mapping rule needs a source column")
        if rule.exclude and rule.is_key:
            raise ValueError(f"column {rule.source!r} cannot be both excluded and a key")
        name = rule.source.lower()
        if name in seen:
            raise ValueError(f"two mapping rules for column {rule.source!r}")
        seen.add(name)
