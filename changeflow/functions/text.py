"""Keys, paths and addresses as text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a missing key part is written in a state key.
MISSING_PART = "∅"
# The tokens an address template may hold.
TEMPLATE_TOKENS = ("{context}", "{entityPath}", "{changeType}", "{driverId}", "{sourceType}")

_TOKEN = re.compile(r"\{[^}]+\}")


def key_text(columns: Sequence[str | Column]) -> Column:
    """Key parts joined with a bar; a missing part is empty."""
    return F.concat_ws("|", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns])


def snapshot_key(entity: str | Column, columns: Sequence[str | Column], keyless: bool = False) -> Column:
    """``entity:part:part``; without key columns the entity alone, if ``keyless`` allows it."""
    if not columns and not keyless:
        raise ValueError("no key columns: all rows would share one slot; pass keyless=True to allow it")
    parts = [F.coalesce(_col(c).cast("string"), F.lit(MISSING_PART)) for c in columns]
    return F.concat_ws(":", _col(entity), *parts)


def sanitise_path(path: str | Column) -> Column:
    """Path separators become dots, other illegal characters underscores; dot runs collapse."""
    dotted = F.translate(_col(path), "/\\", "..")
    legal = F.regexp_replace(dotted, r"[^\p{L}\p{Nd}._-]", "_")
    return F.btrim(F.regexp_replace(legal, r"\.+", "."), F.lit("."))


def context_segment(context: str | Column) -> Column:
    return F.lower(F.translate(_col(context), ":", "-"))


def checkpoint_key(driver: str | Column, entity: str | Column) -> Column:
    """``driver.entity`` in lower case with only characters a key store accepts."""
    raw = F.lower(F.concat_ws(".", _col(driver), _col(entity)))
    return F.regexp_replace(F.translate(raw, "\\: ", "/--"), r"[^\p{L}\p{Nd}._=/-]", "_")


def template_parts(template: str) -> list[str]:
    """An address template cut into literals and tokens; an unknown token is an error."""
    unknown = [t for t in _TOKEN.findall(template) if t not in TEMPLATE_TOKENS]
    if unknown:
        raise ValueError(f"address template {template!r} has unknown token {unknown[0]!r}")
    return [p for p in re.split(r"(\{[^}]+\})", template) if p]


def subject_regex(pattern: str) -> str:
    """Anchored regex of a subscription: ``*`` is one token, a trailing ``>`` one or more."""
    tokens = pattern.split(".")
    if ">" in tokens[:-1]:
        raise ValueError(f"'>' may only end a subscription: {pattern!r}")
    parts = ["[^.]+" if t == "*" else ".+" if t == ">" else re.escape(t) for t in tokens]
    return "^" + r"\.".join(parts) + "$"


def subject_matches(subject: str | Column, pattern: str) -> Column:
    """Subscription test; the literal head is also tested as a prefix, which file filters can use."""
    subject = _col(subject)
    wild = re.search(r"(^|\.)[*>](\.|$)", pattern)
    if wild is None:
        return subject == pattern
    test = subject.rlike(subject_regex(pattern))
    head = pattern[: wild.start() + len(wild.group(1))]
    return subject.startswith(head) & test if head else test


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
