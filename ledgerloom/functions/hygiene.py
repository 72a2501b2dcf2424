"""Private-data patterns and artifact names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as private data in a text.
PRIVATE_PATTERNS: Mapping[str, str] = {
    "mac_home_path": r"/Users/[A-Za-z0-9_.-]+/",
    "linux_home_path": r"/home/[A-Za-z0-9_.-]+/",
    "secret_key": r"sk-[A-Za-z0-9]{16,}",
    "uuid": r"(?i)\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b",
}

# Runtime files that must not be published.
PRIVATE_NAMES = ("model-state.json", "state.json", "ledger.jsonl")
PRIVATE_SUFFIXES = (".packet.json", ".result.json")
PRIVATE_ROOTS = ("handoffs", "model-daily", "structured")


def private_pattern_hits(text: Column) -> dict[str, Column]:
    """One boolean per private-data pattern."""
    # (?U) makes word boundaries Unicode ones on every Java version.
    return {name: text.rlike("(?U)" + pattern) for name, pattern in PRIVATE_PATTERNS.items()}


def first_hit(hits: Mapping[str, Column]) -> Column:
    """Name of the first pattern found: one finding per text, null if none."""
    return F.coalesce(*[F.when(hit, F.lit(name)) for name, hit in hits.items()])


def is_private_artifact(path: Column) -> Column:
    """Whether a relative path is a private runtime file by name, ending or root."""
    name = F.element_at(F.split(path, "/"), -1)
    by_suffix = F.lit(False)
    for suffix in PRIVATE_SUFFIXES:
        by_suffix = by_suffix | name.endswith(suffix)
    return name.isin(*PRIVATE_NAMES) | by_suffix | F.split(path, "/")[0].isin(*PRIVATE_ROOTS)
