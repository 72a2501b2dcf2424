"""Limits that are part of the data model.

Fixed values: the defaults and ceilings below decide which rows enter a digest
or a packet and which decisions are valid, so results depend on them.
"""

from __future__ import annotations

from dataclasses import dataclass

MAX_MESSAGE_CHARS = 8_000
MIN_MESSAGE_CHARS = 64
MAX_EVENT_BYTES = 1_000_000

MAX_DAILY_ENTRIES = 40
MAX_SUMMARY_BYTES = 1_200
MAX_SOURCES_PER_OUTPUT = 12
MAX_CHANGES = 24
MAX_BODY_BYTES = 65_536
MAX_TARGETS_PER_DISPOSITION = 16
MAX_REASON_BYTES = 4_800
MAX_REASON_CHARS = 1_200
MAX_TITLE_BYTES = 1_024
MAX_TITLE_CHARS = 300
MAX_CONTEXT_DOCUMENTS = 96
MAX_CONTEXT_BYTES = 160_000
MAX_COMMITS_PER_DAY = 512
MAX_PATH_BYTES = 1_024
MAX_BATCHES_PER_RUN = 32


@dataclass(frozen=True)
class DigestBounds:
    """How many records and bytes one daily digest may hold."""

    max_records: int = 80
    max_bytes: int = 24_000
    excerpt_bytes: int = 480

    def __post_init__(self) -> None:
        if min(self.max_records, self.max_bytes, self.excerpt_bytes) < 1:
            raise ValueError("digest bounds must be positive")


@dataclass(frozen=True)
class PacketBounds:
    """How many items and bytes one packet may hold."""

    max_items: int = 60
    item_bytes: int = 1_200
    total_bytes: int = 48_000

    def __post_init__(self) -> None:
        if not 1 <= self.max_items <= 200:
            raise ValueError("max_items must be between 1 and 200")
        if not 32 <= self.item_bytes <= 8_000:
            raise ValueError("item_bytes must be between 32 and 8000")
        if not 32 <= self.total_bytes <= 160_000:
            raise ValueError("total_bytes must be between 32 and 160000")
