"""Content hashes, opaque references and canonical JSON envelopes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

NUL = "\x00"


@dataclass(frozen=True)
class Namespaces:
    """Prefixes that keep source references and record ids apart from other hashes."""

    source: str = "source-log-v1"
    record: str = "ledger-record-v1"


DEFAULT_NAMESPACES = Namespaces()

# Identifier shapes.
HEX64 = r"\A[0-9a-f]{64}\z"
HEX32 = r"\A[0-9a-f]{32}\z"
SLUG = r"\A[a-z0-9](?:[a-z0-9-]{0,62}[a-z0-9])?\z"
MODEL_ID = r"\A[A-Za-z0-9][A-Za-z0-9._:/-]{0,99}\z"
EFFORTS = ("low", "medium", "high", "xhigh", "max", "ultra")


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


def source_ref(source: Column, ns: Namespaces = DEFAULT_NAMESPACES) -> Column:
    """Opaque 16-digit reference that does not reveal the path."""
    return F.substring(sha256_hex(F.concat(F.lit(ns.source + NUL), source)), 1, 16)


def record_id(
    ref: Column,
    byte_start: Column,
    byte_end: Column,
    event_sha256: Column,
    ns: Namespaces = DEFAULT_NAMESPACES,
) -> Column:
    """Identity of one message: where its event lies and what its bytes are."""
    parts = [F.lit(ns.record), ref, byte_start.cast("string"), byte_end.cast("string"), event_sha256]
    return sha256_hex(F.concat_ws(NUL, *parts))


def canonical_json(fields: Mapping[str, Column]) -> Column:
    """Compact JSON object with sorted keys and explicit nulls."""
    ordered = [fields[name].alias(name) for name in sorted(fields)]
    return F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"})


def digest(fields: Mapping[str, Column]) -> Column:
    """sha256 of the canonical JSON of ``fields``."""
    return sha256_hex(canonical_json(fields))


def digest_matches(fields: Mapping[str, Column], declared: Column) -> Column:
    """Whether a declared digest is well formed and binds ``fields`` exactly."""
    return F.coalesce(declared.rlike(HEX64) & (declared == digest(fields)), F.lit(False))


def is_hex64(value: Column) -> Column:
    return F.coalesce(value.rlike(HEX64), F.lit(False))


def is_hex32(value: Column) -> Column:
    return F.coalesce(value.rlike(HEX32), F.lit(False))


def is_slug(value: Column) -> Column:
    return F.coalesce(value.rlike(SLUG), F.lit(False))


def is_model_id(value: Column) -> Column:
    return F.coalesce(value.rlike(MODEL_ID), F.lit(False))


def is_effort(value: Column) -> Column:
    return F.coalesce(value.isin(*EFFORTS), F.lit(False))


def entry_id(packet_sha256: Column, index: Column, source_ids: Column, summary: Column) -> Column:
    return digest(
        {
            "index": index,
            "packet_sha256": packet_sha256,
            "source_record_ids": source_ids,
            "summary": summary,
        }
    )


def batch_id(packet_sha256: Column, result_sha256: Column) -> Column:
    return digest({"packet_sha256": packet_sha256, "result_sha256": result_sha256})
