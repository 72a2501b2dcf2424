"""All registered queries."""

from ledgerloom.plans import (
    daily_queries,
    decision_queries,
    document_queries,
    ingest_queries,
    packet_queries,
    state_queries,
    text_queries,
)
from ledgerloom.plans.registry import ORACLES, QUERIES

MODULES = (
    daily_queries,
    decision_queries,
    document_queries,
    ingest_queries,
    packet_queries,
    state_queries,
    text_queries,
)

__all__ = ["MODULES", "ORACLES", "QUERIES"]
