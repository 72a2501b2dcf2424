"""Conversation-log ledger, packets and documents as Spark DataFrame operations."""

from pyspark import cloudpickle

from ledgerloom.functions import text
from ledgerloom.sources import byte_ranges
from ledgerloom.streaming import log_stream

# Task-side helpers travel with the job, so executors need no copy of this package.
for _module in (text, byte_ranges, log_stream):
    cloudpickle.register_pickle_by_value(_module)
