"""Readers, writers and adapters."""

from blotter.sources.incidents import (
    clean_incidents,
    read_clean_incidents,
    read_incidents,
    store_clean_incidents,
)
from blotter.sources.calls import parse_calls, read_call_lines, read_call_records
from blotter.sources.sinks import write_lines, write_result
from blotter.sources import tables

__all__ = [
    "clean_incidents",
    "read_incidents",
    "read_clean_incidents",
    "store_clean_incidents",
    "parse_calls",
    "read_call_lines",
    "read_call_records",
    "write_lines",
    "write_result",
    "tables",
]
