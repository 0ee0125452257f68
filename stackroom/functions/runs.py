"""Scalar helpers for run reports and progress logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Other spellings of a command and the name they fold to.
COMMAND_ALIASES = {
    "verify_convert": "verify",
    "verify-convert": "verify",
    "verify-download": "verify_download",
    "validate-download": "verify_download",
    "verify-schema": "verify_schema",
    "verify_index": "verify-index",
}

# Position of a command in the usual order of work.
COMMAND_RANKS = {
    "all": 0,
    "download": 1,
    "verify_download": 2,
    "validate-download": 2,
    "verify-download": 2,
    "check": 3,
    "convert": 4,
    "verify": 5,
    "verify_convert": 5,
    "verify-convert": 5,
    "verify_schema": 6,
    "verify-schema": 6,
    "index": 7,
    "extract": 8,
    "verify-index": 9,
    "verify_index": 9,
}
UNKNOWN_RANK = 100


def _lookup(table: dict, key: Column) -> Column:
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def canonical_command(command: Column) -> Column:
    return F.coalesce(_lookup(COMMAND_ALIASES, command), command)


def command_flow_rank(command: Column) -> Column:
    return F.coalesce(_lookup(COMMAND_RANKS, command), F.lit(UNKNOWN_RANK))


def parse_counter(line: Column, field: str) -> Column:
    """Unsigned number after the first ``field=``, null when it is not one."""
    key = f"{field}="
    start = F.instr(line, key)
    rest = F.substring(line, start + len(key), F.length(line))
    digits = F.regexp_extract(rest, r"(?U)\A\s*\+?([0-9]+)(?!\S)", 1)
    return F.when((start > 0) & (digits != ""), digits.try_cast("bigint"))


def format_duration(seconds: Column) -> Column:
    """``1h02m03s``, ``2m03s`` or ``3s``, rounded, never negative."""
    total = F.when(seconds > 0, F.round(seconds).cast("bigint")).when(seconds <= 0, F.lit(0))
    hours = F.call_function("div", total, F.lit(3600))
    minutes = F.call_function("div", total % 3600, F.lit(60))
    rest = total % 60
    return (
        F.when(hours > 0, F.format_string("%dh%02dm%02ds", hours, minutes, rest))
        .when(minutes > 0, F.format_string("%dm%02ds", minutes, rest))
        .when(total >= 0, F.format_string("%ds", rest))
    )


def started_local(unix_seconds: Column, zone: str | None = None) -> Column:
    """Start time in a zone, the session's unless one is given."""
    utc = F.timestamp_add("SECOND", unix_seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    there = F.convert_timezone(F.lit("UTC"), F.lit(zone) if zone else F.current_timezone(), utc)
    return F.substring(there.cast("string"), 1, 19)


def with_headroom(size: Column, tenths: int) -> Column:
    """``size * tenths / 10`` in whole bytes, holding at the largest BIGINT."""
    product = F.coalesce(
        F.try_multiply(size, F.lit(tenths).cast("bigint")),
        F.when(size.isNotNull(), F.lit(2**63 - 1)),
    )
    return F.call_function("div", product, F.lit(10))


def whole_gib(size: Column) -> Column:
    return F.call_function("div", size, F.lit(1024**3))
