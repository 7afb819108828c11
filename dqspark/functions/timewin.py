"""Tumbling-window start computed arithmetically.

Spark's ``window()`` adds an ``isnotnull(time)`` filter to the whole query,
which would drop records with a missing time from the assessment.  Batch
plans use this expression instead (NULL time -> NULL window, row kept);
streaming plans keep ``window()`` because the watermark needs it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}


def duration_micros(text: str) -> int:
    """'5 minutes' / '1 day' / '90 seconds' -> microseconds (sum of parts)."""
    parts = re.findall(r"(\d+)\s*([a-zA-Z]+)", text)
    if not parts:
        raise ValueError(f"cannot parse duration {text!r}")
    total = 0
    for n, unit in parts:
        u = unit.lower().rstrip("s")
        if u not in _UNIT_MICROS:
            raise ValueError(f"unknown unit {unit!r} in {text!r}")
        total += int(n) * _UNIT_MICROS[u]
    return total


def window_start(ts: Column, duration: str) -> Column:
    """Start of the epoch-aligned tumbling window holding ``ts`` (NULL-safe)."""
    d = F.lit(duration_micros(duration))
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, d))


def window_end(ts: Column, duration: str) -> Column:
    d = F.lit(duration_micros(duration))
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, d) + d)
