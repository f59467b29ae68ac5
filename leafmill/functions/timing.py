"""Log times: epoch milliseconds and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def started_at(started_at_ms: Column) -> Column:
    return F.timestamp_millis(started_at_ms)


def ended_at(started_at_ms: Column, duration_ms: Column) -> Column:
    return F.timestamp_millis(started_at_ms + duration_ms)


def epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))
