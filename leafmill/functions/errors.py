"""Error bodies and retry rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.text import blank_to_null

# Fixed values of the retry contract.
RETRY_STATUSES = (502, 503, 504)
MAX_RETRIES = 2
BASE_BACKOFF_MS = 200


def error_message(message: Column, title: Column, status: Column) -> Column:
    """The message, else the title, else a default that names the status."""
    default = F.concat(F.lit("request failed ("), status.cast("string"), F.lit(")"))
    return F.coalesce(blank_to_null(message), blank_to_null(title), default)


def is_retryable(status: Column, flag: Column) -> Column:
    """An explicit flag wins; without one the gateway statuses are retried."""
    return F.coalesce(flag, F.coalesce(status.isin(*RETRY_STATUSES), F.lit(False)))


def backoff_ms(attempt: Column, base: int = BASE_BACKOFF_MS) -> Column:
    """Delay after 0-based attempt i: base * 2^i milliseconds; from i = 40 on it grows no more, so nothing overflows."""
    return F.lit(base).cast("bigint") * F.pow(F.lit(2.0), F.least(attempt, F.lit(40))).cast("bigint")


def retry_schedule(max_retries: int = MAX_RETRIES, base: int = BASE_BACKOFF_MS) -> Column:
    """All delays of a request that never succeeds; there is none after the last attempt."""
    if max_retries < 1:
        return F.array().cast("array<bigint>")
    return F.transform(F.sequence(F.lit(0), F.lit(max_retries - 1)), lambda i: backoff_ms(i, base))
