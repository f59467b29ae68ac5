"""Column functions. All are built from Spark's own expressions, so they stay in the JVM."""

from leafmill.functions.errors import backoff_ms, error_message, is_retryable, retry_schedule
from leafmill.functions.loader import hit_text, loader_metadata, page_text
from leafmill.functions.naming import camel_to_snake, snake_to_camel, snake_json_keys
from leafmill.functions.text import collapse_space, decode_entities, preview, strip_space
from leafmill.functions.timing import ended_at, epoch_ms, started_at
from leafmill.functions.urls import percent_encode, resolve_url

__all__ = [
    "backoff_ms", "camel_to_snake", "collapse_space", "decode_entities", "ended_at", "epoch_ms",
    "error_message", "hit_text", "is_retryable", "loader_metadata", "page_text", "percent_encode",
    "preview", "resolve_url", "retry_schedule", "snake_json_keys", "snake_to_camel", "started_at",
    "strip_space",
]
