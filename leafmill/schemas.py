"""Field layouts of requests, responses, logs and events."""

from __future__ import annotations

# The vocabularies requests may use.
FORMATS = ("markdown", "html", "rawHtml", "json", "links", "images", "emails")
ENGINES = ("google", "bing", "duckduckgo")
ENTITIES = ("PERSON", "EMAIL", "PHONE", "LOCATION", "FINANCIAL", "SECRET")
REDACT_MODES = ("accurate", "aggressive", "fast")
REPLACE_STYLES = ("tag", "mask", "remove")
MAX_BATCH_URLS = 100
MAX_NUM = 100
DEFAULT_NUM = 10

ERROR = "status INT, code STRING, message STRING, retryable BOOLEAN"
