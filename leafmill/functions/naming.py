"""Key naming: camelCase on the wire, snake_case in tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# API keys with a set snake_case name.
KNOWN_KEYS = {
    "sourceURL": "source_url",
    "statusCode": "status_code",
    "scrapeId": "scrape_id",
    "creditsUsed": "credits_used",
    "cacheState": "cache_state",
    "rawHtml": "raw_html",
    "extractMainContent": "extract_main_content",
    "skipCache": "skip_cache",
    "jsonOptions": "json_options",
}

# Possessive loops: Java then matches long strings without recursing.
_JSON_TOKEN = r'(?s)("(?:[^"\\]++|\\.)*+":?|[^"]+)'


def camel_to_snake(c: Column) -> Column:
    """`redactPII` -> `redact_pii`; known keys by table; names already in snake case stay as they are."""
    known = F.create_map(*[F.lit(x) for pair in KNOWN_KEYS.items() for x in pair])
    split_words = F.regexp_replace(c, r"(.)([A-Z][a-z]+)", "$1_$2")
    converted = F.lower(F.regexp_replace(split_words, r"([a-z0-9])([A-Z])", "$1_$2"))
    is_snake = c.contains("_") & (F.lower(c) == c)
    return F.coalesce(F.try_element_at(known, c), F.when(is_snake, c).otherwise(converted))


def snake_to_camel(c: Column) -> Column:
    """`max_retries` -> `maxRetries`; each later part is title-cased, so letters after digits are capital too."""
    parts = F.split(c, "_", -1)
    titled = F.transform(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts), F.lit(1))),
        lambda p: F.array_join(
            F.transform(F.regexp_extract_all(p, F.lit(r"(\p{L}+|\P{L}+)"), 1), lambda run: F.initcap(run)), ""
        ),
    )
    return F.concat(parts[0], F.array_join(titled, ""))


def snake_json_keys(json_text: Column) -> Column:
    """Rename every object key of compact JSON text, at any depth, through lists.

    String literals are taken whole, so only a literal followed by a colon is a key. Use `to_json` on a parsed
    value to get compact text.
    """

    def rename(token: Column) -> Column:
        is_key = token.startswith('"') & token.endswith('":')
        name = F.substring(token, F.lit(2), F.length(token) - 3)
        return F.when(is_key, F.concat(F.lit('"'), camel_to_snake(name), F.lit('":'))).otherwise(token)

    tokens = F.regexp_extract_all(json_text, F.lit(_JSON_TOKEN), 1)
    return F.array_join(F.transform(tokens, rename), "")
