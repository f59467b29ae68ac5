"""Loader records: pages or hits as `(page_content, metadata)`."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.loader import hit_text, loader_metadata, page_text

# Metadata fields that go into loader records, in the order of the document model.
METADATA_FIELDS = (
    "title", "description", "language", "source_url", "url", "status_code", "scrape_id", "credits_used",
    "cache_state", "content_type", "favicon",
)


def _map_of(pairs: Mapping[str, Column]) -> Column:
    flat = [x for name, value in pairs.items() for x in (F.lit(name), value.cast("string"))]
    return F.create_map(*flat) if flat else F.create_map().cast("map<string,string>")


def page_records(
    docs: DataFrame, key: str = "source", user: Mapping[str, str] | None = None, allow_html: bool = True
) -> DataFrame:
    """Documents with `url, markdown, html?, metadata` as records.

    `key` names the entry that holds the URL asked for: `source` in the one loader, `url` in the other. Page
    metadata wins over it, and it wins over the user's own entries.
    """
    html = F.col("html") if allow_html and "html" in docs.columns else None
    fields = docs.schema["metadata"].dataType.names
    page = _map_of({f: F.col(f"metadata.{f}") for f in METADATA_FIELDS if f in fields})
    own = _map_of({k: F.lit(v) for k, v in (user or {}).items()})
    return docs.withColumn("page_content", page_text(F.col("markdown"), html)).withColumn(
        "metadata", loader_metadata(own, _map_of({key: F.col("url")}), page)
    )


def hit_records(hits: DataFrame, key: str = "source", user: Mapping[str, str] | None = None) -> DataFrame:
    own = _map_of({k: F.lit(v) for k, v in (user or {}).items()})
    found = _map_of({key: F.col("url"), "title": F.col("title")})
    return hits.withColumn("page_content", hit_text(F.col("title"), F.col("description"), F.col("url"))).withColumn(
        "metadata", loader_metadata(own, found)
    )


def to_loader_documents(
    df: DataFrame, mode: str = "scrape", key: str = "source", user: Mapping[str, str] | None = None
) -> DataFrame:
    """`(page_content, metadata)` of scraped documents or of search hits."""
    if mode not in ("scrape", "search"):
        raise ValueError(f"unknown mode {mode!r}")
    records = page_records(df, key, user) if mode == "scrape" else hit_records(df, key, user)
    return records.select("page_content", "metadata")


def load_documents(docs: DataFrame, hits: DataFrame, key: str = "source") -> DataFrame:
    """Both kinds as one table, marked by `mode`."""
    pages = to_loader_documents(docs, "scrape", key).withColumn("mode", F.lit("scrape"))
    found = to_loader_documents(hits, "search", key).withColumn("mode", F.lit("search"))
    return pages.unionByName(found)
