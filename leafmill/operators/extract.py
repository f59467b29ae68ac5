"""Page extraction: one column per requested format.

Everything is a projection of one page row: no shuffle, and only the formats asked for are in the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import html as H

TEXT_FORMATS = ("markdown", "html", "rawHtml", "links", "images", "emails")

# Format on the wire -> document column.
FORMAT_COLUMNS = {
    "markdown": "markdown", "html": "html", "rawHtml": "raw_html", "links": "links", "images": "images",
    "emails": "emails", "json": "json",
}


def with_clean(pages: DataFrame) -> DataFrame:
    """Add `_clean`, the cleaned HTML every other format starts from."""
    return pages.withColumn("_clean", H.clean_html(F.col("html")))


def format_column(name: str) -> Column:
    cleaned, url = F.col("_clean"), F.col("url")
    return {
        "markdown": lambda: H.markdown(cleaned),
        "html": lambda: cleaned,
        "rawHtml": lambda: F.col("html"),
        "links": lambda: H.links(cleaned, url),
        "images": lambda: H.images(cleaned, url),
        "emails": lambda: H.emails(cleaned),
    }[name]().alias(FORMAT_COLUMNS[name])


def metadata_column(source_url: Column | None = None) -> Column:
    """Page facts as a struct. `source_url` is the URL asked for, `url` the one the page was landed under."""
    cleaned, url = F.col("_clean"), F.col("url")
    return F.struct(
        H.title(cleaned).alias("title"),
        H.description(cleaned).alias("description"),
        H.language(cleaned).alias("language"),
        (source_url if source_url is not None else url).alias("source_url"),
        url.alias("url"),
        F.when(F.col("html").isNotNull(), F.lit(200)).alias("status_code"),
        H.content_type(cleaned).alias("content_type"),
        H.favicon(cleaned, url).alias("favicon"),
    ).alias("metadata")


def extract(
    pages: DataFrame, formats: Sequence[str] = ("markdown",), keep: Sequence[str] = ("page_id", "url"),
    metadata: bool = False,
) -> DataFrame:
    """The columns in `keep`, one column per format, and `metadata` if asked for. Works on streams as well."""
    unknown = [f for f in formats if f not in TEXT_FORMATS]
    if unknown:
        raise ValueError(f"formats not extracted here: {unknown}")
    extras = [metadata_column()] if metadata else []
    return with_clean(pages).select(*keep, *[format_column(f) for f in formats], *extras)


def page_metadata(pages: DataFrame) -> DataFrame:
    return with_clean(pages).select("page_id", metadata_column()).select("page_id", "metadata.*")


def long_form(df: DataFrame, col: str, value: str, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """An array column as rows, with its 0-based place."""
    return df.select(*keep, F.posexplode(col).alias("idx", value))
