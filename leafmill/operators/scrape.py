"""Requests in, documents out, over landed pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.operators.extract import FORMAT_COLUMNS, TEXT_FORMATS, format_column, metadata_column, with_clean
from leafmill.operators.nodes import extract_fields, fields_json
from leafmill.plans.skew import salted_join

PAGE_NOT_FOUND = "page not found"


def select_formats(docs: DataFrame, formats: Sequence[str] | str) -> DataFrame:
    """Only the requested formats come back.

    A list drops the other columns, so Catalyst prunes their extraction. The name of an array column blanks them row
    by row instead.
    """
    if isinstance(formats, str):
        blanked = {
            col: F.when(F.array_contains(F.col(formats), name), F.col(col))
            for name, col in FORMAT_COLUMNS.items()
            if col in docs.columns
        }
        return docs.withColumns(blanked)
    unwanted = [c for f, c in FORMAT_COLUMNS.items() if f not in formats and c in docs.columns]
    return docs.drop(*unwanted)


def current_pages(pages: DataFrame) -> DataFrame:
    """`(url, page_id)` of the page that stands for each URL: the one landed last, by the highest page_id.

    Only the two keys are shuffled, and copies of one URL are reduced before the shuffle.
    """
    return pages.groupBy("url").agg(F.max("page_id").alias("page_id"))


def scrape(
    requests: DataFrame,
    pages: DataFrame,
    rules: Mapping[str, str | Mapping] | None = None,
    heavy: dict | None = None,
) -> DataFrame:
    """One document per row of `requests (request_id, url, formats[, error])`.

    Each page that is asked for is extracted once, however many requests name it, and only into the formats that
    some request wants. Requests meet their document on the URL; a URL that a large share of the requests name is
    salted.
    """
    if "error" not in requests.columns:
        requests = requests.withColumn("error", F.lit(None).cast("struct<message: string>"))
    wants = {f"_want_{f}": F.max(F.array_contains("formats", f)) for f in FORMAT_COLUMNS}
    wanted = requests.where(F.col("error").isNull()).groupBy("url").agg(*[w.alias(n) for n, w in wants.items()])
    targets = current_pages(pages).join(wanted, "url").drop("url")
    found = pages.join(targets, "page_id")

    texts = [F.when(F.col(f"_want_{f}"), format_column(f)).alias(FORMAT_COLUMNS[f]) for f in TEXT_FORMATS]
    docs = with_clean(found).select("page_id", "url", *texts, metadata_column())
    if rules:
        json = fields_json(extract_fields(found.where("_want_json"), rules), rules)
        docs = docs.join(json, "page_id", "left")
    else:
        docs = docs.withColumn("json", F.lit(None).cast("string"))
    docs = docs.drop("page_id").withColumn("_found", F.lit(True))

    out = salted_join(requests, docs, "url", "left", ["request_id"], heavy)
    ok = F.col("error").isNull() & F.col("_found").isNotNull()
    metadata = F.col("metadata").withField("scrape_id", F.col("request_id").cast("string")).withField(
        "credits_used", F.lit(1.0)
    )
    shown = {c: F.when(ok & F.array_contains("formats", f), F.col(c)) for f, c in FORMAT_COLUMNS.items()}
    return out.select(
        "request_id",
        F.col("url"),
        ok.alias("success"),
        *[v.alias(c) for c, v in shown.items()],
        F.when(ok, metadata).alias("metadata"),
        F.when(~ok, F.coalesce(F.col("error.message"), F.lit(PAGE_NOT_FOUND))).alias("error"),
    )


def scrape_get(urls: DataFrame, pages: DataFrame, heavy: dict | None = None) -> DataFrame:
    """Markdown-only scrape of `(request_id, url[, error])`."""
    return scrape(urls.withColumn("formats", F.array(F.lit("markdown"))), pages, heavy=heavy).select(
        "request_id", "url", "success", "markdown", "metadata", "error"
    )
