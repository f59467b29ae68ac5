"""Landed data as DataFrames. JSON is read as text lines and parsed to VARIANT: one bad line costs one NULL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.text import strip_space
from leafmill.functions.timing import started_at
from leafmill.operators.envelopes import (
    batch_documents, documents_from_envelopes, errors_from_bodies, extra_of, get, hits_from_envelopes, object_of,
    parse,
)
from leafmill.plans.spread import spread


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages `(page_id, url, html)`."""
    return spread(spark.read.parquet(path).select("page_id", "url", "html"))


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """A table of long texts, whatever its columns."""
    return spread(spark.read.parquet(path))


def json_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines that are not blank, parsed; the text is kept for lines that are not JSON."""
    return parse(lines.where(strip_space(F.col(col)) != ""), col)


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    return json_lines(spark.read.text(path))


def read_scrape_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Documents, one for each line; a line that is no JSON object is kept in `bad_line` and has success false."""
    bad = F.when(object_of(F.col("body")).isNull(), F.col("value"))
    return documents_from_envelopes(_read_lines(spark, path).select("body", bad.alias("bad_line")))


def read_batch_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Documents of all batches; `batch` is the batch's own id, else a hash of its text. A batch without documents, or a line
    that is no batch, keeps one row without `idx`."""
    lines = _read_lines(spark, path)
    batch = F.coalesce(F.try_variant_get("body", "$.id", "string"), F.sha2("value", 256))
    return batch_documents(lines.select(batch.alias("batch"), "body"), keep_empty=True)


def read_search_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Hits of all responses; a response without hits keeps one row without `idx`."""
    return hits_from_envelopes(_read_lines(spark, path).select("body"), keep_empty=True)


def logs_from_bodies(df: DataFrame, body: str = "body") -> DataFrame:
    """Log rows. A status that is not a number reads as NULL and is kept in `extra`."""
    v = F.col(body)
    status = F.try_variant_get(v, "$.status", "int")
    known = ("id", "started_at_ms", "duration_ms", "url", "final_outcome")
    ms = get(v, "started_at_ms", "bigint")
    return df.select(
        *[c for c in df.columns if c != body],
        F.try_variant_get(v, "$.id", "string").alias("id"),
        ms.alias("started_at_ms"),
        started_at(ms).alias("started_at"),
        get(v, "duration_ms", "int").alias("duration_ms"),
        F.try_variant_get(v, "$.url", "variant").alias("url"),
        status.alias("status"),
        get(v, "final_outcome", "string").alias("final_outcome"),
        F.when(status.isNull(), extra_of(v, known)).otherwise(extra_of(v, (*known, "status"))).alias("extra"),
    )


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return logs_from_bodies(_read_lines(spark, path).select("body"))


def read_errors(spark: SparkSession, path: str, status: int | None = None) -> DataFrame:
    """Error bodies, one per line; bodies that are not JSON count as empty. `status` is for lines without one."""
    lines = _read_lines(spark, path)
    given = F.try_variant_get("body", "$.status", "int")
    code = given if status is None else F.coalesce(given, F.lit(status))
    return errors_from_bodies(lines.select("body", code.alias("status")))


def stream_events_from_lines(lines: DataFrame, fields: Mapping[str, str] | None = None) -> DataFrame:
    """NDJSON lines to events, in batch or streaming. A line that is JSON but no object counts as a bare `page`;
    a line that is not JSON is kept in `bad_line`. `fields` names further columns, such as the request an event was
    landed for and its time, with their types."""
    fields = fields or {}
    parsed = json_lines(lines)
    v = F.col("body")
    text = lambda name: F.try_variant_get(v, f"$.{name}", "string")
    hit = "struct<url: string, title: string, description: string, position: int>"
    web = F.try_variant_get(v, "$.data.web", "array<variant>")
    return parsed.select(
        *[c for c in lines.columns if c != "value"],
        *[F.try_variant_get(v, f"$.{name}", kind).alias(name) for name, kind in fields.items()],
        F.when(object_of(v).isNotNull(), text("type")).when(v.isNotNull(), F.lit("page")).alias("type"),
        F.filter(
            F.transform(web, lambda h: F.try_variant_get(h, "$", hit)), lambda h: h.isNotNull()
        ).alias("web"),
        F.try_variant_get(v, "$.partial", "boolean").alias("partial"),
        get(v, "credits_used", "double").alias("credits_used"),
        text("id").alias("id"), text("code").alias("code"), text("message").alias("message"),
        extra_of(v, ("type", "data", "partial", "credits_used", "id", "code", "message", *fields)).alias("extra"),
        F.when(v.isNull(), F.col("value")).alias("bad_line"),
    )


def read_stream_events(spark: SparkSession, path: str, fields: Mapping[str, str] | None = None) -> DataFrame:
    return stream_events_from_lines(spark.read.text(path), fields)
