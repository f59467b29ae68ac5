"""The same work on data as it arrives, with Structured Streaming.

State is kept per request or per scrape id, is bounded by a watermark, and lives under the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.operators.events import fold_columns
from leafmill.operators.extract import extract
from leafmill.sources.readers import stream_events_from_lines


def stream_events(
    spark: SparkSession, path: str, fields: Mapping[str, str] | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Events from NDJSON files as they land. A `ts` among the fields comes as a timestamp, fit for a watermark."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return stream_events_from_lines(reader.load(path), fields)


def stream_hits(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The hits of each page event, at once and without state."""
    pages = events.where(F.col("type") == "page")
    return pages.select(*keep, F.posexplode("web").alias("idx", "hit")).select(*keep, "idx", "hit.*")


def fold_stream(
    events: DataFrame, ts: str = "ts", lateness: str = "10 minutes", silence: str = "1 hour",
    order: Sequence[str] = ("ts", "event_id"),
) -> DataFrame:
    """One row per request once it has been silent for `silence`: what its events came to.

    Built on mergeable aggregates: with the session setting `merge.sessions.in.local.partition`, which `build_session`
    turns on, a busy request is combined in the tasks that read it before it meets its state. State is dropped when the
    watermark passes the end of the silence.
    """
    marked = events.withWatermark(ts, lateness)
    grouped = marked.groupBy(F.session_window(ts, silence), "request_id")
    aggregates, final = fold_columns(order)
    return grouped.agg(*aggregates).select("request_id", *final)


def stream_scrape(
    pages: DataFrame, formats: Sequence[str] = ("markdown",), keep: Sequence[str] = ("page_id", "url")
) -> DataFrame:
    """Documents of pages as they land: the batch projection, which keeps no state."""
    return extract(pages, formats, keep, metadata=True)


def stream_log_match(
    documents: DataFrame, logs: DataFrame, key: str = "scrape_id", doc_ts: str = "scraped_at", log_ts: str = "logged_at",
    bound: str = "30 seconds", lateness: str = "10 minutes",
) -> DataFrame:
    """Scraped documents with their log row, which comes some time later but within `bound`.

    Watermarks on both sides and the bound let Spark forget rows that can no longer match.
    """
    d = documents.withWatermark(doc_ts, lateness).alias("d")
    g = logs.withWatermark(log_ts, lateness).alias("g")
    in_time = (F.col(f"g.{log_ts}") >= F.col(f"d.{doc_ts}")) & (
        F.col(f"g.{log_ts}") <= F.col(f"d.{doc_ts}") + F.expr(f"interval {bound}")
    )
    joined = d.join(g, (F.col(f"d.{key}") == F.col(f"g.{key}")) & in_time)
    return joined.select("d.*", *[F.col(f"g.{c}") for c in logs.columns if c != key])


def run_available(df: DataFrame, path: str, checkpoint: str) -> None:
    """Work off what has landed and stop; results are appended to parquet files, exactly once per checkpoint."""
    (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
