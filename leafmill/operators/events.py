"""Search stream events held in a table: which request an event belongs to, and what a request came to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.plans.scan import running_sum

TERMINAL = ("done", "error")


def sessionise(
    events: DataFrame, key: str, order: Sequence[str] = ("ts", "event_id"), heavy: dict | None = None
) -> DataFrame:
    """Add `session`: the number of `done`/`error` events of the same key that came earlier."""
    ended = F.when(F.col("type").isin(*TERMINAL), 1).otherwise(0)
    return running_sum(events, key, list(order), ended, "session", inclusive=False, heavy=heavy)


def fold_columns(order: Sequence[str]) -> tuple[list[Column], list[Column]]:
    """Aggregates of a request's events, and the result columns made from them."""
    at = F.struct(*order)
    row = F.struct(at.alias("at"), "type", "partial", "credits_used", "id", "code", "message")
    is_page = F.col("type") == "page"
    hits = F.when(is_page, F.coalesce(F.size("web"), F.lit(0))).otherwise(0)
    aggregates = [
        F.count(F.when(is_page, 1)).alias("pages"),
        F.sum(hits).cast("bigint").alias("hits"),
        F.min(F.when(F.col("type").isin(*TERMINAL), row)).alias("_end"),
    ]
    final = [F.col("pages"), F.col("hits"), F.coalesce(F.col("_end.type"), F.lit("open")).alias("outcome")]
    final += [F.col(f"_end.{c}").alias(c) for c in ("partial", "credits_used", "id", "code", "message")]
    return aggregates, final


def fold_events(events: DataFrame, order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """One row per request: pages and hits seen, and what `done` or `error` said.

    Counts, and the terminal event as a minimum in event order: all merge before the shuffle, so one request with
    very many events is no burden. The hits themselves stay rows (`folded_hits`).
    """
    aggregates, final = fold_columns(order)
    return events.groupBy("request_id").agg(*aggregates).select("request_id", *final)


def folded_hits(
    events: DataFrame, order: Sequence[str] = ("ts", "event_id"), heavy: dict | None = None
) -> DataFrame:
    """The hits of each request in order, numbered from 1 across its page events."""
    pages = events.where(F.col("type") == "page").withColumn("_size", F.coalesce(F.size("web"), F.lit(0)))
    numbered = running_sum(pages, "request_id", list(order), F.col("_size"), "_before", inclusive=False, heavy=heavy)
    rows = numbered.select("request_id", "_before", F.posexplode("web").alias("_i", "hit"))
    return rows.select("request_id", (F.col("_before") + F.col("_i") + 1).alias("position"), "hit.*")
