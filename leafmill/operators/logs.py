"""Request logs: lookups, cache accounting and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.errors import is_retryable
from leafmill.plans.skew import salted_join


def get_logs(ids: DataFrame, logs: DataFrame, heavy: dict | None = None) -> DataFrame:
    """The log row of each id; a miss carries a 404 error. An id that is asked for very often is salted."""
    hit = logs.withColumn("_hit", F.lit(True))
    spread = [c for c in ids.columns if c != "id"] or ["id"]
    out = salted_join(ids, hit, "id", "left", spread, heavy)
    missing = F.col("_hit").isNull()
    error = F.struct(
        F.lit(404).alias("status"), F.lit("NOT_FOUND").alias("code"), F.lit("log not found").alias("message"),
        F.lit(False).alias("retryable"),
    )
    return out.withColumn("error", F.when(missing, error)).drop("_hit")


def get_log_results(ids: DataFrame, logs: DataFrame, documents: DataFrame, heavy: dict | None = None) -> DataFrame:
    """The stored body of each past request: ids that are logged and have a document. `documents` is keyed by `id`."""
    spread = [c for c in ids.columns if c != "id"] or ["id"]
    stored = documents.join(logs.select("id"), "id", "left_semi")
    return salted_join(ids, stored, "id", "inner", spread, heavy)


def missing_logs(documents: DataFrame, logs: DataFrame, id_col: str = "id") -> DataFrame:
    """Documents whose log has not come in yet."""
    return documents.join(logs.select(F.col("id").alias(id_col)), id_col, "left_anti")


def cache_state(
    requests: DataFrame, ok: Column, order: tuple[str, str] = ("started_at_ms", "id"), heavy: dict | None = None
) -> DataFrame:
    """Add `cache_state`: hit if the same URL was fetched with success before and `skip_cache` is not set.

    "Some earlier success" is the same as "later than the first success", so the URL's history is one small
    aggregate (merged before the shuffle) and no window over a hot URL is needed.
    """
    at = F.struct(*order)
    first_ok = requests.where(ok).groupBy("url").agg(F.min(at).alias("_first_ok"))
    out = salted_join(requests, first_ok, "url", "left", [order[1]], heavy)
    seen = F.coalesce(at > F.col("_first_ok"), F.lit(False))
    fresh = F.coalesce(F.col("skip_cache"), F.lit(False))
    return out.withColumn("cache_state", F.when(seen & ~fresh, "hit").otherwise("miss")).drop("_first_ok")


def final_attempts(attempts: DataFrame, max_retries: int = 2) -> DataFrame:
    """The last attempt each request takes: at most `max_retries + 1`, ending at a success or a fatal error.

    Input `(request_id, attempt, status, code, retryable)`, attempts counted from 0. The stop is a minimum and the
    rest a maximum per request; both merge before the shuffle, so a request with very many rows costs no more.
    """
    success = F.col("status").between(200, 299)
    stop = success | ~is_retryable(F.col("status"), F.col("retryable"))
    row = F.struct("attempt", "status", "code", "retryable")
    taken = attempts.where(F.col("attempt") <= max_retries)
    per_place = [F.count(F.when(F.col("attempt") == i, 1)).alias(f"_n{i}") for i in range(max_retries + 1)]
    ends = taken.groupBy("request_id").agg(
        F.min(F.when(stop, row)).alias("_stop"), F.max(row).alias("_last"), *per_place
    )
    final = F.coalesce(F.col("_stop"), F.col("_last"))
    used = sum(
        (F.when(F.lit(i) <= F.col("_final.attempt"), F.col(f"_n{i}")).otherwise(0) for i in range(max_retries + 1)),
        F.lit(0),
    )
    return ends.withColumn("_final", final).select(
        "request_id", "_final.attempt", "_final.status", "_final.code",
        F.col("_final.status").between(200, 299).alias("success"), used.cast("bigint").alias("attempts"),
    )


def run_summary(log: DataFrame, by: str, exact: bool = False) -> DataFrame:
    """Passed and failed counts with elapsed time per step.

    The median is a mergeable sketch by default. `exact` keeps a value histogram per group instead, which is meant
    for integer durations of modest range.
    """
    ok = F.col("status").between(200, 299)
    median = F.percentile("duration_ms", 0.5) if exact else F.percentile_approx("duration_ms", 0.5)
    return log.groupBy(by).agg(
        F.count(F.when(ok, 1)).alias("passed"),
        F.count(F.when(~ok, 1)).alias("failed"),
        F.sum("duration_ms").alias("total_ms"),
        F.round(F.avg("duration_ms"), 3).alias("avg_ms"),
        median.cast("double").alias("median_ms"),
    )


def error_summary(log: DataFrame) -> DataFrame:
    """Failed requests by status, code and whether a retry would have been made."""
    failed = log.where(~F.col("status").between(200, 299))
    retry = is_retryable(F.col("status"), F.col("retryable"))
    return failed.groupBy("status", "code", retry.alias("retryable")).agg(F.count(F.lit(1)).alias("n"))


