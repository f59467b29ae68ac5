"""Request tables: validation, defaults, wire bodies and batching.

A bad row is marked in an `error` struct and kept; nothing raises on data. Split with `valid` and `rejected`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.text import strip_space
from leafmill.plans.scan import running_sum
from leafmill.schemas import DEFAULT_NUM, ENGINES, ERROR, FORMATS, MAX_BATCH_URLS, MAX_NUM

_ERROR_TYPE = "struct<" + ", ".join(f"{p.split()[0]}: {p.split()[1]}" for p in ERROR.split(", ")) + ">"


def invalid(message: str, code: str = "INVALID_REQUEST") -> Column:
    return F.struct(
        F.lit(400).alias("status"), F.lit(code).alias("code"), F.lit(message).alias("message"),
        F.lit(False).alias("retryable"),
    ).cast(_ERROR_TYPE)


def _add_error(df: DataFrame, bad: Column, error: Column) -> DataFrame:
    """Record `error` where `bad` holds; the first error found on a row stands."""
    found = F.when(bad, error)
    if "error" in df.columns:
        found = F.coalesce(F.col("error"), found)
    return df.withColumn("error", found)


def valid(df: DataFrame) -> DataFrame:
    return df.where(F.col("error").isNull())


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col("error").isNotNull())


def require_url(df: DataFrame, col: str = "url") -> DataFrame:
    """Strip the URL; missing or blank is an error."""
    df = df.withColumn(col, strip_space(F.coalesce(F.col(col), F.lit(""))))
    return _add_error(df, F.col(col) == "", invalid("url is required"))


def require_query(df: DataFrame, col: str = "q") -> DataFrame:
    df = df.withColumn(col, strip_space(F.coalesce(F.col(col), F.lit(""))))
    return _add_error(df, F.col(col) == "", invalid("q is required"))


def validate_batches(df: DataFrame, urls: str = "urls") -> DataFrame:
    """Check an array-of-URLs column: not empty, at most 100, and every URL given. URLs come back stripped."""
    stripped = F.transform(F.col(urls), lambda u: strip_space(F.coalesce(u, F.lit(""))))
    df = df.withColumn(urls, stripped)
    size = F.coalesce(F.size(urls), F.lit(0))
    error = (
        F.when(size == 0, invalid("urls must be a non-empty array"))
        .when(size > MAX_BATCH_URLS, invalid(f"batch supports at most {MAX_BATCH_URLS} URLs"))
        .when(F.array_contains(F.col(urls), ""), invalid("url is required"))
    )
    return _add_error(df, error.isNotNull(), error)


def default_formats(df: DataFrame, col: str = "formats") -> DataFrame:
    """A missing list means markdown; an explicit empty list is kept."""
    return df.withColumn(col, F.coalesce(F.col(col), F.array(F.lit("markdown"))))


def wire_formats(df: DataFrame, col: str = "formats") -> DataFrame:
    """`raw_html` is written `rawHtml`; order and repeats stay."""
    return df.withColumn(
        col, F.transform(F.col(col), lambda f: F.when(f == "raw_html", F.lit("rawHtml")).otherwise(f))
    )


def split_formats(df: DataFrame, csv: str = "formats_csv", out: str = "formats", drop_empty: bool = True) -> DataFrame:
    """Comma list to array. With `drop_empty` blank items vanish; without it they stay and no text means markdown."""
    items = F.transform(F.split(F.col(csv), ",", -1), strip_space)
    if drop_empty:
        return df.withColumn(out, F.filter(items, lambda f: f != ""))
    no_text = F.coalesce(F.col(csv), F.lit("")) == ""
    return df.withColumn(out, F.when(no_text, F.array(F.lit("markdown"))).otherwise(items))


def check_formats(df: DataFrame, col: str = "formats") -> DataFrame:
    """Every format must be one of the seven on the wire (`text` was withdrawn); a null entry is none of them."""
    known = F.forall(F.col(col), lambda f: F.coalesce(f.isin(*FORMATS), F.lit(False)))
    return _add_error(df, ~F.coalesce(known, F.lit(True)), invalid("format is not available", "FORMAT_UNAVAILABLE"))


def check_engine(df: DataFrame, col: str = "engine", default: str = "google") -> DataFrame:
    df = df.withColumn(col, F.coalesce(F.nullif(F.col(col), F.lit("")), F.lit(default)))
    return _add_error(df, ~F.col(col).isin(*ENGINES), invalid("engine must be google, bing or duckduckgo"))


def check_num(df: DataFrame, col: str = "num", default: int = DEFAULT_NUM) -> DataFrame:
    """Missing means the default. Anything but a whole number from 1 to MAX_NUM is an error, and null if no INT holds it."""
    given = F.coalesce(F.col(col).cast("string"), F.lit(str(default))).try_cast("double")
    whole = F.coalesce((F.floor(given) == given) & (F.abs(given) < 2**31), F.lit(False))
    df = df.withColumn(col, F.when(whole, given).try_cast("int"))
    bad = ~F.coalesce(F.col(col).between(1, MAX_NUM), F.lit(False))
    return _add_error(df, bad, invalid(f"num must be between 1 and {MAX_NUM}"))


def check_url_syntax(df: DataFrame, col: str = "url") -> DataFrame:
    ok = F.coalesce(F.col(col).rlike(r"^https?://[^/?#\s]+"), F.lit(False))
    return _add_error(df, ~ok, invalid("url must be fully qualified"))


# Option column -> name on the wire.
_SCRAPE_OPTIONS = {
    "skip_cache": "skipCache",
    "zdr": "zdr",
    "timeout": "timeout",
    "json_options": "jsonOptions",
    "country": "country",
    "language": "language",
    "location": "location",
    "redact_pii": "redactPII",
}
_SEARCH_OPTIONS = ("engine", "num", "start", "country", "language")


def _options(df: DataFrame, names: dict[str, str], leave_out: Sequence[str] = ()) -> list[Column]:
    return [F.col(c).alias(wire) for c, wire in names.items() if c in df.columns and c not in leave_out]


def build_scrape_requests(df: DataFrame, out: str = "body") -> DataFrame:
    """JSON body per row: url, formats, then the options that are set. `extract_main_content` is accepted and dropped."""
    if "formats" not in df.columns:
        df = df.withColumn("formats", F.lit(None).cast("array<string>"))
    df = wire_formats(default_formats(df))
    body = F.to_json(F.struct(F.col("url"), F.col("formats"), *_options(df, _SCRAPE_OPTIONS)))
    return df.withColumn(out, body)


def build_batch_requests(df: DataFrame, out: str = "body") -> DataFrame:
    """As for one URL, with `urls[]`; selector options do not go with a batch."""
    if "formats" not in df.columns:
        df = df.withColumn("formats", F.lit(None).cast("array<string>"))
    df = wire_formats(default_formats(df))
    options = _options(df, _SCRAPE_OPTIONS, leave_out=("json_options",))
    return df.withColumn(out, F.to_json(F.struct(F.col("urls"), F.col("formats"), *options)))


def build_search_requests(df: DataFrame, out: str = "body") -> DataFrame:
    options = [F.col(c) for c in _SEARCH_OPTIONS if c in df.columns]
    return df.withColumn(out, F.to_json(F.struct(F.col("q"), *options)))


def chunk_batches(
    df: DataFrame, job: str, seq: str, n: int = MAX_BATCH_URLS, heavy: dict | None = None
) -> DataFrame:
    """Number the URLs of each job in `seq` order and cut them into chunks of at most `n`.

    Adds `chunk` and `idx` (both 0-based). `seq` must be unique within the job. A job that holds a large share of
    the rows is spread over many tasks (see `running_sum`).
    """
    numbered = running_sum(df, job, [seq], F.lit(1), "_place", heavy=heavy)
    place = F.col("_place") - 1
    return numbered.withColumn("chunk", F.floor(place / n)).withColumn("idx", F.pmod(place, F.lit(n))).drop("_place")


def collect_batches(df: DataFrame, job: str, url: str = "url") -> DataFrame:
    """Chunked rows to one row per batch with its `urls` in order; a group holds one batch, so at most `n` URLs."""
    return (
        df.groupBy(job, "chunk")
        .agg(F.sort_array(F.collect_list(F.struct("idx", F.col(url).alias("url")))).alias("_urls"))
        .select(job, "chunk", F.col("_urls.url").alias("urls"))
    )
