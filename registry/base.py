"""Registration, and the views over the given tables in Spark and in SQL for the check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafmill.sources.readers import read_texts


class Entries:
    def __init__(self):
        self.queries, self.sql = {}, {}

    def add(self, name: str, sql: str | None = None):
        def register(fn):
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return read_texts(spark, path) if name in ("pages", "documents") else spark.read.parquet(path)


# Request table over pages: blank, padded and unknown URLs among good ones.
_SCRAPE_REQUESTS = """
select page_id as request_id,
  case when page_id % 50 = 0 then '  ' when page_id % 50 = 1 then concat(' ', url, ' ')
       when page_id % 50 = 2 then concat(url, '/missing') else url end as url,
  case page_id % 4 when 1 then 'markdown, links' when 2 then 'raw_html,emails,' when 3 then 'html,text' end
    as formats_csv,
  page_id % 3 = 0 as skip_cache,
  cast(floor(page_id / 30) as bigint) as batch_id
from {pages}
"""

_REQUEST_LOG = """
select concat('log_', event_id) as id, {ms} as started_at_ms, cast(floor(value * 10) as int) as duration_ms,
  concat('https://site', user_id % 40, '.example.com/') as url,
  case when event_type <> 'error' then 200 when event_id % 4 = 0 then 429 when event_id % 4 = 1 then 502
       when event_id % 4 = 2 then 503 else 500 end as status,
  case when event_type <> 'error' then null when event_id % 4 = 0 then 'RATE_LIMIT_EXCEEDED'
       when event_id % 4 = 3 then 'INTERNAL' end as code,
  case when event_type <> 'error' then null when event_id % 8 = 0 then false when event_id % 8 = 4 then true
  end as retryable,
  case when event_type in ('purchase', 'signup') then 'search' else 'scrape' end as kind,
  cast(10 * (1 + event_id % 5) + event_id % 3 as int) as num, event_id % 7 = 0 as skip_cache, event_id, user_id
from {events}
"""

_SEARCH_QUERIES = """
select item_id as query_id, case when item_id % 20 = 0 then '  ' else text end as q,
  case item_id % 3 when 0 then 'google' when 1 then 'bing' else 'duckduckgo' end as engine,
  cast(5 + (item_id % 3) * 5 as int) as num, cast((item_id % 2) * 5 as int) as start
from {benchmark}
"""

# A user's events are cut into requests after each terminal event; `request_id` comes from sessions.
_STREAM_EVENTS = """
select event_id, ts, user_id,
  case when event_type in ('view', 'click') then 'page' when event_type = 'error' then 'error' else 'done' end
    as type,
  case when event_type in ('view', 'click') then concat('https://h', event_id, '.example.com/') end as hit_url,
  case when event_type in ('purchase', 'signup') then cast(1 + event_id % 3 as double) end as credits_used,
  case when event_type = 'error' then 'SEARCH_FAILED' end as code
from {events}
"""

_SESSIONS_SQL = """
select *, concat(user_id, '-', session) as request_id from (
  select *, cast(coalesce(sum(case when type in ('done', 'error') then 1 else 0 end)
    over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding), 0) as bigint)
    as session
  from stream_events)
"""


def scrape_requests(spark, sf_dir):
    return spark.sql(_SCRAPE_REQUESTS.format(pages="{pages}"), pages=table(spark, sf_dir, "pages"))


def request_log(spark, sf_dir):
    text = _REQUEST_LOG.format(ms="unix_millis(cast(ts as timestamp))", events="{events}")
    return spark.sql(text, events=table(spark, sf_dir, "events"))


def search_queries(spark, sf_dir):
    return spark.sql(_SEARCH_QUERIES, benchmark=table(spark, sf_dir, "benchmark"))


def stream_events(spark, sf_dir):
    return spark.sql(_STREAM_EVENTS, events=table(spark, sf_dir, "events"))


def with_views(body: str, *names: str) -> str:
    """SQL text for the check with the named views in front."""
    views = {
        "scrape_requests": _SCRAPE_REQUESTS.format(pages="pages"),
        "request_log": _REQUEST_LOG.format(ms="epoch_us(ts) // 1000", events="events"),
        "search_queries": _SEARCH_QUERIES.format(benchmark="benchmark"),
        "stream_events": _STREAM_EVENTS.format(events="events"),
        "session_events": _SESSIONS_SQL,
    }
    head = ", ".join(f"{n} as ({views[n]})" for n in names)
    body = body.strip()
    if body.startswith("with "):
        return f"with {head}, {body[5:]}"
    return f"with {head} {body}"
