"""Logs, retries, credits and event streams held in tables (J, A, W03-W05, U02)."""

from pyspark.sql import functions as F

from leafmill.operators import credits as C
from leafmill.operators import events as V
from leafmill.operators import logs as G
from registry.base import Entries, request_log, stream_events, table, with_views

ENTRIES = Entries()
add = ENTRIES.add

_ASKED = "select event_id as ask_id, concat('log_', event_id + case when event_id % 9 = 0 then 1000000000 else 0 end) as id from {events}"


def _asked(spark, d):
    return spark.sql(_ASKED, events=table(spark, d, "events"))


@add(
    "j01_get_logs",
    with_views(
        f"""select a.ask_id, a.id, l.started_at_ms, l.status, case when l.id is null then 404 end as error_status
        from ({_ASKED.format(events='events')}) a left join request_log l on l.id = a.id""",
        "request_log",
    ),
)
def j01(spark, d):
    found = G.get_logs(_asked(spark, d), request_log(spark, d).select("id", "started_at_ms", "status"))
    return found.select("ask_id", "id", "started_at_ms", "status", F.col("error.status").alias("error_status"))


def _documents(spark, d):
    """Stored bodies: documents under the log id of the same number, a third without a log."""
    docs = table(spark, d, "documents")
    shift = F.when(F.col("doc_id") % 3 == 0, 1_000_000_000).otherwise(0)
    return docs.select(F.concat(F.lit("log_"), (F.col("doc_id") + shift).cast("string")).alias("id"), "text", "lang")


_DOCS_SQL = "select concat('log_', doc_id + case when doc_id % 3 = 0 then 1000000000 else 0 end) as id, text, lang from documents"


@add(
    "j02_get_log_results",
    with_views(
        f"""select a.ask_id, a.id, d.lang, md5(d.text) as text_md5 from ({_ASKED.format(events='events')}) a
        join ({_DOCS_SQL}) d on d.id = a.id where d.id in (select id from request_log)""",
        "request_log",
    ),
)
def j02(spark, d):
    found = G.get_log_results(_asked(spark, d), request_log(spark, d), _documents(spark, d))
    return found.select("ask_id", "id", "lang", F.md5("text").alias("text_md5"))


@add(
    "j04_missing_logs",
    with_views(f"select id, lang from ({_DOCS_SQL}) where id not in (select id from request_log)", "request_log"),
)
def j04(spark, d):
    return G.missing_logs(_documents(spark, d), request_log(spark, d)).select("id", "lang")


@add(
    "a02_scrape_credits",
    with_views(
        """select url, count(*) as pages, cast(count(*) as bigint) as credits from request_log
        where kind = 'scrape' and status between 200 and 299 group by url""",
        "request_log",
    ),
)
def a02(spark, d):
    return C.scrape_credits(request_log(spark, d).where("kind = 'scrape'"), ["url"])


@add(
    "a03_search_credits",
    with_views(
        """select url, count(*) as searches, cast(sum(ceil(num / 10.0)) as bigint) as credits from request_log
        where kind = 'search' group by url""",
        "request_log",
    ),
)
def a03(spark, d):
    return C.search_credits(request_log(spark, d).where("kind = 'search'"), ["url"])


_LEDGER_SQL = """
select 'scrape' as kind, id, cast(started_at_ms // 86400000 as bigint) as day, cast(1 as bigint) as credits
  from request_log where kind = 'scrape' and status = 200
union all select 'search', id, cast(started_at_ms // 86400000 as bigint), cast(ceil(num / 10.0) as bigint)
  from request_log where kind = 'search'"""


def _ledger(spark, d):
    log = request_log(spark, d).withColumn("day", F.floor(F.col("started_at_ms") / 86_400_000))
    return C.ledger(log.where("kind = 'scrape' and status = 200"), log.where("kind = 'search'"), ["id", "day"])


@add("u02_ledger_union", with_views(_LEDGER_SQL, "request_log"))
def u02(spark, d):
    return _ledger(spark, d)


@add(
    "a04_credit_ledger",
    with_views(
        f"""select kind, day, grouping(kind, day) as level, count(*) as requests, cast(sum(credits) as bigint) as credits
        from ({_LEDGER_SQL}) group by rollup (kind, day)""",
        "request_log",
    ),
)
def a04(spark, d):
    return C.credit_ledger(_ledger(spark, d), ["kind", "day"])


@add(
    "a05_run_summary",
    with_views(
        """select kind, count(case when status between 200 and 299 then 1 end) as passed,
        count(case when status not between 200 and 299 then 1 end) as failed, cast(sum(duration_ms) as bigint) as total_ms,
        round(avg(duration_ms), 3) as avg_ms, cast(quantile_cont(duration_ms, 0.5) as double) as median_ms
        from request_log group by kind""",
        "request_log",
    ),
)
def a05(spark, d):
    return G.run_summary(request_log(spark, d), "kind", exact=True)


@add(
    "a06_error_summary",
    with_views(
        """select status, code, coalesce(retryable, status in (502, 503, 504)) as retryable, count(*) as n
        from request_log where status not between 200 and 299 group by all""",
        "request_log",
    ),
)
def a06(spark, d):
    return G.error_summary(request_log(spark, d))


_ATTEMPTS = """select cast(floor(event_id / 4) as bigint) as request_id, cast(event_id % 4 as int) as attempt, status, code,
  retryable from request_log"""


@add(
    "w03_final_attempt",
    with_views(
        f"""with a as ({_ATTEMPTS}), t as (select *, status between 200 and 299
            or not coalesce(retryable, status in (502, 503, 504)) as stop from a where attempt <= 2),
        taken as (select *, coalesce(max(stop::int) over (partition by request_id order by attempt
            rows between unbounded preceding and 1 preceding), 0) as over from t),
        kept as (select * from taken where over = 0),
        ranked as (select *, row_number() over (partition by request_id order by attempt desc) as rn,
            count(*) over (partition by request_id) as attempts from kept)
        select request_id, attempt, status, code, status between 200 and 299 as success, attempts from ranked where rn = 1""",
        "request_log",
    ),
)
def w03(spark, d):
    log = request_log(spark, d)
    attempts = log.select(
        F.floor(F.col("event_id") / 4).alias("request_id"), (F.col("event_id") % 4).cast("int").alias("attempt"),
        "status", "code", "retryable",
    )
    return G.final_attempts(attempts)


@add(
    "w04_cache_state",
    with_views(
        """select id, url, case when not skip_cache and coalesce(max((status = 200)::int) over (partition by url
          order by started_at_ms, id rows between unbounded preceding and 1 preceding), 0) = 1
          then 'hit' else 'miss' end as cache_state from request_log""",
        "request_log",
    ),
)
def w04(spark, d):
    out = G.cache_state(request_log(spark, d), F.col("status") == 200)
    return out.select("id", "url", "cache_state")


@add(
    "w05_sessionise_events",
    with_views("select event_id, user_id, type, session from session_events", "stream_events", "session_events"),
)
def w05(spark, d):
    return V.sessionise(stream_events(spark, d), "user_id").select("event_id", "user_id", "type", "session")


def requests_of_events(spark, d):
    """Stream events with their request, one hit per page event."""
    events = V.sessionise(stream_events(spark, d), "user_id")
    none = F.lit(None)
    return events.select(
        "event_id", "ts", F.concat_ws("-", "user_id", "session").alias("request_id"), "type",
        F.when(F.col("type") == "page", F.array(F.struct(F.col("hit_url").alias("url")))).alias("web"),
        none.cast("boolean").alias("partial"), "credits_used",
        F.when(F.col("type") == "done", F.concat(F.lit("serp_"), "event_id")).alias("id"),
        "code", none.cast("string").alias("message"),
    )


FOLD_SQL = with_views(
    """select request_id, count(case when type = 'page' then 1 end) as pages,
      count(case when type = 'page' then 1 end) as hits,
      coalesce(min(case when type <> 'page' then type end), 'open') as outcome,
      max(credits_used) as credits_used, max(case when type = 'done' then 'serp_' || event_id end) as id,
      max(code) as code from session_events group by request_id""",
    "stream_events", "session_events",
)


@add("a07_fold_stream_events", FOLD_SQL)
def a07(spark, d):
    return V.fold_events(requests_of_events(spark, d)).drop("partial", "message")


@add(
    "a07_folded_hits",
    with_views(
        """select request_id, row_number() over (partition by request_id order by ts, event_id) as position, hit_url as url
        from session_events where type = 'page'""",
        "stream_events", "session_events",
    ),
)
def a07_hits(spark, d):
    return V.folded_hits(requests_of_events(spark, d))
