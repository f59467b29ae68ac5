"""API responses, built by Spark from the given tables and read back (S02-S07, E)."""

from pyspark.sql import functions as F

from leafmill.functions import snake_json_keys
from leafmill.operators import envelopes as E
from leafmill.plans.spread import spread
from leafmill.sources import readers as R
from registry.base import Entries, request_log, stream_events, table, with_views

ENTRIES = Entries()
add = ENTRIES.add


def _parsed(df, text, *keep):
    return E.parse(df.select(*keep, text.alias("value"))).drop("value")


def _events(spark, d):
    """Building and parsing JSON is work per row, so a small table is spread over the cores first."""
    return spread(table(spark, d, "events"))


def _scrape_envelopes(spark, d):
    """A scrape response per page: every fifth without `data` around the document, some with an error."""
    meta = F.struct(
        F.col("url").alias("sourceURL"), F.lit(200).alias("statusCode"),
        F.concat(F.lit("s"), F.col("page_id").cast("string")).alias("scrapeId"), F.lit(1.0).alias("creditsUsed"),
        F.when(F.col("page_id") % 2 == 0, "hit").otherwise("miss").alias("cacheState"),
        F.col("page_id").alias("crawlDepth"),
    )
    doc = F.struct(
        F.col("html").alias("rawHtml"), F.array(F.col("url")).alias("links"), meta.alias("metadata"),
        F.when(F.col("page_id") % 7 == 0, "inner").alias("error"),
    )
    success = F.when(F.col("page_id") % 3 == 0, True)
    outer = F.when(F.col("page_id") % 4 == 0, "").when(F.col("page_id") % 4 == 1, "outer")
    wrapped = F.to_json(F.struct(success.alias("success"), outer.alias("error"), doc.alias("data")))
    pages = table(spark, d, "pages")
    text = F.when(F.col("page_id") % 5 == 0, F.to_json(doc)).otherwise(wrapped)
    return _parsed(pages, text, "page_id")


_DOC_SQL = """select page_id, md5(html) as raw_md5, url as source_url, 200 as status_code, 's' || page_id as scrape_id,
  1.0::double as credits_used, case when page_id % 2 = 0 then 'hit' else 'miss' end as cache_state from pages"""


@add("s02_scrape_envelopes", _DOC_SQL)
def s02(spark, d):
    docs = E.documents_from_envelopes(_scrape_envelopes(spark, d))
    fields = ("source_url", "status_code", "scrape_id", "credits_used", "cache_state")
    return docs.select("page_id", F.md5("raw_html").alias("raw_md5"), *[f"metadata.{f}" for f in fields])


@add("e01_documents", "select page_id, md5(html) as raw_md5, url as links, cast(null as varchar) as markdown from pages")
def e01(spark, d):
    docs = E.documents_from_envelopes(_scrape_envelopes(spark, d))
    return docs.select("page_id", F.md5("raw_html").alias("raw_md5"), F.array_join("links", " ").alias("links"), "markdown")


@add("e02_success_default", "select page_id, true as success from pages")
def e02(spark, d):
    return E.documents_from_envelopes(_scrape_envelopes(spark, d)).select("page_id", "success")


@add(
    "e03_error_precedence",
    """select page_id, case when page_id % 5 > 0 and page_id % 4 = 1 then 'outer'
      when page_id % 7 = 0 then 'inner' end as error from pages""",
)
def e03(spark, d):
    return E.documents_from_envelopes(_scrape_envelopes(spark, d)).select("page_id", "error")


@add("e08_keep_extras", """select page_id, '{"crawl_depth":' || page_id || '}' as extra from pages""")
def e08(spark, d):
    docs = E.documents_from_envelopes(_scrape_envelopes(spark, d))
    return docs.select("page_id", F.col("metadata.extra").alias("extra"))


def _search_envelopes(spark, d):
    """Search responses from conversations: up to 100 turns are the hits of one response."""
    turns = table(spark, d, "conversations").withColumn("part", F.floor(F.col("turn") / 100))
    hit = F.struct(
        F.concat(F.lit("https://c/"), F.col("turn").cast("string")).alias("url"), F.col("role").alias("title"),
        F.col("text").alias("description"), F.when(F.col("turn") % 2 == 0, F.col("turn") + 1).alias("position"),
        F.length("text").alias("textLength"),
    )
    grouped = turns.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(F.struct("turn", hit.alias("hit")))).alias("_h"))
    body = F.struct(
        F.when(F.col("conv_id") % 3 > 0, F.lit(1.0)).alias("creditsUsed"),
        F.concat(F.lit("serp_"), F.col("conv_id").cast("string")).alias("id"), F.struct(F.col("_h.hit").alias("web")).alias("data"),
    )
    return _parsed(grouped, F.to_json(body), "conv_id", "part")


@add(
    "s04_search_envelopes",
    """select conv_id, 'serp_' || conv_id as id, case when conv_id % 3 > 0 then 1.0::double end as credits_used,
      'https://c/' || turn as url, role as title, text as description,
      case when turn % 2 = 0 then cast(turn + 1 as int) end as position,
      '{"text_length":' || length(text) || '}' as extra from conversations""",
)
def s04(spark, d):
    return E.hits_from_envelopes(_search_envelopes(spark, d)).drop("idx", "part", "success")


@add(
    "e04_hits",
    """select conv_id, cast(row_number() over (partition by conv_id, turn // 100 order by turn) - 1 as int) as idx,
      'https://c/' || turn as url from conversations""",
)
def e04(spark, d):
    return E.hits_from_envelopes(_search_envelopes(spark, d)).select("conv_id", "idx", "url")


def _batch_envelopes(spark, d):
    """Batches of 30 pages as one response each; every tenth entry is no object."""
    item = F.when(F.col("page_id") % 10 == 9, F.lit('"gone"')).otherwise(
        F.to_json(F.struct(F.struct(F.col("html").alias("rawHtml"), F.col("url").alias("pageUrl")).alias("data")))
    )
    batches = table(spark, d, "pages").groupBy(F.floor(F.col("page_id") / 30).alias("batch_id")).agg(
        F.sort_array(F.collect_list(F.struct("page_id", item.alias("item")))).alias("_i")
    )
    count = F.when(F.col("batch_id") % 2 == 0, F.lit('"count":7,')).otherwise(F.lit(""))
    text = F.concat(F.lit("{"), count, F.lit('"results":['), F.array_join("_i.item", ","), F.lit("]}"))
    return _parsed(batches, text, "batch_id")


@add(
    "s03_batch_envelopes",
    """select page_id // 30 as batch_id, cast(row_number() over (partition by page_id // 30 order by page_id) - 1 as int) as idx,
      md5(html) as raw_md5, '{"page_url":"' || url || '"}' as extra from pages qualify page_id % 10 <> 9""",
)
def s03(spark, d):
    docs = E.batch_documents(_batch_envelopes(spark, d))
    return docs.select("batch_id", "idx", F.md5("raw_html").alias("raw_md5"), "extra")


def _sometimes_empty(spark, d, items):
    """A response for each page: without the list, with an empty one, with no object in it, or with two entries."""
    some = F.concat(F.lit('[7,{"url":"https://h/'), F.col("page_id").cast("string"), F.lit('","markdown":"m"}]'))
    listed = F.when(F.col("page_id") % 4 == 1, F.lit("[]")).when(F.col("page_id") % 4 == 2, F.lit('["x",null]')).otherwise(some)
    text = F.when(F.col("page_id") % 4 == 0, F.lit("{}")).otherwise(F.concat(F.lit(items[0]), listed, F.lit(items[1])))
    return _parsed(table(spark, d, "pages").select("page_id"), text, "page_id")


@add(
    "s03_empty_batches",
    """select page_id, case when page_id % 4 = 3 then 1 end::int as idx, case when page_id % 4 = 3 then 'm' end as markdown,
      case when page_id % 4 = 3 then true end as success from pages""",
)
def s03_empty(spark, d):
    bodies = _sometimes_empty(spark, d, ('{"results":', "}"))
    return E.batch_documents(bodies, keep_empty=True).select("page_id", "idx", "markdown", "success")


@add(
    "s04_empty_responses",
    """select page_id, case when page_id % 4 = 3 then 1 end::int as idx,
      case when page_id % 4 = 3 then 'https://h/' || page_id end as url from pages""",
)
def s04_empty(spark, d):
    bodies = _sometimes_empty(spark, d, ('{"data":{"web":', "}}"))
    return E.hits_from_envelopes(bodies, keep_empty=True).select("page_id", "idx", "url")


@add(
    "e05_batch_documents",
    """select page_id // 30 as batch_id, count(*) as documents, count(html) as with_html from pages
    where page_id % 10 <> 9 group by all""",
)
def e05(spark, d):
    docs = E.batch_documents(_batch_envelopes(spark, d))
    return docs.groupBy("batch_id").agg(F.count(F.lit(1)).alias("documents"), F.count("raw_html").alias("with_html"))


@add(
    "e06_count_default",
    """select page_id // 30 as batch_id, true as success, case when page_id // 30 % 2 = 0 then 7
      else cast(count(case when page_id % 10 <> 9 then 1 end) as int) end as count from pages group by page_id // 30""",
)
def e06(spark, d):
    return E.batch_counts(_batch_envelopes(spark, d))


def _log_lines(spark, d):
    """Log rows as JSON lines: some with the URL as an object, some with a status in words."""
    log = spread(request_log(spark, d))
    url = F.when(F.col("event_id") % 6 == 0, F.to_json(F.struct(F.struct("url").alias("req")))).otherwise(
        F.to_json(F.struct("url"))
    )
    status = F.when(F.col("event_id") % 10 == 0, F.lit('"ok"')).otherwise(F.col("status").cast("string"))
    rest = F.to_json(F.struct("id", "started_at_ms", "duration_ms", F.col("code").alias("finalOutcome")))
    text = F.concat(
        F.regexp_replace(rest, r"\}$", ',"status":'), status, F.lit(","), F.substring(url, F.lit(2), F.length(url) - 1)
    )
    return log.select(text.alias("value"))


@add(
    "s05_read_logs",
    with_views(
        """select id, started_at_ms, duration_ms, case when event_id % 10 > 0 then status end as status,
          case when event_id % 6 = 0 then null else '"' || url || '"' end as url, code as final_outcome,
          case when event_id % 6 = 0 and event_id % 10 = 0 then '{"req":{"url":"' || url || '"},"status":"ok"}'
               when event_id % 6 = 0 then '{"req":{"url":"' || url || '"}}'
               when event_id % 10 = 0 then '{"status":"ok"}' end as extra from request_log""",
        "request_log",
    ),
)
def s05(spark, d):
    logs = R.logs_from_bodies(R.json_lines(_log_lines(spark, d)).select("body"))
    return logs.withColumn("url", F.to_json("url")).drop("started_at")


@add(
    "s06_read_errors",
    with_views(
        """select id, status, case when event_id % 4 < 3 then code end as code,
          case when event_id % 4 = 3 then 'request failed (' || status || ')' when code is not null then 'm' || event_id
               else 'request failed (' || status || ')' end as message,
          case when event_id % 4 < 3 then retryable end as retryable,
          coalesce(case when event_id % 4 < 3 then retryable end, status in (502, 503, 504)) as will_retry
        from request_log where status <> 200""",
        "request_log",
    ),
)
def s06(spark, d):
    """Error bodies; a quarter of them is not JSON and counts as empty."""
    log = request_log(spark, d).where("status <> 200")
    message = F.when(F.col("code").isNotNull(), F.concat(F.lit("m"), F.col("event_id").cast("string")))
    body = F.to_json(F.struct("code", message.alias("message"), "retryable"))
    text = F.when(F.col("event_id") % 4 == 3, F.lit("<html>down</html>")).otherwise(body)
    return E.errors_from_bodies(_parsed(log, text, "id", "status")).drop("remediation", "extra")


def event_lines(events):
    """Stream events as NDJSON lines."""
    data = F.when(F.col("hit_url").isNotNull(), F.struct(F.array(F.struct(F.col("hit_url").alias("url"))).alias("web")))
    return F.to_json(
        F.struct(
            "event_id", F.col("ts").cast("string").alias("ts"), "user_id", "type", data.alias("data"),
            F.col("credits_used").alias("creditsUsed"), "code",
        )
    )


EVENT_FIELDS = {"event_id": "bigint", "ts": "timestamp", "user_id": "bigint"}

EVENTS_SQL = with_views(
    "select event_id, ts, user_id, type, hit_url as url, credits_used, code from stream_events", "stream_events"
)


@add("s07_read_stream_events", EVENTS_SQL)
def s07(spark, d):
    lines = spread(stream_events(spark, d))
    blank = lines.where("type = 'done'").select(F.lit("  ").alias("value"))  # blank lines are skipped
    events = R.stream_events_from_lines(lines.select(event_lines(lines).alias("value")).unionAll(blank), EVENT_FIELDS)
    return events.select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "type",
        F.try_element_at("web", F.lit(1))["url"].alias("url"), "credits_used", "code",
    )


_EXTRA_SQL = """'{"event_id":' || event_id || ',"event_info":{"event_type":"' || event_type || '","k_list":[{"user_id":' ||
  user_id || '},"rawHtml"]},"source_url":"' || event_type || '"}'"""


@add("e07_normalize_keys", f"select event_id, {_EXTRA_SQL} as json from events")
def e07(spark, d):
    info = F.struct(
        F.col("event_type").alias("eventType"),
        F.array(F.to_json(F.struct(F.col("user_id").alias("userId")))).alias("_k"),
    )
    raw = F.concat(
        F.lit('{"eventId":'), F.col("event_id").cast("string"), F.lit(',"eventInfo":{"eventType":"'), F.col("event_type"),
        F.lit('","kList":['), info["_k"][0], F.lit(',"rawHtml"]},"sourceURL":"'), F.col("event_type"), F.lit('"}'),
    )
    return _events(spark, d).select(
        "event_id", snake_json_keys(F.to_json(F.try_parse_json(raw))).alias("json")
    )


@add(
    "e07_normalize_columns",
    "select event_id, user_id, event_type, cast(event_id * 2 as bigint) as status_code from events",
)
def e07_columns(spark, d):
    wire = table(spark, d, "events").select(
        F.col("event_id").alias("eventId"),
        F.struct(
            F.col("user_id").alias("userId"), F.array(F.struct(F.col("event_type").alias("eventType"))).alias("eventList"),
            (F.col("event_id") * 2).alias("statusCode"),
        ).alias("metaData"),
    )
    flat = E.normalize_keys(wire)
    return flat.select(
        "event_id", "meta_data.user_id", F.col("meta_data.event_list")[0]["event_type"].alias("event_type"),
        "meta_data.status_code",
    )


@add(
    "e09_exclude_none",
    """select '{"doc_id":' || d.doc_id || case when l.quality is null then '' else ',"quality":' || l.quality end || '}' as json
    from documents d left join labels l using (doc_id)""",
)
def e09(spark, d):
    from leafmill.sources.writers import dump_json

    both = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return dump_json(both.select("doc_id", "quality"), out="json")
