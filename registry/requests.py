"""Request tables: validation, defaults, bodies, batching (P, W01)."""

from pyspark.sql import functions as F

from leafmill.operators import requests as R
from leafmill.operators.extract import extract
from leafmill.operators.scrape import select_formats
from registry import sql as S
from registry.base import Entries, request_log, scrape_requests, search_queries, table, with_views

ENTRIES = Entries()
add = ENTRIES.add


def _flat_error(df):
    return df.withColumns(
        {"error_status": F.col("error.status"), "error_code": F.col("error.code"),
         "error_message": F.col("error.message")}
    ).drop("error")


def _error_sql(bad, message, code="INVALID_REQUEST"):
    return (
        f"case when {bad} then 400 end as error_status, case when {bad} then '{code}' end as error_code, "
        f"case when {bad} then '{message}' end as error_message"
    )


@add(
    "p01_require_url",
    with_views(
        f"select request_id, {S.strip('url')} as url, {_error_sql(S.strip('url') + ' = ' + chr(39) * 2, 'url is required')} "
        "from scrape_requests",
        "scrape_requests",
    ),
)
def p01(spark, d):
    return _flat_error(R.require_url(scrape_requests(spark, d).select("request_id", "url")))


@add(
    "p02_require_query",
    with_views(
        f"select query_id, {S.strip('q')} as q, {_error_sql(S.strip('q') + ' = ' + chr(39) * 2, 'q is required')} "
        "from search_queries",
        "search_queries",
    ),
)
def p02(spark, d):
    return _flat_error(R.require_query(search_queries(spark, d).select("query_id", "q")))


_BATCHES_SQL = f"""
with jobs as (
  select concat('a', page_id // 30) as job, {S.strip('url')} as url from pages
  union all select concat('b', page_id // 120) as job, url from pages
  union all select concat('c', page_id // 40) as job, case when page_id % 80 = 7 then ' ' else url end from pages
  union all select concat('d', page_id // 50) as job, null from pages)
select job, count(url) as n_urls,
  case when count(url) = 0 then 'urls must be a non-empty array'
       when count(url) > 100 then 'batch supports at most 100 URLs'
       when count(case when {S.strip('url')} = '' then 1 end) > 0 then 'url is required' end as error_message
from jobs group by job
"""


@add("p03_validate_batches", _BATCHES_SQL)
def p03(spark, d):
    """Batches of 30, of 120 (too many), with blank URLs, and empty ones. Each holds a fixed span of page ids."""
    pages = table(spark, d, "pages").select("page_id", "url")
    part = lambda name, size, url: pages.select(
        F.concat(F.lit(name), F.floor(F.col("page_id") / size).cast("string")).alias("job"), url.alias("url")
    )
    blank = F.when(F.col("page_id") % 80 == 7, F.lit(" ")).otherwise(F.col("url"))
    jobs = (
        part("a", 30, F.col("url")).unionByName(part("b", 120, F.col("url"))).unionByName(part("c", 40, blank))
        .unionByName(part("d", 50, F.lit(None).cast("string")))
    )
    batches = jobs.groupBy("job").agg(F.collect_list("url").alias("urls"))
    checked = R.validate_batches(batches)
    return checked.select(
        "job", F.size("urls").cast("bigint").alias("n_urls"), F.col("error.message").alias("error_message")
    )


_SPLIT = f"list_filter(list_transform(string_split(formats_csv, ','), lambda f: {S.strip('f')}), lambda f: f <> '')"


def _formats(spark, d):
    return R.split_formats(scrape_requests(spark, d).select("request_id", "formats_csv"))


@add(
    "p04_default_formats",
    with_views(
        f"select request_id, array_to_string(coalesce({_SPLIT}, ['markdown']), '|') as formats from scrape_requests",
        "scrape_requests",
    ),
)
def p04(spark, d):
    return R.default_formats(_formats(spark, d)).select("request_id", F.array_join("formats", "|").alias("formats"))


@add(
    "p05_wire_formats",
    with_views(
        f"""select request_id, array_to_string(list_transform({_SPLIT},
            lambda f: case when f = 'raw_html' then 'rawHtml' else f end), '|') as formats from scrape_requests""",
        "scrape_requests",
    ),
)
def p05(spark, d):
    return R.wire_formats(_formats(spark, d)).select("request_id", F.array_join("formats", "|").alias("formats"))


@add(
    "p06_split_formats",
    with_views(
        f"""select request_id, array_to_string({_SPLIT}, '|') as dropped,
          case when coalesce(formats_csv, '') = '' then 'markdown' else array_to_string(
            list_transform(string_split(formats_csv, ','), lambda f: {S.strip('f')}), '|') end as kept
        from scrape_requests""",
        "scrape_requests",
    ),
)
def p06(spark, d):
    df = R.split_formats(scrape_requests(spark, d), out="dropped")
    df = R.split_formats(df, out="kept", drop_empty=False)
    return df.select("request_id", F.array_join("dropped", "|").alias("dropped"), F.array_join("kept", "|").alias("kept"))


_BAD_FORMAT = f"""len(list_filter(list_transform({_SPLIT},
  lambda f: case when f = 'raw_html' then 'rawHtml' else f end),
  lambda f: f not in ('markdown', 'html', 'rawHtml', 'json', 'links', 'images', 'emails'))) > 0"""


@add(
    "p07_check_formats",
    with_views(
        f"select request_id, {_error_sql(_BAD_FORMAT, 'format is not available', 'FORMAT_UNAVAILABLE')} "
        "from scrape_requests",
        "scrape_requests",
    ),
)
def p07(spark, d):
    return _flat_error(R.check_formats(R.wire_formats(_formats(spark, d)))).drop("formats", "formats_csv")


_ENGINE = "case item_id % 5 when 0 then null when 1 then 'yahoo' when 2 then 'bing' when 3 then '' else 'duckduckgo' end"


@add(
    "p08_check_engine",
    f"""with t as (select item_id, {_ENGINE} as given from benchmark)
    select item_id, coalesce(nullif(given, ''), 'google') as engine,
      {_error_sql("given = 'yahoo'", 'engine must be google, bing or duckduckgo')} from t""",
)
def p08(spark, d):
    df = table(spark, d, "benchmark").select("item_id", F.expr(_ENGINE).alias("engine"))
    return _flat_error(R.check_engine(df))


_NUM = "case when item_id % 7 = 0 then null else cast((item_id * 13) % 115 as int) end"


@add(
    "p09_check_num",
    f"""with t as (select item_id, coalesce({_NUM}, 10) as num from benchmark)
    select item_id, num, {_error_sql('num not between 1 and 100', 'num must be between 1 and 100')} from t""",
)
def p09(spark, d):
    df = table(spark, d, "benchmark").select("item_id", F.expr(_NUM).alias("num"))
    return _flat_error(R.check_num(df))


_MANGLED = (
    "case page_id % 6 when 0 then url when 1 then concat(' ', url) when 2 then regexp_replace(url, '^https?:', '') "
    "when 3 then concat('ftp:', url) when 4 then 'http://' else url end"
)


@add(
    "p10_check_url_syntax",
    f"""with t as (select page_id, {_MANGLED} as url from pages)
    select page_id, url, {_error_sql("not regexp_matches(url, '^https?://[^/?#" + chr(92) + "s]+')", 'url must be fully qualified')} from t""",
)
def p10(spark, d):
    df = table(spark, d, "pages").select("page_id", F.expr(_MANGLED).alias("url"))
    return _flat_error(R.check_url_syntax(df))


def _json_list(x):
    return f"""'[' || array_to_string(list_transform({x}, lambda f: '"' || f || '"'), ',') || ']'"""


_WIRE_FORMATS = f"""coalesce(list_transform({_SPLIT},
  lambda f: case when f = 'raw_html' then 'rawHtml' else f end), ['markdown'])"""


@add(
    "p11_build_scrape_requests",
    with_views(
        f"""select request_id, '{{"url":"' || {S.strip('url')} || '","formats":' || {_json_list(_WIRE_FORMATS)} ||
          ',"skipCache":' || cast(skip_cache as varchar) ||
          case when request_id % 2 = 0 then ',"timeout":90000' else '' end ||
          case when request_id % 5 = 0 then ',"location":{{"country":"de","languages":["de","en"]}}' else '' end ||
          ',"redactPII":true}}' as body from scrape_requests""",
        "scrape_requests",
    ),
)
def p11(spark, d):
    df = R.require_url(R.split_formats(scrape_requests(spark, d)))
    df = df.withColumns(
        {
            "timeout": F.when(F.col("request_id") % 2 == 0, 90000),
            "country": F.lit(None).cast("string"),
            "location": F.when(
                F.col("request_id") % 5 == 0,
                F.struct(
                    F.lit("de").alias("country"), F.array(F.lit("de"), F.lit("en")).alias("languages")
                ),
            ),
            "redact_pii": F.lit(True),
            "extract_main_content": F.lit(True),
        }
    )
    return R.build_scrape_requests(df).select("request_id", "body")


@add(
    "p12_build_batch_requests",
    with_views(
        f"""select batch_id, '{{"urls":[' || string_agg('"' || {S.strip('url')} || '"', ',' order by request_id) ||
          '],"formats":["markdown"],"country":"us"}}' as body from scrape_requests group by batch_id""",
        "scrape_requests",
    ),
)
def p12(spark, d):
    """Each batch of the fixture holds at most 30 URLs."""
    rows = R.require_url(scrape_requests(spark, d))
    batches = (
        rows.groupBy("batch_id")
        .agg(F.sort_array(F.collect_list(F.struct("request_id", "url"))).alias("_u"))
        .select("batch_id", F.col("_u.url").alias("urls"), F.lit("us").alias("country"), F.lit("{}").alias("json_options"))
    )
    return R.build_batch_requests(batches).select("batch_id", "body")


_QUERY_JSON = r"""replace(replace(q, '"', '\"'), chr(10), '\n')"""


@add(
    "p13_build_search_requests",
    with_views(
        f"""with t as (select *, {S.strip('q')} as q2 from search_queries)
        select query_id, '{{"q":"' || {_QUERY_JSON.replace('(q,', '(q2,')} || '","engine":"' || engine || '","num":' || num ||
          case when start > 0 then ',"start":' || start else '' end || '}}' as body from t""",
        "search_queries",
    ),
)
def p13(spark, d):
    df = R.require_query(search_queries(spark, d)).withColumns(
        {"start": F.when(F.col("start") > 0, F.col("start")), "country": F.lit(None).cast("string")}
    )
    return R.build_search_requests(df).select("query_id", "body")


@add(
    "p14_select_formats",
    f"""select page_id, case when page_id % 2 = 0 then {S.markdown(S.clean())} end as markdown,
      case when page_id % 2 = 1 then {S.clean()} end as html from pages""",
)
def p14(spark, d):
    """Per row: markdown for even pages, html for odd ones."""
    docs = extract(table(spark, d, "pages"), ("markdown", "html"))
    wanted = docs.withColumn(
        "formats", F.array(F.when(F.col("page_id") % 2 == 0, "markdown").otherwise("html"))
    )
    return select_formats(wanted, "formats").drop("formats", "url")


@add(
    "w01_chunk_batches",
    with_views(
        """with n as (select id, kind, row_number() over (partition by kind order by event_id) - 1 as place from request_log)
        select id, kind, cast(place // 100 as bigint) as chunk, cast(place % 100 as bigint) as idx from n""",
        "request_log",
    ),
)
def w01(spark, d):
    """Two jobs hold all rows, so each is a hot key."""
    return R.chunk_batches(request_log(spark, d).select("id", "kind", "event_id"), "kind", "event_id").drop("event_id")


@add(
    "w01_collect_batches",
    with_views(
        """with n as (select id, kind, event_id, row_number() over (partition by kind order by event_id) - 1 as place
           from request_log)
        select kind, cast(place // 100 as bigint) as chunk, string_agg(id, '|' order by event_id) as urls
        from n group by all""",
        "request_log",
    ),
)
def w01_collect(spark, d):
    chunks = R.chunk_batches(request_log(spark, d).select("id", "kind", "event_id"), "kind", "event_id")
    return R.collect_batches(chunks, "kind", "id").select("kind", "chunk", F.array_join("urls", "|").alias("urls"))
