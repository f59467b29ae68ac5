"""Scalar functions over whole tables (F)."""

from pyspark.sql import functions as F

from leafmill import functions as L
from registry import sql as S
from registry.base import Entries, request_log, table, with_views

ENTRIES = Entries()
add = ENTRIES.add

_NAMES = r"([A-Za-z]+[^A-Za-z]+[A-Za-z]+)"
# The keys with a set name, appended in turn so that each occurs.
_KEYS = "['sourceURL','statusCode','scrapeId','creditsUsed','cacheState','rawHtml','redactPII','skip_cache','HTTPStatus2Code']"
_PICK = "array('sourceURL','statusCode','scrapeId','creditsUsed','cacheState','rawHtml','redactPII','skip_cache','HTTPStatus2Code')"


@add(
    "f01_camel_to_snake",
    f"""with names as (select {S.rep("unnest(regexp_extract_all(text, '" + _NAMES + "', 1))", "[^A-Za-z]+")} as name from documents
      union all select {_KEYS}[doc_id % 9 + 1] from documents)
    select {S.snake('name')} as snake, count(*) as n from names group by all""",
)
def f01(spark, d):
    docs = table(spark, d, "documents")
    pairs = docs.select(F.explode(F.regexp_extract_all("text", F.lit(_NAMES), 1)).alias("pair"))
    names = pairs.select(F.regexp_replace("pair", "[^A-Za-z]+", "").alias("name")).unionAll(
        docs.select(F.expr(f"{_PICK}[cast(doc_id % 9 as int)]"))
    )
    return names.groupBy(L.camel_to_snake(F.col("name")).alias("snake")).agg(F.count(F.lit(1)).alias("n"))


@add(
    "f02_snake_to_camel",
    f"""with names as (select doc_id, lower({S.rep("unnest(regexp_extract_all(text, '" + _NAMES + "', 1))", "[^A-Za-z]+", "_")})
        || '_v' || (doc_id % 3) || 'x' as name from documents),
    parts as (select string_split(name, '_') as p from names)
    select p[1] || array_to_string(list_transform(p[2:], lambda w: array_to_string(list_transform(
        regexp_extract_all(w, '(\\p{{L}}+|\\P{{L}}+)', 1), lambda r: upper(r[1]) || lower(r[2:])), '')), '') as camel,
      count(*) as n from parts group by all""",
)
def f02(spark, d):
    docs = table(spark, d, "documents")
    pairs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_NAMES), 1)).alias("pair"))
    name = F.concat(
        F.lower(F.regexp_replace("pair", "[^A-Za-z]+", "_")), F.lit("_v"), (F.col("doc_id") % 3).cast("string"), F.lit("x")
    )
    return pairs.groupBy(L.snake_to_camel(name).alias("camel")).agg(F.count(F.lit(1)).alias("n"))


@add("f03_percent_encode", "select doc_id, md5(url_encode(text)) as encoded_md5 from documents")
def f03(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(L.percent_encode(F.col("text"))).alias("encoded_md5"))


@add(
    "f04_error_message",
    with_views(
        """select id, coalesce(nullif(code, ''), case when event_id % 3 = 0 then '' when event_id % 3 = 1 then 'Failed' end_title,
        'request failed (' || status || ')') as message from request_log""".replace(
            "case when event_id % 3 = 0 then '' when event_id % 3 = 1 then 'Failed' end_title",
            "nullif(case when event_id % 3 = 0 then '' when event_id % 3 = 1 then 'Failed' end, '')",
        ),
        "request_log",
    ),
)
def f04(spark, d):
    title = F.expr("case when event_id % 3 = 0 then '' when event_id % 3 = 1 then 'Failed' end")
    return request_log(spark, d).select("id", L.error_message(F.col("code"), title, F.col("status")).alias("message"))


@add(
    "f05_is_retryable",
    with_views("select id, coalesce(retryable, status in (502, 503, 504)) as will_retry from request_log", "request_log"),
)
def f05(spark, d):
    return request_log(spark, d).select("id", L.is_retryable(F.col("status"), F.col("retryable")).alias("will_retry"))


@add(
    "f06_backoff_ms",
    with_views(
        """select id, cast(200 * pow(2, event_id % 4) as bigint) as delay_ms, unnest([200, 400])::bigint as schedule_ms,
          unnest([0, 1])::int as attempt from request_log where status <> 200""",
        "request_log",
    ),
)
def f06(spark, d):
    failed = request_log(spark, d).where("status <> 200")
    return failed.select(
        "id", L.backoff_ms(F.col("event_id") % 4).alias("delay_ms"),
        F.posexplode(L.retry_schedule()).alias("attempt", "schedule_ms"),
    )


_HIT = "case when doc_id % 4 = 0 then null else text end"
_TITLE = "case when doc_id % 3 = 0 then null when doc_id % 3 = 1 then concat(' ', source, chr(10)) else source end"


@add(
    "f07_hit_text",
    f"""select doc_id, md5(coalesce(nullif({S.strip(f"coalesce({_TITLE}, '') || chr(10) || coalesce({_HIT}, '')")}, ''),
      'https://x/' || doc_id)) as text_md5 from documents""",
)
def f07(spark, d):
    url = F.concat(F.lit("https://x/"), F.col("doc_id").cast("string"))
    text = L.hit_text(F.expr(_TITLE), F.expr(_HIT), url)
    return table(spark, d, "documents").select("doc_id", F.md5(text).alias("text_md5"))


@add(
    "f08_page_text",
    f"""select page_id, md5(coalesce(case when page_id % 3 = 0 then nullif({S.markdown(S.clean())}, '') end,
      case when page_id % 3 < 2 then html end, '')) as text_md5 from pages""",
)
def f08(spark, d):
    from leafmill.operators.extract import extract

    docs = extract(table(spark, d, "pages"), ("markdown", "rawHtml"), ("page_id",))
    md = F.when(F.col("page_id") % 3 == 0, F.col("markdown")).when(F.col("page_id") % 3 == 1, F.lit(""))
    raw = F.when(F.col("page_id") % 3 < 2, F.col("raw_html"))
    return docs.select("page_id", F.md5(L.page_text(md, raw)).alias("text_md5"))


@add(
    "f09_loader_metadata",
    """select doc_id, coalesce(cast(l.quality as varchar), d.source) as source, d.lang as language, 'corpus' as origin,
      case when l.quality is null then 3 else 4 end as n_keys
    from documents d left join labels l using (doc_id)""",
)
def f09(spark, d):
    both = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    lit = F.lit
    user = F.create_map(lit("origin"), lit("corpus"), lit("source"), lit("user"))
    own = F.create_map(lit("source"), F.col("source"), lit("language"), F.col("lang"))
    page = F.create_map(
        lit("source"), F.col("quality").cast("string"), lit("toxic"), F.col("toxic").cast("string"),
        lit("favicon"), lit(None).cast("string"),
    )
    meta = both.select("doc_id", L.loader_metadata(user, own, page).alias("m"))
    return meta.select(
        "doc_id", *[F.col("m")[k].alias(k) for k in ("source", "language", "origin")], F.size("m").alias("n_keys")
    )


@add(
    "f10_log_times",
    with_views(
        """select id, make_timestamp(started_at_ms * 1000) as started_at,
        make_timestamp((started_at_ms + duration_ms) * 1000) as ended_at,
        started_at_ms as back_ms from request_log""",
        "request_log",
    ),
)
def f10(spark, d):
    start = L.started_at(F.col("started_at_ms"))
    return request_log(spark, d).select(
        "id", start.cast("timestamp_ntz").alias("started_at"),
        L.ended_at(F.col("started_at_ms"), F.col("duration_ms")).cast("timestamp_ntz").alias("ended_at"),
        L.epoch_ms(start).alias("back_ms"),
    )


@add(
    "f11_preview",
    "select conv_id, turn, regexp_replace(substring(text, 1, 80), '[\\r\\n]', ' ', 'g') as preview from conversations",
)
def f11(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", L.preview(F.col("text"), 80).alias("preview"))
