"""Page extraction and scraping (S01, S09, S10, X, U01, A01, T01)."""

from pyspark.sql import functions as F

from leafmill.operators import documents as D
from leafmill.operators import extract as X
from leafmill.operators import nodes as N
from leafmill.operators import requests as R
from leafmill.operators.envelopes import batch_summary
from leafmill.operators.scrape import scrape, scrape_get
from leafmill.sources.readers import read_pages
from leafmill.sources.writers import dump_json
from registry import sql as S
from registry.base import Entries, scrape_requests, table, with_views

ENTRIES = Entries()
add = ENTRIES.add


def _pages(spark, d):
    return read_pages(spark, f"{d}/pages.parquet")


@add("s01_read_pages", "select page_id, url, cast(length(html) as bigint) as html_chars, md5(html) as html_md5 from pages")
def s01(spark, d):
    return _pages(spark, d).select(
        "page_id", "url", F.length("html").cast("bigint").alias("html_chars"), F.md5("html").alias("html_md5")
    )


@add("x01_raw_html", "select page_id, html as raw_html from pages")
def x01(spark, d):
    return X.extract(_pages(spark, d), ("rawHtml",), ("page_id",))


@add("x02_html", f"select page_id, {S.clean()} as html from pages")
def x02(spark, d):
    return X.extract(_pages(spark, d), ("html",), ("page_id",))


@add("x03_markdown", f"select page_id, {S.markdown(S.clean())} as markdown from pages")
def x03(spark, d):
    return X.extract(_pages(spark, d), ("markdown",), ("page_id",))


def _urls_sql(tag, attr, value):
    pattern = rf'<{tag}\b[^>]*\b{attr}="([^"]*)"'
    return rf"""
    with raw as (select page_id, url, unnest(regexp_extract_all({S.clean()}, '{pattern}', 1)) as ref,
        generate_subscripts(regexp_extract_all({S.clean()}, '{pattern}', 1), 1) as ord from pages),
    resolved as (select page_id, ord, case when regexp_matches(ref, '^https?://') then ref
        when ref like '//%' then regexp_extract(url, '^(https?:)', 1) || ref
        else regexp_extract(url, '^(https?://[^/?#]+)', 1) || ref end as {value} from raw),
    first_seen as (select page_id, {value}, min(ord) as ord from resolved group by all)
    select page_id, cast(row_number() over (partition by page_id order by ord) - 1 as int) as idx, {value} from first_seen"""


#: Pages with a base element, relative links and images at their end.
_BASED = """select page_id, url, concat(case when page_id % 3 = 0 then '' when page_id % 3 = 1 then '<base href="/dir/x">'
    else '<BASE target=_top><base href=''https://cdn.example.org/a/b/?q''>' end, html,
  '<a href="rel/x">r</a><img src="img/a.png"><img src=''/b.png'' alt=x><IMG alt="a" SRC=https://i.example.org/c.png>',
  case when page_id % 2 = 0 then '<img src="img/a.png">' else '' end) as html from {pages}"""
_BASED_SQL = f"""with based as ({_BASED.format(pages='pages')}), placed as (
  select *, regexp_extract(url, '^(https?://[^/?#]+)', 1) as origin,
    case page_id % 3 when 1 then regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/dir/' when 2 then 'https://cdn.example.org/a/b/'
      else coalesce(nullif(regexp_extract(url, '^(https?://[^/?#]+/([^?#]*/)?)', 1), ''), regexp_extract(url, '^(https?://[^/?#]+)', 1) || '/') end as folder,
    case page_id % 3 when 2 then 'https://cdn.example.org' else regexp_extract(url, '^(https?://[^/?#]+)', 1) end as base_origin
  from based)"""


def _based(spark, d):
    return spark.sql(_BASED, pages=_pages(spark, d))


@add(
    "x04_base_links",
    rf"""{_BASED_SQL}, raw as (select *, unnest(regexp_extract_all({S.clean()}, '<a\b[^>]*\bhref="([^"]*)"', 1)) as ref from placed)
    select distinct page_id, case when regexp_matches(ref, '^https?://') then ref
      when ref like '//%' then regexp_extract(folder, '^(https?:)', 1) || ref
      when ref like '/%' then base_origin || ref else folder || ref end as link from raw""",
)
def x04_base(spark, d):
    links = X.extract(_based(spark, d), ("links",), ("page_id",))
    return X.long_form(links, "links", "link").drop("idx")


@add(
    "x05_images_shown",
    f"""{_BASED_SQL} select page_id, [folder || 'img/a.png', base_origin || '/b.png', 'https://i.example.org/c.png'] as images from placed""",
)
def x05_shown(spark, d):
    return X.extract(_based(spark, d), ("images",), ("page_id",))


@add("x04_links", _urls_sql("a", "href", "link"))
def x04(spark, d):
    return X.long_form(X.extract(_pages(spark, d), ("links",), ("page_id",)), "links", "link")


@add(
    "x05_images",
    rf"""select page_id, cast(len(list_distinct(regexp_extract_all({S.clean()}, '<img\b[^>]*\bsrc="([^"]*)"', 1))) as int)
        as n_images from pages""",
)
def x05(spark, d):
    """The given pages show no image, and an empty array is not NULL; other cases are in the tests."""
    return X.extract(_pages(spark, d), ("images",), ("page_id",)).select("page_id", F.size("images").alias("n_images"))


@add(
    "x06_emails",
    f"""with found as (select page_id, unnest(regexp_extract_all({S.plain(S.clean())}, '({S.EMAIL})', 1)) as email,
        generate_subscripts(regexp_extract_all({S.plain(S.clean())}, '({S.EMAIL})', 1), 1) as ord from pages),
    first_seen as (select page_id, email, min(ord) as ord from found group by all)
    select page_id, cast(row_number() over (partition by page_id order by ord) - 1 as int) as idx, email from first_seen""",
)
def x06(spark, d):
    return X.long_form(X.extract(_pages(spark, d), ("emails",), ("page_id",)), "emails", "email")


_TOKENS_SQL = rf"""
with t as (select page_id, unnest(regexp_extract_all({S.clean()}, '(?s)(</?[A-Za-z][^>]*>|<[!?][^>]*>|[^<]+|<)', 1)) as token
  from pages),
n as (select page_id, token, lower(regexp_extract(token, '^</?([A-Za-z][^\s/>]*)', 1)) as tag from t)
"""
_KIND_SQL = """case when regexp_matches(token, '^</[A-Za-z]') then 'close'
  when regexp_matches(token, '^<[A-Za-z]') and (tag in ('area','base','br','col','embed','hr','img','input','link','meta',
    'source','track','wbr') or token like '%/>') then 'void'
  when regexp_matches(token, '^<[A-Za-z]') then 'open'
  when regexp_matches(token, '^<[!?]') then 'other' else 'text' end"""


@add(
    "x07_page_nodes",
    _TOKENS_SQL
    + f"""select page_id, {_KIND_SQL} as kind, nullif(tag, '') as tag, count(*) as n,
    cast(sum(length(token)) as bigint) as chars from n group by all""",
)
def x07(spark, d):
    nodes = N.page_nodes(_pages(spark, d))
    return nodes.groupBy("page_id", "kind", "tag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").cast("bigint").alias("chars")
    )


def _inner(pattern):
    found = f"regexp_extract({S.clean()}, '{pattern}', 1)"
    return S.collapse(S.decode(S.rep(found, S.TAG)))


@add(
    "x08_fields_text",
    f"""select page_id, 'heading' as field, {_inner('(?is)<h1[^>]*>(.*?)</h1>')} as value from pages
    union all select page_id, 'advert', {_inner('(?is)<div class="ad">(.*?)</div>')} from pages""",
)
def x08(spark, d):
    rules = {"heading": "h1", "advert": ".ad"}
    return N.extract_fields(_pages(spark, d), rules).select("page_id", "field", "value")


@add(
    "x09_fields_attr",
    rf"""with nav as (select page_id, regexp_extract({S.clean()}, '(?is)<nav>(.*?)</nav>', 1) as nav from pages)
    select page_id, 'menu' as field, unnest(regexp_extract_all(nav, '<a href="([^"]*)"', 1)) as value,
      cast(generate_subscripts(regexp_extract_all(nav, '<a href="([^"]*)"', 1), 1) - 1 as int) as idx from nav
    union all select page_id, 'charset', regexp_extract(html, '<meta charset="([^"]*)"', 1), 0 from pages""",
)
def x09(spark, d):
    rules = {
        "menu": {"selector": "nav a", "attr": "href", "multiple": True},
        "charset": {"selector": "head > meta[charset]", "attr": "charset"},
    }
    return N.extract_fields(_pages(spark, d), rules)


@add(
    "x09_fields_multiple",
    rf"""with nav as (select page_id, regexp_extract({S.clean()}, '(?is)<nav>(.*?)</nav>', 1) as nav from pages)
    select page_id, unnest(list_transform(regexp_extract_all(nav, '<li>(.*?)</li>', 1),
        lambda v: {S.collapse(S.decode(S.rep('v', S.TAG)))})) as value,
      cast(generate_subscripts(regexp_extract_all(nav, '<li>(.*?)</li>', 1), 1) - 1 as int) as idx from nav""",
)
def x09_multiple(spark, d):
    rules = {"items": {"selector": "nav > ul > li", "multiple": True}}
    return N.extract_fields(_pages(spark, d), rules).drop("field")


@add(
    "j05_rule_table",
    f"""select page_id, 'ads' as field, cast(len(regexp_extract_all({S.clean()}, '<div class="ad">')) as bigint) as n from pages
    union all select page_id, 'headings', cast(len(regexp_extract_all({S.clean()}, '<h1[ >]')) as bigint) from pages
    union all select page_id, 'links', cast(len(regexp_extract_all({S.clean()}, '<a[ >]')) as bigint) from pages""",
)
def j05(spark, d):
    rules = spark.createDataFrame(
        [("ads", "div", "ad", None), ("headings", "h1", None, None), ("links", "a", None, None)],
        "field string, tag string, cls string, elem_id string",
    )
    return N.match_rule_table(N.page_nodes(_pages(spark, d)), rules).groupBy("page_id", "field").agg(
        F.count(F.lit(1)).alias("n")
    )


@add(
    "x10_page_metadata",
    rf"""select page_id, {S.title(S.clean())} as title, cast(null as varchar) as description,
      regexp_extract(html, '<html lang="([^"]*)"', 1) as language, url as source_url, url as url, 200 as status_code,
      'text/html; charset=' || regexp_extract(html, '<meta charset="([^"]*)"', 1) as content_type,
      cast(null as varchar) as favicon from pages""",
)
def x10(spark, d):
    return X.page_metadata(_pages(spark, d))


def _requests(spark, d):
    df = R.wire_formats(R.default_formats(R.split_formats(scrape_requests(spark, d))))
    return R.check_formats(R.require_url(df))


_SCRAPE_SQL = f"""
with req as (select request_id, batch_id, {S.strip('url')} as url,
    coalesce(list_transform(list_filter(list_transform(string_split(formats_csv, ','), lambda f: {S.strip('f')}),
      lambda f: f <> ''), lambda f: case when f = 'raw_html' then 'rawHtml' else f end), ['markdown']) as formats
  from scrape_requests),
chk as (select *, case when url = '' then 'url is required'
    when list_contains(formats, 'text') then 'format is not available' end as bad from req),
doc as (select c.*, p.html as page, p.page_id, c.bad is null and p.page_id is not null as success
  from chk c left join pages p on p.url = c.url)
"""


@add(
    "x11_scrape",
    with_views(
        _SCRAPE_SQL
        + f"""select request_id, url, success,
      case when success and list_contains(formats, 'markdown') then {S.markdown(S.clean('page'))} end as markdown,
      case when success and list_contains(formats, 'html') then {S.clean('page')} end as html,
      case when success and list_contains(formats, 'rawHtml') then page end as raw_html,
      case when success and list_contains(formats, 'links')
        then cast(len(list_distinct(regexp_extract_all({S.clean('page')}, '<a href="([^"]*)"', 1))) as int) end as n_links,
      case when success then {S.title(S.clean('page'))} end as title,
      case when success then 1.0::double end as credits_used,
      case when not success then coalesce(bad, 'page not found') end as error from doc""",
        "scrape_requests",
    ),
)
def x11(spark, d):
    docs = scrape(_requests(spark, d), _pages(spark, d))
    return docs.select(
        "request_id", "url", "success", "markdown", "html", "raw_html",
        F.when(F.col("links").isNotNull(), F.size("links")).alias("n_links"),
        F.col("metadata.title").alias("title"), F.col("metadata.credits_used").alias("credits_used"), "error",
    )


@add(
    "x12_scrape_get",
    with_views(
        f"""with req as (select request_id, {S.strip('url')} as url from scrape_requests)
        select r.request_id, r.url, p.page_id is not null as success,
          {S.markdown(S.clean('p.html'))} as markdown,
          case when r.url = '' then 'url is required' when p.page_id is null then 'page not found' end as error
        from req r left join pages p on p.url = r.url""",
        "scrape_requests",
    ),
)
def x12(spark, d):
    reqs = R.require_url(scrape_requests(spark, d).select("request_id", "url"))
    return scrape_get(reqs, _pages(spark, d)).drop("metadata")


@add(
    "j03_requests_pages",
    with_views(
        f"""with req as (select request_id, {S.strip('url')} as url from scrape_requests)
        select p.page_id is not null as found, count(*) as n from req r left join pages p on p.url = r.url group by all""",
        "scrape_requests",
    ),
)
def j03(spark, d):
    reqs = R.require_url(scrape_requests(spark, d).select("request_id", "url")).drop("error")
    docs = scrape(reqs.withColumn("formats", F.array().cast("array<string>")), _pages(spark, d))
    return docs.groupBy(F.col("success").alias("found")).agg(F.count(F.lit(1)).alias("n"))


def _batch_docs(spark, d):
    reqs = _requests(spark, d)
    docs = scrape(reqs, _pages(spark, d))
    return docs.join(reqs.select("request_id", "batch_id"), "request_id")


@add(
    "a01_batch_summary",
    with_views(
        _SCRAPE_SQL
        + """select batch_id, count(*) as count, count(case when success then 1 end) as succeeded,
        bool_and(success) as success from doc group by batch_id""",
        "scrape_requests",
    ),
)
def a01(spark, d):
    return batch_summary(_batch_docs(spark, d))


@add(
    "t01_preserve_order",
    with_views(
        _SCRAPE_SQL
        + """select batch_id, cast(row_number() over (partition by batch_id order by request_id) - 1 as bigint) as idx,
        url, success from doc order by batch_id, idx""",
        "scrape_requests",
    ),
)
def t01(spark, d):
    """Results carry their place in the batch; the sort is left to the very end."""
    numbered = R.chunk_batches(_requests(spark, d), "batch_id", "request_id")
    docs = scrape(numbered, _pages(spark, d)).select("request_id", "success")
    return (
        numbered.join(docs, "request_id").select("batch_id", "idx", "url", "success").orderBy("batch_id", "idx")
    )


_RECORD_SQL = f"""select {S.markdown(S.clean())} as page_content, url as source, {S.title(S.clean())} as title,
  regexp_extract(html, '<html lang="([^"]*)"', 1) as language, '200' as status_code, 'crawl' as collection from pages"""


@add("s10_page_records", _RECORD_SQL)
def s10(spark, d):
    docs = X.extract(_pages(spark, d), ("markdown", "html"), metadata=True)
    records = D.to_loader_documents(docs, "scrape", user={"collection": "crawl", "source": "user"})
    return records.select(
        "page_content", *[F.col("metadata")[k].alias(k) for k in ("source", "title", "language", "status_code", "collection")]
    )


_HITS_SQL = f"""select {S.strip("coalesce(title, '') || chr(10) || coalesce(description, '')")} as text, url, title from (
  select url, {S.title(S.clean())} as title, case when page_id % 3 = 0 then null
    else {S.collapse(S.decode(S.rep(f"regexp_extract({S.clean()}, '(?is)<h1[^>]*>(.*?)</h1>', 1)", S.TAG)))} end as description from pages)"""


def _hits(spark, d):
    """Every page as a hit, its heading as description; a third has none."""
    pages = _pages(spark, d)
    heads = N.extract_fields(pages, {"h": "h1"}).select("page_id", "value")
    meta = X.page_metadata(pages).select("page_id", "url", "title")
    return meta.join(heads, "page_id").select(
        "url", "title", F.when(F.col("page_id") % 3 != 0, F.col("value")).alias("description")
    )


@add("s10_hit_records", f"select text as page_content, url as source, title from ({_HITS_SQL})")
def s10_hits(spark, d):
    records = D.to_loader_documents(_hits(spark, d), "search")
    return records.select(
        "page_content", F.col("metadata")["source"].alias("source"), F.col("metadata")["title"].alias("title")
    )


@add(
    "u01_load_documents",
    f"""select 'scrape' as mode, page_content, source, title from ({_RECORD_SQL})
    union all select 'search', text, url, title from ({_HITS_SQL})""",
)
def u01(spark, d):
    docs = X.extract(_pages(spark, d), ("markdown",), metadata=True)
    both = D.load_documents(docs, _hits(spark, d))
    return both.select(
        "mode", "page_content", F.col("metadata")["source"].alias("source"), F.col("metadata")["title"].alias("title")
    )


@add(
    "s09_dump_documents",
    """select '{"doc_id":' || d.doc_id || ',"lang":"' || d.lang || '","n_chars":' || d.n_chars ||
      case when l.quality is null then '' else ',"quality":' || l.quality || ',"toxic":' || l.toxic end || '}' as value
    from documents d left join labels l on l.doc_id = d.doc_id""",
)
def s09(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    return dump_json(docs.join(table(spark, d, "labels"), "doc_id", "left"))
