"""Search over the pages (Q, T, W02, A08)."""

import uuid

from pyspark.sql import functions as F

from leafmill.operators import requests as R
from leafmill.operators import search as Q
from leafmill.plans.skew import bounded_join
from leafmill.session import checkpoint_root
from registry import sql as S
from registry.base import Entries, search_queries, table, with_views

ENTRIES = Entries()
add = ENTRIES.add

_INDEX_SQL = f"""
words as (select page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) as language, {S.tokens(S.plain(S.clean()))} as w
  from pages),
docs as (select page_id, language, cast(len(w) as bigint) as doc_len from words),
postings as (select page_id, language, cast(len(w) as bigint) as doc_len, term, count(*) as tf
  from (select page_id, language, w, unnest(w) as term from words) group by all),
terms as (select term, count(*) as df from postings group by term)
"""


def _score_sql(language=None):
    where = f"where p.language = '{language}'" if language else ""
    return f"""with {_INDEX_SQL},
totals as (select count(*) as n, avg(doc_len) as avg_len from docs),
asked as (select distinct query_id, unnest({S.tokens('q')}) as term from search_queries),
scored as (select a.query_id, p.page_id,
    round(sum(cast(round(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * doc_len / avg_len))
      * 1000000000) as bigint)) / 1000000000, 6) as score
  from asked a join terms t on t.term = a.term join postings p on p.term = a.term cross join totals {where}
  group by a.query_id, p.page_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, page_id) as position from scored)"""


_HITS_SQL = (
    lambda language=None: _score_sql(language)
    + f""", hits as (select r.query_id, q.engine, q.num, cast(r.position as int) as position, r.page_id, r.score, p.url,
    {S.title(S.clean('p.html'))} as title, substring({S.plain(S.clean('p.html'))}, 1, 160) as description
  from ranked r join search_queries q on q.query_id = r.query_id join pages p on p.page_id = r.page_id
  where r.position > q.start and r.position <= q.start + q.num)"""
)


def _pages(spark, d):
    return table(spark, d, "pages")


_INDEXES = {}


def _index(spark, d):
    """The index of all pages, built once per session and kept in the shared folder, as searches would use it."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _INDEXES:
        _INDEXES[key] = f"{checkpoint_root(spark)}/index-{uuid.uuid4().hex}"
        Q.saved_index(_pages(spark, d), _INDEXES[key])
    return Q.read_index(spark, _INDEXES[key])


def _queries(spark, d):
    return R.require_query(search_queries(spark, d))


@add("q01_build_index", f"with {_INDEX_SQL} select term, page_id, language, doc_len, tf from postings")
def q01(spark, d):
    return Q.build_index(_pages(spark, d)).postings


@add("a08_corpus_stats", f"with {_INDEX_SQL} select term, df from terms")
def a08(spark, d):
    return Q.build_index(_pages(spark, d)).terms


@add(
    "j06_query_postings",
    with_views(
        f"""with {_INDEX_SQL}, asked as (select distinct query_id, unnest({S.tokens('q')}) as term from search_queries)
        select query_id, term, count(*) as pages, cast(sum(tf) as bigint) as tf
        from asked join postings using (term) group by all""",
        "search_queries",
    ),
)
def j06(spark, d):
    postings = Q.build_index(_pages(spark, d)).postings
    met = bounded_join(postings, Q.query_terms(search_queries(spark, d)), "term", "inner", ["page_id"])
    return met.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("pages"), F.sum("tf").alias("tf"))


@add(
    "q02_search",
    with_views(
        _HITS_SQL() + " select query_id, position, page_id, score, url, title, description from hits", "search_queries"
    ),
)
def q02(spark, d):
    return Q.search(_queries(spark, d), _pages(spark, d), _index(spark, d)).drop("engine")


@add(
    "q03_search_language",
    with_views(_HITS_SQL("en") + " select query_id, position, page_id, score, url from hits", "search_queries"),
)
def q03(spark, d):
    hits = Q.search(_queries(spark, d), _pages(spark, d), _index(spark, d), language="en")
    return hits.select("query_id", "position", "page_id", "score", "url")


@add(
    "q04_engine_groups",
    with_views(
        _HITS_SQL()
        + " select engine, count(*) as hits, count(distinct query_id) as queries, count(distinct page_id) as pages from hits group by engine",
        "search_queries",
    ),
)
def q04(spark, d):
    hits = Q.search(_queries(spark, d), _pages(spark, d), _index(spark, d)).select("engine", "query_id", "page_id")
    return hits.groupBy("engine").agg(
        F.count(F.lit(1)).alias("hits"), F.countDistinct("query_id").alias("queries"),
        F.countDistinct("page_id").alias("pages"),
    )


@add(
    "q05_hit_projection",
    f"""select page_id, cast(1 as int) as position, url, {S.title(S.clean())} as title,
      substring({S.plain(S.clean())}, 1, 160) as description from pages""",
)
def q05(spark, d):
    pages = _pages(spark, d)
    ranked = pages.select("page_id", F.lit(1).alias("position"))
    return Q.hit_projection(ranked, pages)


@add(
    "w02_positions",
    with_views(
        _score_sql() + """ select query_id, page_id, score, cast(position as int) as position from ranked
        where position <= (select max(start + num) from search_queries where trim(q) <> '')""",
        "search_queries",
    ),
)
def w02(spark, d):
    """Ranks down to the deepest place that a query asks for."""
    queries = _queries(spark, d).where("error is null")
    depth = queries.agg(F.max(F.col("start") + F.col("num"))).first()[0]
    return Q.positions(Q.score(queries, _index(spark, d)), depth)


@add(
    "t02_top_num",
    with_views(
        _score_sql()
        + """ select r.query_id, r.page_id, r.score, cast(r.position as int) as position
        from ranked r join search_queries q using (query_id) where position <= q.num""",
        "search_queries",
    ),
)
def t02(spark, d):
    """Each query's own number of results."""
    queries = _queries(spark, d).where("error is null")
    return Q.top_num(Q.score(queries, _index(spark, d)), queries)


@add(
    "t03_paginate",
    with_views(
        _score_sql()
        + """ select r.query_id, r.page_id, r.score, cast(r.position as int) as position, q.start, q.num
        from ranked r join search_queries q using (query_id) where position > q.start and position <= q.start + q.num""",
        "search_queries",
    ),
)
def t03(spark, d):
    queries = _queries(spark, d).where("error is null")
    depth = queries.agg(F.max(F.col("start") + F.col("num"))).first()[0] or 0
    ranked = Q.positions(Q.score(queries, _index(spark, d)), depth)
    return Q.paginate(ranked.join(queries.select("query_id", "start", "num"), "query_id"))


@add(
    "t04_result_pages",
    with_views(
        _HITS_SQL()
        + """ select query_id, cast((position - 1) // 10 as bigint) as page_no, cast(count(*) as int) as hits,
        string_agg(url, ' ' order by position) as urls from hits group by all""",
        "search_queries",
    ),
)
def t04(spark, d):
    pages = Q.result_pages(Q.search(_queries(spark, d), _pages(spark, d), _index(spark, d)))
    return pages.select(
        "query_id", "page_no", F.size("web").alias("hits"), F.array_join("web.url", " ").alias("urls")
    )


@add(
    "q06_search_events",
    with_views(
        _HITS_SQL()
        + f""" select query_id, 'page' as type, cast(count(*) as int) as hits, cast(null as boolean) as partial,
          cast(null as double) as credits_used, cast(null as varchar) as message
        from hits group by query_id, (position - 1) // 10
        union all select q.query_id, 'done', null, count(h.page_id) < q.num, cast(ceil(q.num / 10.0) as double), null
        from search_queries q left join hits h on h.query_id = q.query_id where {S.strip('q.q')} <> ''
        group by q.query_id, q.num
        union all select query_id, 'error', null, null, null, 'q is required' from search_queries where {S.strip('q')} = ''""",
        "search_queries",
    ),
)
def q06(spark, d):
    queries = _queries(spark, d)
    events = Q.search_events(queries, Q.search(queries, _pages(spark, d), _index(spark, d)))
    return events.select(
        "query_id", "type", F.when(F.col("web").isNotNull(), F.size("web")).alias("hits"), "partial",
        "credits_used", "message",
    )
