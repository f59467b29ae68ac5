"""Ranked search over the user's own pages, many queries at once."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafmill.functions import html as H
from leafmill.functions.text import blank_to_null
from leafmill.operators.credits import search_credit
from leafmill.plans.skew import bounded_join
from leafmill.schemas import DEFAULT_NUM

# BM25 parameters.
K1 = 1.2
B = 0.75
RESULTS_PER_PAGE = 10
_NANO = 1_000_000_000
#: Most query terms that are looked up in a saved index by a pushed filter; more are met by the join alone.
MOST_PUSHED = 100


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


@dataclass(frozen=True)
class Index:
    """`postings (term, page_id, language, doc_len, tf)`, `terms (term, df)`, `docs (page_id, language, doc_len)` and
    `totals (n, avg_len)`, one row."""

    postings: DataFrame
    terms: DataFrame
    docs: DataFrame
    totals: DataFrame


def _page_words(pages: DataFrame) -> DataFrame:
    cleaned = H.clean_html(F.col("html"))
    return pages.select(
        "page_id", H.language(cleaned).alias("language"), tokens(H.bare_text(cleaned)).alias("_words")
    ).withColumn("doc_len", F.size("_words").cast("bigint"))


def saved_index(pages: DataFrame, path: str, buckets: int | None = None) -> Index:
    """Build the index under `path`. Pages are cut into words once and shuffled once, by page.

    Postings are bucketed by page, so that a search sums a page's terms where it reads them, and sorted by term in each
    bucket, so that a search for few terms skips the rest by Parquet's statistics. `buckets` should grow with the pages;
    it is the session's number of shuffle partitions where it is not given.
    """
    spark = pages.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    _page_words(pages).write.parquet(f"{path}/words")
    words = spark.read.parquet(f"{path}/words")
    postings = index_words(words.repartition(buckets, "page_id")).postings
    writer = postings.write.bucketBy(buckets, "page_id").sortBy("term").option("path", f"{path}/postings")
    writer.saveAsTable(_table_of(path))
    corpus_stats(spark.table(_table_of(path))).write.parquet(f"{path}/terms")
    _totals(words).withColumn("buckets", F.lit(buckets)).write.parquet(f"{path}/totals")
    return read_index(spark, path)


def _table_of(path: str) -> str:
    """The name under which a session knows the postings of `path`."""
    return "postings_" + hashlib.md5(path.encode()).hexdigest()


def read_index(spark: SparkSession, path: str) -> Index:
    """A saved index; its postings become a bucketed table of this session's catalog if they are not one yet."""
    parts = {part: spark.read.parquet(f"{path}/{part}") for part in ("terms", "words", "totals")}
    name = _table_of(path)
    if not spark.catalog.tableExists(name):
        page_id = parts["words"].schema["page_id"].dataType.simpleString()
        fields = f"term string, page_id {page_id}, language string, doc_len bigint, tf bigint"
        buckets = parts["totals"].first()["buckets"]
        spark.sql(
            f"create table {name} ({fields}) using parquet clustered by (page_id) sorted by (term) into {buckets} buckets "
            f"location '{path}/postings'"
        )
    return Index(spark.table(name), parts["terms"], parts["words"].drop("_words"), parts["totals"].drop("buckets"))


def build_index(pages: DataFrame) -> Index:
    """The index as a plan; `saved_index` keeps it for many searches."""
    return index_words(_page_words(pages))


def index_words(words: DataFrame) -> Index:
    """Postings without a shuffle: a page's words stand in one row, so they are sorted there and equal ones counted as runs.

    A `page_id` names one row.
    """
    def bound(value: Column, body: Callable[[Column], Column]) -> Column:
        """`body` of a value that is worked out once a row, however often the body names it."""
        return F.transform(F.array(value), body)[0]

    def starts(words: Column) -> Column:
        at = F.transform(words, lambda w, i: F.when((i == 0) | (w != F.get(words, i - 1)), i))
        return F.filter(at, lambda i: i.isNotNull())

    def counted(words: Column, at: Column) -> Column:
        return F.transform(at, lambda i, k: F.struct(
            F.get(words, i).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(words)) - i).cast("bigint").alias("tf")
        ))

    runs = words.withColumn(
        "_runs", bound(F.sort_array("_words"), lambda w: bound(starts(w), lambda at: counted(w, at)))
    )
    postings = runs.select("page_id", "language", "doc_len", F.inline("_runs")).select(
        "term", "page_id", "language", "doc_len", "tf"
    )
    return Index(postings, corpus_stats(postings), words.select("page_id", "language", "doc_len"), _totals(words))


def _totals(words: DataFrame) -> DataFrame:
    return words.agg(F.count(F.lit(1)).alias("n"), F.avg("doc_len").alias("avg_len"))


def corpus_stats(postings: DataFrame) -> DataFrame:
    """Number of pages per term."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def query_terms(queries: DataFrame) -> DataFrame:
    """`(query_id, term)`, each term once per query."""
    return queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("q")))).alias("term"))


def score(queries: DataFrame, index: Index, language: str | None = None) -> DataFrame:
    """BM25 of every page that has a query term: `(query_id, page_id, score)`.

    Query terms are the bounded side: they are counted, then broadcast, and beyond the bound a frequent term is
    salted by page. Up to MOST_PUSHED different terms are also a filter on the postings, which a saved index answers by
    skipping what lies between them. Its postings are bucketed by page, so no pair of query and page is shuffled to be
    summed. Scores are summed as whole nano-units, so the result does not depend on the order of the sum.
    """
    postings = index.postings if language is None else index.postings.where(F.col("language") == language)
    totals = index.totals.first()
    n, avg_len = totals["n"], totals["avg_len"] or 1.0
    terms = query_terms(queries)
    known = index.terms.join(terms.select("term").distinct(), "term", "left_semi")
    weighted = terms.join(known, "term").withColumn(
        "_idf", F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    )
    few = [r["term"] for r in known.select("term").limit(MOST_PUSHED + 1).collect()]
    if few and len(few) <= MOST_PUSHED:
        postings = postings.where(_one_of(F.col("term"), few))
    met = bounded_join(postings, weighted, "term", "inner", ["page_id"])
    norm = F.col("tf") + K1 * (1 - B + B * F.col("doc_len") / F.lit(avg_len))
    part = F.col("_idf") * F.col("tf") * (K1 + 1) / norm
    return met.groupBy("query_id", "page_id").agg(
        F.round(F.sum(F.round(part * _NANO).cast("bigint")) / _NANO, 6).alias("score")
    )


def _one_of(column: Column, values: list[str]) -> Column:
    """`column` is one of `values`, as a balanced tree of equalities: unlike a long IN, Parquet gets each of them."""
    if len(values) == 1:
        return column == values[0]
    half = len(values) // 2
    return _one_of(column, values[:half]) | _one_of(column, values[half:])


def positions(scored: DataFrame, depth: int) -> DataFrame:
    """1-based rank per query down to `depth`; ties go to the lower page_id.

    With a depth known to the plan, Spark keeps only `depth` rows per query and task before the shuffle.
    """
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("page_id"))
    return scored.withColumn("position", F.row_number().over(order)).where(F.col("position") <= depth)


def with_page(queries: DataFrame) -> DataFrame:
    """Queries with `num` and `start` given: 10 and 0 where they are missing."""
    return queries.withColumns(
        {"num": F.coalesce("num", F.lit(DEFAULT_NUM)), "start": F.coalesce("start", F.lit(0))}
    )


def top_num(scored: DataFrame, queries: DataFrame) -> DataFrame:
    """Each query's own `num` best pages; 10 where it is missing."""
    wanted = queries.select("query_id", F.coalesce("num", F.lit(DEFAULT_NUM)).alias("num"))
    depth = wanted.agg(F.max("num")).first()[0] or 0
    return positions(scored, depth).join(wanted, "query_id").where(F.col("position") <= F.col("num")).drop("num")


def paginate(ranked: DataFrame) -> DataFrame:
    """Keep places `start + 1 .. start + num`; both are columns, `start` counts from 0; 0 and 10 where they are missing."""
    ranked = with_page(ranked)
    return ranked.where(
        (F.col("position") > F.col("start")) & (F.col("position") <= F.col("start") + F.col("num"))
    )


def hit_projection(ranked: DataFrame, pages: DataFrame) -> DataFrame:
    """Add url, title and description of each hit: the meta description, else the first 160 characters of text.

    Hits are already cut to their page of results here, so page text is read for hits alone.
    """
    with_page = ranked.join(pages.select("page_id", "url", "html"), "page_id")
    return (
        with_page.withColumn("_clean", H.clean_html(F.col("html")))
        .withColumn("title", H.title(F.col("_clean")))
        .withColumn(
            "description",
            F.coalesce(
                blank_to_null(H.description(F.col("_clean"))), F.substring(H.plain_text(F.col("_clean")), 1, 160)
            ),
        )
        .drop("_clean", "html")
    )


def search(queries: DataFrame, pages: DataFrame, index: Index | None = None, language: str | None = None) -> DataFrame:
    """Hits of `queries (query_id, q, num, start[, engine, error])`.

    Gives `(query_id, position, page_id, score, url, title, description)` and `engine` where it is given; rows with
    an error give no hits. `language` limits the pages ranked.
    """
    if "error" in queries.columns:
        queries = queries.where(F.col("error").isNull())
    queries = with_page(queries)
    index = index or build_index(pages)
    depth = queries.agg(F.max(F.col("start") + F.col("num"))).first()[0] or 0
    ranked = positions(score(queries, index, language), depth)
    carried = ["query_id", "num", "start"] + [c for c in ("engine",) if c in queries.columns]
    wanted = paginate(ranked.join(queries.select(*carried), "query_id"))
    return hit_projection(wanted, pages).drop("num", "start")


def result_pages(hits: DataFrame, size: int = RESULTS_PER_PAGE) -> DataFrame:
    """Hits as they are sent: `(query_id, page_no, web[])`; a group holds one page of at most `size` hits."""
    page_no = F.floor((F.col("position") - 1) / size)
    hit = F.struct("position", "url", "title", "description")
    return hits.groupBy("query_id", page_no.alias("page_no")).agg(F.sort_array(F.collect_list(hit)).alias("web"))


def search_events(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """The same search as events: pages of hits, then one `done` per query, or one `error` for a bad query.

    `done` carries the credits and whether fewer hits came than were asked for.
    """
    none = F.lit(None)
    pages = result_pages(hits).select(
        "query_id", F.col("page_no").cast("int").alias("seq"), F.lit("page").alias("type"), "web",
        none.cast("boolean").alias("partial"), none.cast("double").alias("credits_used"),
        none.cast("string").alias("code"), none.cast("string").alias("message"),
    )
    ends = 2**31 - 1
    web = none.cast(pages.schema["web"].dataType).alias("web")
    queries = with_page(queries)
    good = queries.where(F.col("error").isNull())
    found = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"))
    done = good.join(found, "query_id", "left").select(
        "query_id", F.lit(ends).alias("seq"), F.lit("done").alias("type"), web,
        (F.coalesce("_n", F.lit(0)) < F.col("num")).alias("partial"),
        search_credit(F.col("num")).cast("double").alias("credits_used"),
        none.cast("string").alias("code"), none.cast("string").alias("message"),
    )
    failed = queries.where(F.col("error").isNotNull()).select(
        "query_id", F.lit(ends).alias("seq"), F.lit("error").alias("type"), web,
        none.cast("boolean").alias("partial"), none.cast("double").alias("credits_used"),
        F.col("error.code").alias("code"), F.col("error.message").alias("message"),
    )
    return pages.unionByName(done).unionByName(failed)
