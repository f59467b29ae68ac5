"""What the plans look like: pruned scans, no Python workers, no all-pairs joins, few shuffles."""

import pytest
from pyspark.sql import functions as F

import registry
from leafmill.operators import extract as X
from leafmill.operators import nodes as N
from leafmill.operators.redact import redact
from leafmill.operators.scrape import scrape, select_formats


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


BATCH = [n for n in registry.queries() if not n.startswith("z")]


@pytest.mark.parametrize("name", BATCH)
def test_stays_in_the_jvm_and_joins_on_keys(spark, sf_dir, name):
    text = plan(registry.queries()[name](spark, sf_dir))
    for node in ("Python", "InPandas", "InArrow", "CartesianProduct", "NestedLoopJoin", "SinglePartition"):
        if node == "SinglePartition" and name == "t01_preserve_order":
            continue
        assert node not in text, node


def test_formats_prune_extraction(pages):
    docs = X.extract(pages, X.TEXT_FORMATS)
    text = plan(select_formats(docs, ["links"]))
    assert "href" in text and "<h1" not in text and "mailto" not in text
    assert "Exchange" not in text
    meta = plan(X.extract(pages, (), ("page_id",)))
    assert "ReadSchema: struct<page_id:bigint>" in meta


def test_filters_reach_the_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = plan(redact(docs, "text").where("lang = 'en'").select("doc_id", "text"))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in text


def test_selectors_shuffle_pages_once(pages, no_broadcast):
    rules = {"a": {"selector": "nav a", "attr": "href", "multiple": True}, "b": "ul > li", "c": "h1"}
    text = plan(N.extract_fields(pages, rules))
    exchanges = [line for line in text.splitlines() if "Exchange " in line]
    assert all("hashpartitioning(page_id" in e and "REPARTITION_BY_COL" in e for e in exchanges)
    assert len(exchanges) == 2  # the same page rows on both sides of the last join; Spark runs it once


def test_large_pages_are_cut_in_parts_of_bounded_size(spark, no_broadcast):
    rules = {"a": {"selector": "nav > ul > li", "multiple": True}}
    for n in (400, 800):  # 40 and 80 million characters
        html = F.concat(F.lit("<nav><ul><li>a<li>b</ul></nav>"), F.repeat(F.lit("x"), 99_970))
        pages = spark.range(n).select(F.col("id").alias("page_id"), html.alias("html"))
        text = plan(N.extract_fields(pages, rules))
        exchanges = [line for line in text.splitlines() if "Exchange " in line]
        assert len(exchanges) == 2
        assert all(f", {n // 40})" in e and "hashpartitioning(page_id" in e for e in exchanges)


def test_page_bodies_move_by_page_only(spark, pages, no_broadcast):
    requests = pages.select(
        F.col("page_id").alias("request_id"), "url", F.array(F.lit("markdown")).alias("formats")
    )
    text = plan(scrape(requests, pages, heavy={}))
    # Copies of a URL are reduced on their keys before any page body is read.
    assert "partial_max(page_id" in text
    assert "ReadSchema: struct<page_id:bigint,url:string>" in text
