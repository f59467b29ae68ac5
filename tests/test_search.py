import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from leafmill.operators import requests as R
from leafmill.operators import search as Q

TEXTS = {
    1: ("en", "apple banana apple"), 2: ("en", "banana cherry"), 3: ("de", "apple cherry cherry date"), 4: ("en", ""),
    5: ("en", "Apple-pie, APPLE! étude"),
}


@pytest.fixture
def pages(spark):
    rows = [
        (i, f"https://p{i}", f'<html lang="{lang}"><head><title>T{i}</title></head><body>{text}</body></html>')
        for i, (lang, text) in TEXTS.items()
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def brute(query, language=None):
    words = {i: [w for w in re.split(r"[\W_]+", f"t{i} {t}".lower()) if w] for i, (_, t) in TEXTS.items()}
    avg = sum(map(len, words.values())) / len(words)
    scores = {}
    for term in set(re.split(r"[\W_]+", query.lower())) - {""}:
        df = sum(term in w for w in words.values())
        for i, w in words.items():
            tf = Counter(w)[term]
            if tf and language in (None, TEXTS[i][0]):
                idf = math.log(1 + (len(words) - df + 0.5) / (df + 0.5))
                scores[i] = scores.get(i, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / avg))
    return sorted(((i, round(s, 6)) for i, s in scores.items()), key=lambda x: (-x[1], x[0]))


def ask(spark, *rows):
    return R.require_query(spark.createDataFrame(rows, "query_id int, q string, num int, start int"))


@pytest.mark.parametrize("language", [None, "en", "fr"])
def test_against_brute_force(spark, pages, rows, language, tmp_path):
    queries = ask(spark, (1, "apple cherry apple", 10, 0), (2, "étude", 10, 0), (3, "absent", 10, 0))
    for index in (None, Q.saved_index(pages, str(tmp_path / "ix"))):
        got = {}
        for r in rows(Q.search(queries, pages, index, language), "query_id", "position"):
            got.setdefault(r["query_id"], []).append((r["page_id"], r["score"]))
        want = {1: brute("apple cherry", language), 2: brute("étude", language)}
        assert got == {k: v for k, v in want.items() if v}


def test_pages_of_results(spark, pages, rows):
    ranked = [i for i, _ in brute("apple banana cherry")]
    queries = ask(spark, (1, "apple banana cherry", 2, 1), (2, " ", 5, 0), (3, "absent", 25, 0))
    hits = Q.search(queries, pages)
    got = rows(hits, "position")
    assert [(h["position"], h["page_id"]) for h in got] == [(2, ranked[1]), (3, ranked[2])]
    assert got[0]["title"] == f"T{ranked[1]}" and got[0]["description"].startswith(f"T{ranked[1]} ")
    events = {(r["query_id"], r["type"]): r for r in rows(Q.search_events(queries, hits))}
    assert len(events[1, "page"]["web"]) == 2 and events[1, "done"]["partial"] is False
    assert events[3, "done"]["partial"] is True and events[3, "done"]["credits_used"] == 3.0
    assert events[2, "error"]["code"] == "INVALID_REQUEST" and len(events) == 4


def test_result_pages(spark, rows):
    hits = spark.range(1, 24).select(
        F.lit(1).alias("query_id"), F.col("id").cast("int").alias("position"), F.concat(F.lit("u"), "id").alias("url"),
        F.lit("t").alias("title"), F.lit("d").alias("description"),
    )
    pages = rows(Q.result_pages(hits), "page_no")
    assert [len(p["web"]) for p in pages] == [10, 10, 3] and pages[1]["web"][0]["url"] == "u11"


def test_rank_is_cut_before_the_shuffle(spark, pages):
    asked = ask(spark, (1, "apple", 10, 0))
    scored = Q.score(asked, Q.build_index(pages))
    plan = Q.top_num(scored, asked)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_missing_num_and_start(spark, rows, pages):
    queries = ask(spark, (1, "apple", None, None), (2, "apple", 1, None))
    hits = rows(Q.search(queries, pages), "query_id", "position")
    assert [h["position"] for h in hits if h["query_id"] == 1] == list(range(1, 1 + len([h for h in hits if h["query_id"] == 1])))
    assert len([h for h in hits if h["query_id"] == 2]) == 1
    done = {e["query_id"]: e for e in rows(Q.search_events(queries, Q.search(queries, pages))) if e["type"] == "done"}
    assert done[1]["partial"] is True and done[2]["partial"] is False
    scored = Q.score(queries, Q.build_index(pages))
    assert [r["query_id"] for r in rows(Q.top_num(scored, queries)) if r["query_id"] == 2] == [2]


def test_saved_index_is_bucketed_and_skips_terms(spark, pages, rows, tmp_path):
    path = str(tmp_path / "ix")
    Q.saved_index(pages, path, buckets=3)
    asked = ask(spark, (1, "apple cherry", 10, 0), (2, "date absent", 10, 0))
    want = [(r["query_id"], r["page_id"], r["score"]) for r in rows(Q.score(asked, Q.build_index(pages)), "query_id", "page_id")]
    spark.sql(f"drop table {Q._table_of(path)}")  # as in another session, which finds the files alone
    index = Q.read_index(spark, path)
    scored = Q.score(asked, index)
    assert [(r["query_id"], r["page_id"], r["score"]) for r in rows(scored, "query_id", "page_id")] == want
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(query_id" not in plan and "SelectedBucketsCount: 3 out of 3" in plan
    assert "EqualTo(term,apple)" in plan and "EqualTo(term,date)" in plan


def test_postings_need_no_shuffle(spark, pages, rows):
    postings = Q.build_index(pages).postings
    assert "Exchange" not in postings._jdf.queryExecution().executedPlan().toString()
    got = {(r["page_id"], r["term"]): r["tf"] for r in rows(postings)}
    assert got == {
        (i, w): n for i, (_, t) in TEXTS.items()
        for w, n in Counter(w for w in re.split(r"[\W_]+", f"t{i} {t}".lower()) if w).items()
    }


def test_pages_without_text(spark, pages, rows, tmp_path):
    none = spark.createDataFrame([(1, "u", None)], pages.schema)
    for index in (Q.build_index(none), Q.saved_index(pages.limit(0), str(tmp_path / "ix"))):
        assert rows(index.postings) == [] and rows(Q.score(ask(spark, (1, "apple", 5, 0)), index)) == []
