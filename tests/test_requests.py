import json

from pyspark.sql import functions as F

from leafmill import functions as L
from leafmill.operators import credits as C
from leafmill.operators import requests as R


def test_bad_input(spark, rows):
    urls = spark.createDataFrame([(1, "  "), (2, None), (3, "\t https://a.org \n")], "n int, url string")
    got = rows(R.require_url(urls), "n")
    assert [g["error"] and g["error"]["message"] for g in got] == ["url is required", "url is required", None]
    assert got[0]["error"]["status"] == 400 and got[0]["error"]["code"] == "INVALID_REQUEST"
    assert got[2]["url"] == "https://a.org"
    q = spark.createDataFrame([("",), ("x",)], "q string")
    checked = R.require_query(q)
    assert R.rejected(checked).count() == 1 and R.valid(checked).first()["q"] == "x"
    batches = spark.createDataFrame(
        [(1, []), (2, None), (3, ["u"] * 101), (4, ["u"] * 100), (5, ["u", " "]), (6, [None])], "n int, urls array<string>"
    )
    got = [g["error"] and g["error"]["message"] for g in rows(R.validate_batches(batches), "n")]
    assert got == [
        "urls must be a non-empty array", "urls must be a non-empty array", "batch supports at most 100 URLs", None,
        "url is required", "url is required",
    ]


def test_first_error_stands(spark, rows):
    df = spark.createDataFrame([(" ", ["text"], "yahoo", 0)], "url string, formats array<string>, engine string, num int")
    (got,) = rows(R.check_num(R.check_engine(R.check_formats(R.require_url(df)))))
    assert got["error"]["message"] == "url is required"
    (got,) = rows(R.check_formats(df))
    assert got["error"]["code"] == "FORMAT_UNAVAILABLE"


def test_scrape_body(spark, rows):
    df = spark.createDataFrame(
        [("https://example.com", ["markdown"], True, "de", True, None), ("https://x.org", None, None, None, None, 5000),
         ("https://y.org", [], None, None, None, None)],
        "url string, formats array<string>, skip_cache boolean, country string, redact_pii boolean, timeout int",
    )
    got = [json.loads(r["body"]) for r in rows(R.build_scrape_requests(df))]
    assert got == [
        {"url": "https://example.com", "formats": ["markdown"], "skipCache": True, "country": "de", "redactPII": True},
        {"url": "https://x.org", "formats": ["markdown"], "timeout": 5000},
        {"url": "https://y.org", "formats": []},
    ]
    batch = spark.sql("select array('a', 'b') urls, array('raw_html', 'raw_html') formats, '{}' json_options")
    assert json.loads(R.build_batch_requests(batch).first()["body"]) == {"urls": ["a", "b"], "formats": ["rawHtml", "rawHtml"]}
    search = spark.sql("select 'x' q, 'bing' engine, cast(null as int) num, 0 start")
    assert json.loads(R.build_search_requests(search).first()["body"]) == {"q": "x", "engine": "bing", "start": 0}


def values(spark, fn, texts):
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    return [r[0] for r in df.select(fn(F.col("c"))).collect()]


def test_names(spark):
    camel = ["sourceURL", "redactPII", "already_snake", "Mixed_Case", "HTTPStatus2Code", "x", "rawHtml", ""]
    assert values(spark, L.camel_to_snake, camel) == [
        "source_url", "redact_pii", "already_snake", "mixed__case", "http_status2_code", "x", "raw_html", "",
    ]
    snake = ["max_retries", "one", "a_1b_c", "x__y", "keep_ÉTÉ", ""]
    assert values(spark, L.snake_to_camel, snake) == ["maxRetries", "one", "a1BC", "xY", "keepÉté", ""]


def test_json_keys(spark):
    text = '{"aB":[{"cD":"x\\"yZ\\":1","eF":{}}],"gH":"kL:","iJ":null,"sourceURL":1.5}'
    assert values(spark, L.snake_json_keys, [text]) == [
        '{"a_b":[{"c_d":"x\\"yZ\\":1","e_f":{}}],"g_h":"kL:","i_j":null,"source_url":1.5}'
    ]
    long = '{"aB":"' + '\\"' * 200_000 + '"}'
    assert values(spark, L.snake_json_keys, [long])[0] == long.replace("aB", "a_b")


def test_urls(spark):
    assert values(spark, L.percent_encode, ["a b/~*é+"]) == ["a%20b%2F~%2A%C3%A9%2B"]
    cases = {
        "x": "https://e.org/a/x", "./x": "https://e.org/a/x", "../x": "https://e.org/x", "../../x?q": "https://e.org/x?q",
        "/x": "https://e.org/x", "//h/x": "https://h/x", "http://h": "http://h", "?q": "https://e.org/a/b?q",
        "#f": "https://e.org/a/b?z#f", "..": "https://e.org/", ".": "https://e.org/a/", "mailto:a@b": "mailto:a@b",
    }
    assert values(spark, lambda c: L.resolve_url(c, F.lit("https://e.org/a/b?z#y")), list(cases)) == list(cases.values())
    assert values(spark, lambda c: L.resolve_url(c, F.lit("https://e.org")), ["x"]) == ["https://e.org/x"]


def test_small_functions(spark):
    row = spark.range(1).select(
        L.backoff_ms(F.lit(2)).alias("b"), L.retry_schedule().alias("s"), L.retry_schedule(0).alias("s0"),
        L.hit_text(F.lit(None).cast("string"), F.lit(" d "), F.lit("u")).alias("h"),
        L.hit_text(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("u")).alias("h0"),
        L.preview(F.lit("a\nbcd"), 3).alias("p"), L.is_retryable(F.lit(None).cast("int"), F.lit(None).cast("boolean")).alias("r"),
        C.search_credit(F.lit(11)).alias("c"),
    ).first()
    assert (row["b"], row["s"], row["s0"]) == (800, [200, 400], [])
    assert (row["h"], row["h0"], row["p"], row["r"], row["c"]) == ("d", "u", "a b", False, 2)


def test_rollup(spark, rows):
    scrapes = spark.createDataFrame([("a",), ("a",), ("b",)], "day string")
    searches = spark.createDataFrame([("a", 15)], "day string, num int")
    book = C.credit_ledger(C.ledger(scrapes, searches, ["day"]), ["kind", "day"])
    got = {(r["kind"], r["day"]): r["credits"] for r in rows(book)}
    assert got[(None, None)] == 5 and got[("scrape", None)] == 3 and got[("search", "a")] == 2


def test_numbers_and_formats_never_raise(spark, rows):
    given = [("5", 5, True), (None, 10, True), ("abc", None, False), ("3000000000", None, False), ("2.5", None, False), ("0", 0, False), ("1e2", 100, True)]
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(given)], "i int, num string")
    got = rows(R.check_num(df), "i")
    assert [(r["num"], r["error"] is None) for r in got] == [g[1:] for g in given]
    formats = spark.createDataFrame([(1, ["markdown", None]), (2, ["markdown"]), (3, None)], "i int, formats array<string>")
    assert [r["error"] is None for r in rows(R.check_formats(formats), "i")] == [False, True, True]
