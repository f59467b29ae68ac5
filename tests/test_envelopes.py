import json

from pyspark.sql import functions as F

from leafmill.operators import envelopes as E
from leafmill.sources import readers as R
from leafmill.sources.writers import dump_json, write_documents

SCRAPE = {
    "data": {
        "links": ["https://tea.test/green", "https://tea.test/black"],
        "markdown": "Two *sorts* of tea",
        "metadata": {
            "language": "en", "cacheState": "hit", "creditsUsed": 2.5, "scrapeId": "run-17", "sourceURL": "https://tea.test/",
            "statusCode": 203,
        },
        "rawHtml": "<p>Two <i>sorts</i> of tea</p>",
    },
    "success": True,
}


def bodies(spark, *payloads):
    texts = [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)]
    return E.parse(spark.createDataFrame(texts, "n int, value string")).drop("value")


def test_scrape_envelope(spark, rows):
    (doc,) = rows(E.documents_from_envelopes(bodies(spark, SCRAPE)))
    assert doc["markdown"] == "Two *sorts* of tea" and doc["raw_html"].startswith("<p>Two") and doc["success"] is True
    meta = doc["metadata"]
    assert (meta["source_url"], meta["status_code"], meta["scrape_id"]) == ("https://tea.test/", 203, "run-17")
    assert (meta["credits_used"], meta["cache_state"], meta["extra"]) == (2.5, "hit", None)
    assert doc["error"] is None and doc["extra"] is None and len(doc["links"]) == 2 and doc["html"] is None


def test_envelope_edges(spark, rows):
    docs = rows(
        E.documents_from_envelopes(
            bodies(
                spark,
                {"markdown": "bare", "data": "text"},  # data is no object: the envelope is the document
                {"data": {"markdown": "m", "error": "inner"}, "error": ""},  # empty error falls through
                {"data": {"error": "inner"}, "error": "outer", "success": False},
                {"data": {"json": {"headLine": {"subTitle": ["a", {"innerKey": 'x":y'}]}}, "newField": {"aB": 1}}},
                "not json",
                {"data": {"links": ["a", "b"], "metadata": {"statusCode": "ok", "fooBar": 1}}},
            )
        ),
        "n",
    )
    assert docs[0]["markdown"] == "bare" and json.loads(docs[0]["extra"]) == {"data": "text"}
    assert docs[1]["error"] == "inner" and docs[1]["success"] is True
    assert docs[2]["error"] == "outer" and docs[2]["success"] is False
    assert json.loads(docs[3]["json"]) == {"head_line": {"sub_title": ["a", {"inner_key": 'x":y'}]}}
    assert json.loads(docs[3]["extra"]) == {"new_field": {"a_b": 1}}
    assert docs[4]["markdown"] is None and docs[4]["success"] is False and docs[4]["error"] == E.NO_OBJECT
    assert docs[5]["links"] == ["a", "b"] and docs[5]["metadata"]["status_code"] is None
    assert json.loads(docs[5]["metadata"]["extra"]) == {"foo_bar": 1}


def test_search_envelopes(spark, rows):
    df = bodies(
        spark,
        {"id": "q-80", "creditsUsed": 3,
         "data": {"web": [{"position": 4, "title": "Pots", "url": "https://pots.test/a"}]}},
        {"data": {"web": [{"title": "Cups", "url": "https://cups.test/b"}]}, "success": True},
        {"data": {"web": ["junk", {"url": "u", "siteName": "s"}]}},
        {"data": {}},
    )
    hits = rows(E.hits_from_envelopes(df), "n", "idx")
    assert [(h["n"], h["idx"], h["url"], h["position"]) for h in hits] == [
        (0, 0, "https://pots.test/a", 4), (1, 0, "https://cups.test/b", None), (2, 1, "u", None),
    ]
    assert hits[0]["credits_used"] == 3.0 and hits[0]["id"] == "q-80" and hits[1]["credits_used"] is None
    assert json.loads(hits[2]["extra"]) == {"site_name": "s"}
    flat = rows(E.search_from_envelopes(df).withColumn("k", F.size("web")).drop("web"), "n")
    assert [r["k"] for r in flat] == [1, 1, 2, 0] and all(r["success"] for r in flat)


def test_batch_envelopes(spark, rows):
    inner = {"data": {"markdown": "kettle", "metadata": {"language": "de", "statusCode": 206}}}
    df = bodies(spark, {"results": [inner, 5, {"markdown": "b"}]}, {"count": 7, "results": [inner]}, "[]")
    docs = rows(E.batch_documents(df), "n", "idx")
    assert [(d["n"], d["idx"], d["markdown"]) for d in docs] == [(0, 0, "kettle"), (0, 2, "b"), (1, 0, "kettle")]
    assert docs[2]["metadata"]["status_code"] == 206
    assert [(r["success"], r["count"]) for r in rows(E.batch_counts(df), "n")] == [(True, 2), (True, 7), (False, 0)]


def test_error_bodies(spark, rows):
    # Two error codes of the API.
    limit, quota = "RATE_LIMIT_EXCEEDED", "MONTHLY_QUOTA_EXCEEDED"
    texts = [
        (418, json.dumps({"retryable": True, "code": limit, "message": "wait a while"})),
        (402, json.dumps({"retryable": False, "code": quota, "message": "all used up"})),
        (504, "no JSON here"),
        (501, json.dumps({"message": "", "title": "Kaput"})),
    ]
    df = E.parse(spark.createDataFrame(texts, "status int, value string")).drop("value")
    got = [(r["code"], r["message"], r["retryable"], r["will_retry"]) for r in rows(E.errors_from_bodies(df))]
    assert got == [
        (limit, "wait a while", True, True),
        (quota, "all used up", False, False),
        (None, "request failed (504)", None, True),
        (None, "Kaput", None, False),
    ]


def test_readers(spark, rows, tmp_path):
    def lines(name, *objects):
        path = tmp_path / name
        path.write_text("\n".join(o if isinstance(o, str) else json.dumps(o) for o in objects) + "\n")
        return str(path)

    good, bad = rows(R.read_scrape_envelopes(spark, lines("s", SCRAPE, "", "oops")), "success")[::-1]
    assert good["raw_html"].startswith("<p>Two") and good["bad_line"] is None
    assert (bad["success"], bad["error"], bad["bad_line"]) == (False, E.NO_OBJECT, "oops")
    batch = rows(R.read_batch_envelopes(spark, lines("b", {"results": [SCRAPE, SCRAPE]})), "idx")
    assert [b["idx"] for b in batch] == [0, 1] and batch[0]["batch"] == batch[1]["batch"]
    assert rows(R.read_search_envelopes(spark, lines("h", {"data": {"web": [{"url": "u"}]}})))[0]["url"] == "u"
    log_rows = R.read_logs(
        spark,
        lines(
            "l",
            {"status": 301, "url": "https://pots.test/", "duration_ms": 44, "started_at_ms": 9, "id": "k-1"},
            {"id": "k-2", "status": "fine", "url": {"host": 8}},
        ),
    )
    logs = rows(log_rows.withColumn("url", F.to_json("url")), "id")
    assert logs[0]["status"] == 301 and logs[0]["duration_ms"] == 44 and logs[0]["url"] == '"https://pots.test/"'
    assert logs[1]["status"] is None and json.loads(logs[1]["extra"]) == {"status": "fine"}
    assert logs[1]["url"] == '{"host":8}'
    events = rows(
        R.read_stream_events(
            spark,
            lines(
                "e",
                {"data": {"web": [{"url": "https://cups.test/1"}]}, "type": "page"},
                {"creditsUsed": 4, "id": "q-81", "otherKey": 5, "partial": True, "type": "done"},
                "   ", "[1]", "{oops",
            ),
        )
    )
    assert [e["type"] for e in events] == ["page", "done", "page", None]
    assert events[0]["web"][0]["url"] == "https://cups.test/1" and events[1]["credits_used"] == 4.0
    assert json.loads(events[1]["extra"]) == {"other_key": 5} and events[3]["bad_line"] == "{oops"
    errors = rows(R.read_errors(spark, lines("x", {"status": 502, "message": "m"}, "bad"), status=500))
    assert [(e["status"], e["message"]) for e in errors] == [(502, "m"), (500, "request failed (500)")]


def test_dump_and_write(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert rows(dump_json(df))[0]["value"] == '{"a":1,"c":"x"}'
    assert rows(dump_json(df, exclude_none=False))[0]["value"] == '{"a":1,"b":null,"c":"x"}'
    write_documents(df, str(tmp_path / "j"))
    assert rows(spark.read.json(str(tmp_path / "j"))) == [{"a": 1, "c": "x"}]
    write_documents(df, str(tmp_path / "p"), format="parquet")
    assert rows(spark.read.parquet(str(tmp_path / "p"))) == [{"a": 1, "b": None, "c": "x"}]


def test_normalize_typed_keys(spark):
    df = spark.sql(
        "select named_struct('sourceURL','u','statusCode',1) metaData, array(named_struct('rawHtml','h')) dataList"
    )
    out = E.normalize_keys(df)
    assert out.columns == ["meta_data", "data_list"]
    assert out.select("meta_data.source_url", F.col("data_list")[0]["raw_html"].alias("h")).first() == ("u", "h")
