import json

import pytest
from pyspark.sql import functions as F

from leafmill.operators import extract as X
from leafmill.streaming import live as Z


@pytest.fixture
def land(tmp_path):
    """Write one file of JSON lines to the landing folder."""
    folder = tmp_path / "in"
    folder.mkdir()

    def write(name, *objects):
        (folder / name).write_text("\n".join(o if isinstance(o, str) else json.dumps(o) for o in objects) + "\n")
        return str(folder)

    return write


FIELDS = {"request_id": "string", "ts": "timestamp", "event_id": "int"}


def at(minute, hour=0):
    return f"2024-01-01 {hour:02d}:{minute:02d}:00"


def page(request, event, ts, *urls):
    return {"request_id": request, "event_id": event, "ts": ts, "type": "page", "data": {"web": [{"url": u} for u in urls]}}


def done(request, event, ts):
    return {"request_id": request, "event_id": event, "ts": ts, "type": "done", "creditsUsed": 1, "id": "serp", "partial": False}


def out(spark, stream, tmp_path, name="out"):
    Z.run_available(stream, str(tmp_path / name), str(tmp_path / f"{name}-state"))
    return [r.asDict(recursive=True) for r in spark.read.schema(stream.schema).parquet(str(tmp_path / name)).collect()]


def test_hits(spark, land, tmp_path):
    folder = land("a.json", page("r", 1, at(0), "u1", "u2"), "", done("r", 2, at(1)))
    land("b.json", page("q", 3, at(2), "u3"), "   ")
    hits = out(spark, Z.stream_hits(Z.stream_events(spark, folder, FIELDS, 1), ["request_id"]), tmp_path)
    assert sorted((h["request_id"], h["idx"], h["url"]) for h in hits) == [("q", 0, "u3"), ("r", 0, "u1"), ("r", 1, "u2")]


def fold(spark, folder, tmp_path):
    stream = Z.fold_stream(Z.stream_events(spark, folder, FIELDS, 1), silence="30 minutes")
    return {r["request_id"]: r for r in out(spark, stream, tmp_path)}


def test_fold_and_late_rows(spark, land, tmp_path):
    folder = land("a.json", page("r", 1, at(0), "u1"), page("r", 2, at(5), "u2", "u3"), done("r", 3, at(6)))
    assert fold(spark, folder, tmp_path) == {}  # r may still go on
    land("b.json", page("s", 4, at(0, 2), "u4"))
    got = fold(spark, folder, tmp_path)
    assert (got["r"]["pages"], got["r"]["hits"], got["r"]["outcome"], got["r"]["id"]) == (2, 3, "done", "serp")
    land("c.json", page("r", 5, at(7), "late"), page("late", 6, at(1), "x"), page("t", 7, at(0, 4), "u5"))
    got = fold(spark, folder, tmp_path)
    # Rows far behind the watermark are dropped: neither does r change nor does a request of late rows alone appear.
    assert set(got) == {"r", "s"} and got["r"]["hits"] == 3 and got["s"]["outcome"] == "open"


def test_scrape_equals_batch(spark, sf_dir, tmp_path):
    path = f"{sf_dir}/pages.parquet"
    pages = spark.read.parquet(path)
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(pages.schema).option("pathGlobFilter", "pages.parquet").parquet(sf_dir)
    got = out(spark, Z.stream_scrape(stream, X.TEXT_FORMATS), tmp_path)
    want = [r.asDict(recursive=True) for r in X.extract(pages, X.TEXT_FORMATS, metadata=True).collect()]
    key = lambda r: r["page_id"]
    assert sorted(got, key=key) == sorted(want, key=key) and got


def test_log_match(spark, tmp_path):
    docs = spark.sql("select * from values ('a', 0, 'A'), ('b', 0, 'B'), ('c', 5, 'C') t(scrape_id, s, body)")
    logs = spark.sql("select * from values ('a', 3, 200), ('b', 31, 200), ('c', 4, 500), ('x', 1, 200) t(scrape_id, s, status)")
    base = F.lit("2024-01-01 00:00:00").cast("timestamp")
    seconds = lambda df, name: df.withColumn(name, F.timestamp_seconds(F.unix_seconds(base) + F.col("s"))).drop("s")
    seconds(docs, "scraped_at").write.parquet(str(tmp_path / "docs"))
    seconds(logs, "logged_at").write.parquet(str(tmp_path / "logs"))
    read = lambda n: spark.readStream.schema(spark.read.parquet(str(tmp_path / n)).schema).parquet(str(tmp_path / n))
    got = out(spark, Z.stream_log_match(read("docs"), read("logs")), tmp_path)
    # b's log is beyond the bound, c's came before its scrape
    assert [(r["scrape_id"], r["body"], r["status"]) for r in got] == [("a", "A", 200)]
