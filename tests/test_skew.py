"""Hot-key plans against the plain ones: a third of the rows under one key, nulls, ties, and forced splitting."""

import random

import pytest
from pyspark.sql import functions as F

from leafmill.operators import events as V
from leafmill.operators import logs as G
from leafmill.operators import requests as R
from leafmill.plans.scan import running_sum
from leafmill.plans.skew import bounded_join, heavy_values, salted_join


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(7)
    rows = []
    for i in range(30_000):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(400)}"
        rows.append((i, key, rng.randrange(500), rng.randrange(-3, 9)))
    return spark.createDataFrame(rows, "id long, key string, at int, v int").repartition(6).cache()


def test_heavy_values(table):
    found = heavy_values(table, "key", rows=1000)
    assert list(found) == ["hot"] and 10_000 <= found["hot"] < 11_000
    assert heavy_values(table, "key") == {}
    assert set(heavy_values(table.withColumn("key", F.when(F.col("id") % 10 == 0, F.col("key"))), "key", rows=2000)) == {None}
    even = table.select((F.col("id") % 300).alias("k"))
    assert len(heavy_values(even, "k", rows=99)) == 300 and not heavy_values(even, "k", rows=101)


def test_no_piece_is_over_the_budget(table):
    """Every window partition keeps within about its rows: a NULL key of 90 %, and 300 even keys."""
    from leafmill.plans.scan import _splitters

    nulls = table.withColumn("key", F.when(F.col("id") % 10 == 0, F.col("key")))
    even = table.withColumn("key", (F.col("id") % 300).cast("string"))
    for df, rows in ((nulls, 1000), (even, 20)):
        heavy = heavy_values(df, "key", rows)
        cuts = _splitters(df, "key", ["at", "id"], heavy, rows)
        passed = F.aggregate("_cuts", F.lit(0), lambda n, c: n + F.when(c <= F.struct("at", "id"), 1).otherwise(0))
        sizes = (
            df.join(cuts, F.col("key").eqNullSafe(F.col("_cut_key"))).groupBy("_cut_key", passed.alias("p")).count()
        )
        assert sizes.agg(F.max("count")).first()[0] <= 3 * rows and sizes.count() >= df.count() / rows / 2


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(spark, table, how):
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4), ("zz", 5)], "key string, w int")
    want = sorted(map(str, table.join(right, "key", how).collect()))
    got = salted_join(table, right, "key", how, ["id"], heavy={"hot": 5_000_000, "k1": 3_000_000, None: 2_000_000})
    assert got.columns == table.join(right, "key", how).columns
    assert sorted(map(str, got.collect())) == want
    small = bounded_join(table, right, "key", how, ["id"], max_rows=100)
    beyond = bounded_join(table, right, "key", how, ["id"], max_rows=2, heavy={"hot": 2_000_000})
    assert sorted(map(str, small.collect())) == want == sorted(map(str, beyond.collect()))


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_sum(table, inclusive):
    total, want = {}, {}
    for r in sorted(table.collect(), key=lambda r: (r["at"], r["id"])):
        before = total.get(r["key"], 0)
        total[r["key"]] = before + r["v"]
        want[r["id"]] = total[r["key"]] if inclusive else before
    args = ("key", ["at", "id"], F.col("v"), "s", inclusive)
    for heavy in ([], ["hot"], ["hot", "k1", "absent", None], None):
        got = running_sum(table, *args, heavy=heavy, rows=600)
        assert {r["id"]: r["s"] for r in got.collect()} == want
        assert got.columns == [*table.columns, "s"]


def test_hot_key_is_cut(table):
    """The window of a hot key runs in pieces of about even size, all rows in one shuffle by (key, piece)."""
    from leafmill.plans.scan import _splitters

    (cuts,) = _splitters(table, "key", ["at", "id"], ["hot"], 600).collect()
    assert 10 <= len(cuts["_cuts"]) <= 24
    plan = running_sum(table, "key", ["at", "id"], F.lit(1), "n", heavy=["hot"])._jdf.queryExecution().toString()
    assert "hashpartitioning(key" in plan and "_piece" in plan


def test_chunks(spark, table, rows):
    for heavy in ({}, {"hot": 3_000_000}):
        chunks = R.chunk_batches(table.where("key = 'hot'"), "key", "id", 100, heavy=heavy)
        got = rows(chunks, "id")
        assert [(r["chunk"], r["idx"]) for r in got] == [(i // 100, i % 100) for i in range(len(got))]
    batches = rows(R.collect_batches(chunks.withColumn("url", F.col("id")), "key"), "chunk")
    assert len(batches) == 100 and all(len(b["urls"]) == 100 for b in batches)
    assert [u for b in batches for u in b["urls"]] == [r["id"] for r in got]


def test_sessions(table):
    events = table.withColumn("type", F.when(F.col("v") == 0, "done").when(F.col("v") == 1, "error").otherwise("page"))
    plain, split = (
        {r["id"]: r["session"] for r in V.sessionise(events, "key", ("at", "id"), heavy=h).collect()} for h in ({}, {"hot": 3_000_000})
    )
    assert plain == split and max(plain.values()) > 1000


def test_cache_state(table):
    logs = table.select(
        F.col("id"), F.col("key").alias("url"), F.col("at").alias("started_at_ms"), (F.col("v") > 6).alias("good"),
        (F.col("v") == 2).alias("skip_cache"),
    )
    seen, want = set(), {}
    for r in sorted(logs.collect(), key=lambda r: (r["started_at_ms"], r["id"])):
        hit = r["url"] in seen and r["url"] is not None and not r["skip_cache"]
        want[r["id"]] = "hit" if hit else "miss"
        if r["good"]:
            seen.add(r["url"])
    for heavy in ({}, {"hot": 3_000_000}):
        got = {r["id"]: r["cache_state"] for r in G.cache_state(logs, F.col("good"), heavy=heavy).collect()}
        assert got == want


def test_final_attempts(spark, rows):
    attempts = spark.createDataFrame(
        [
            ("slow", 0, 429, "RATE_LIMIT_EXCEEDED", True), ("slow", 1, 200, None, None),
            ("quota", 0, 429, "MONTHLY_QUOTA_EXCEEDED", False), ("quota", 1, 200, None, None),
            ("busy", 0, 503, None, True), ("busy", 1, 200, None, None), ("busy", 2, 200, None, None),
            ("dead", 0, 502, None, None), ("dead", 1, 504, None, None), ("dead", 2, 503, None, None), ("dead", 3, 200, None, None),
            ("net", 0, 0, None, True), ("net", 1, 408, None, True), ("net", 2, 500, None, None),
        ],
        "request_id string, attempt int, status int, code string, retryable boolean",
    )
    got = {r["request_id"]: (r["attempts"], r["status"], r["success"]) for r in rows(G.final_attempts(attempts))}
    assert got == {
        "slow": (2, 200, True), "quota": (1, 429, False), "busy": (2, 200, True), "dead": (3, 503, False),
        "net": (3, 500, False),
    }
    once = {r["request_id"]: r["attempts"] for r in rows(G.final_attempts(attempts, max_retries=0))}
    assert set(once.values()) == {1}


def test_logs(spark, rows):
    logs = spark.createDataFrame([("a", 200), ("b", 500)], "id string, status int")
    ids = spark.createDataFrame([(1, "a"), (2, "x"), (3, "a")], "ask int, id string")
    for heavy in ({}, {"a": 3_000_000}):
        got = rows(G.get_logs(ids, logs, heavy=heavy), "ask")
        assert [r["status"] for r in got] == [200, None, 200] and got[1]["error"]["status"] == 404
        docs = spark.createDataFrame([("a", "body"), ("c", "other")], "id string, markdown string")
        found = rows(G.get_log_results(ids, logs, docs, heavy=heavy), "ask")
        assert [(r["ask"], r["markdown"]) for r in found] == [(1, "body"), (3, "body")]
    assert rows(G.missing_logs(docs, logs)) == [{"id": "c", "markdown": "other"}]


def test_folded_hits(spark, rows):
    events = spark.createDataFrame(
        [(1, 1, "r", "page", ["a", "b"]), (2, 2, "r", "page", None), (3, 3, "r", "page", ["c"]), (4, 4, "r", "done", None),
         (5, 5, "q", "page", ["d"])],
        "ts int, event_id int, request_id string, type string, urls array<string>",
    ).withColumn("web", F.transform("urls", lambda u: F.struct(u.alias("url"))))
    none = F.lit(None)
    events = events.withColumns(
        {"partial": none.cast("boolean"), "credits_used": F.when(F.col("type") == "done", 2.0), "id": none.cast("string"),
         "code": none.cast("string"), "message": none.cast("string")}
    )
    for heavy in ({}, {"r": 3_000_000}):
        got = rows(V.folded_hits(events, heavy=heavy), "request_id", "position")
        assert [(r["request_id"], r["position"], r["url"]) for r in got] == [
            ("q", 1, "d"), ("r", 1, "a"), ("r", 2, "b"), ("r", 3, "c"),
        ]
    folded = {r["request_id"]: r for r in rows(V.fold_events(events))}
    assert (folded["r"]["pages"], folded["r"]["hits"], folded["r"]["outcome"], folded["r"]["credits_used"]) == (3, 3, "done", 2.0)
    assert folded["q"]["outcome"] == "open"
