"""Run registered queries next to their SQL and compare rows, column by column name."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple((type(r[i]).__name__, r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, sf_dir):
    """None if equal, else what differs."""
    df = fn(spark, sf_dir)
    got_cols, got = _rows(df.columns, df.collect())
    cur = con.execute(sql)
    want_cols, want = _rows([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        more, less = got - want, want - got
        return (
            f"{sum(more.values())} rows only in Spark, {sum(less.values())} only in SQL of {sum(want.values())}\n"
            f"  spark {str(next(iter(more), None))[:600]}\n  sql   {str(next(iter(less), None))[:600]}"
        )
    return None if sum(got.values()) else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from leafmill.session import build_session

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark = build_session("local[8]", "check", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        start = time.time()
        try:
            if name in oracles:
                told = compare(spark, con, fn, oracles[name], sf_dir) or "ok"
            else:
                told = f"rows only: {fn(spark, sf_dir).count()}"
        except Exception as e:  # noqa: BLE001
            told = f"{type(e).__name__}: {str(e)[:1200]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {told}", flush=True)
    spark.stop()
