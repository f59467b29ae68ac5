"""Running sums per key that also hold when one key has a third of all rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leafmill.plans import skew

_OVERSAMPLE = 20


def _splitters(df: DataFrame, key: str, order: Sequence[str], heavy: Iterable, rows: int) -> DataFrame:
    """Per hot key, the boundaries in `order` of its pieces of about `rows` rows, from a hash sample of 20 rows a piece.

    The sample depends on row values alone, so every evaluation gives the same boundaries. It sets where a key is
    cut, never which rows are used. All keys together have no more boundaries than twice the rows of the table / `rows`.
    """
    mine = df.where(skew.is_heavy(F.col(key), heavy)).select(F.col(key).alias("_cut_key"), F.struct(*order).alias("_at"))
    sizes = mine.groupBy(F.col("_cut_key").alias("_size_key")).agg(F.count(F.lit(1)).alias("_rows"))
    wanted = F.ceil(F.col("_rows") / rows) * _OVERSAMPLE
    hit = F.pmod(F.xxhash64("_at"), F.lit(1 << 30)) < F.lit(float(1 << 30)) * wanted / F.col("_rows")
    same = F.col("_cut_key").eqNullSafe(F.col("_size_key"))
    sample = mine.join(F.broadcast(sizes), same).where(hit)  # one row per hot key: at most MOST_HEAVY
    points = sample.groupBy("_cut_key").agg(F.sort_array(F.collect_list("_at")).alias("_points"))
    return points.select("_cut_key", F.filter(F.col("_points"), lambda p, i: i % _OVERSAMPLE == 0).alias("_cuts"))


def running_sum(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: Column,
    out: str,
    inclusive: bool = True,
    heavy: Iterable | None = None,
    rows: int | None = None,
) -> DataFrame:
    """`sum(value)` over earlier rows of the same key (and the row itself if `inclusive`), as BIGINT. NULL is a key too.

    `order` must be unique within a key. Keys of ordinary size are one window partition each. A hot key, NULL included, is
    cut into ordered pieces of about `rows` rows (ROWS_PER_TASK): the window runs per (key, piece), and the totals of the
    pieces before are added from a table of one row a piece, which is why it may be broadcast. Rows are shuffled once.
    """
    rows = rows or skew.ROWS_PER_TASK
    if heavy is None:
        heavy = skew.heavy_values(df, key, rows)
    last = 0 if inclusive else -1
    df = df.withColumn("_v", value.cast("bigint"))
    if not heavy:
        w = W.partitionBy(key).orderBy(*order).rowsBetween(W.unboundedPreceding, last)
        return df.withColumn(out, F.coalesce(F.sum("_v").over(w), F.lit(0))).drop("_v")

    cuts = _splitters(df, key, order, heavy, rows)
    at = F.struct(*order)
    passed = F.aggregate("_cuts", F.lit(0), lambda n, c: n + F.when(c <= at, F.lit(1)).otherwise(F.lit(0)))
    same_key = F.col(key).eqNullSafe(F.col("_cut_key"))
    parted = (
        df.join(F.broadcast(cuts), same_key & skew.is_heavy(F.col(key), heavy), "left")
        .withColumn("_piece", F.coalesce(passed, F.lit(0)))
        .drop("_cut_key", "_cuts")
    )
    totals = parted.where(skew.is_heavy(F.col(key), heavy)).groupBy(key, "_piece").agg(F.sum("_v").alias("_total"))
    before = W.partitionBy(key).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(
        F.col(key).alias("_cut_key"), F.col("_piece").alias("_at"),
        F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_carry"),
    )
    w = W.partitionBy(key, "_piece").orderBy(*order).rowsBetween(W.unboundedPreceding, last)
    local = parted.withColumn(out, F.coalesce(F.sum("_v").over(w), F.lit(0)))
    return (
        local.join(F.broadcast(carry), same_key & (F.col("_piece") == F.col("_at")), "left")
        .withColumn(out, F.col(out) + F.coalesce("_carry", F.lit(0)))
        .drop("_v", "_piece", "_cut_key", "_at", "_carry")
    )
