"""Hot keys: find them cheaply, and join without sending one key's rows to one task."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that one task may get. A key with more is spread over tasks in proportion to its rows.
ROWS_PER_TASK = 1_000_000
#: Most keys that are looked for. Beyond ROWS_PER_TASK * MOST_HEAVY rows in all, a key counts as hot from its share on.
MOST_HEAVY = 10_000


def heavy_values(df: DataFrame, key: str, rows: int | None = None) -> dict:
    """Keys, NULL among them, that hold more than `rows` rows (ROWS_PER_TASK), with their number of rows.

    Two passes over the key column: a count, and a mergeable frequent-items sketch, so nothing is shuffled by key. At most
    MOST_HEAVY keys come to the driver. They only steer how work is spread: one missing or too many, or a number that the
    sketch has too high, leaves results the same.
    """
    budget = rows or ROWS_PER_TASK
    total, nulls = df.agg(F.count(F.lit(1)), F.count_if(F.col(key).isNull())).first()
    if total <= budget:
        return {}
    floor = max(budget, total // MOST_HEAVY)
    limit = max(1, min(MOST_HEAVY, total // floor))
    top = df.agg(F.expr(f"approx_top_k(`{key}`, {limit}, {min(limit * 16, 1_000_000)})")).first()[0]
    found = {i["item"]: i["count"] for i in top or [] if i["item"] is not None and i["count"] > floor}
    return found | ({None: nulls} if nulls > floor else {})


def is_heavy(key: Column, heavy: Iterable) -> Column:
    """Whether a key is one of `heavy`; never NULL."""
    given = [k for k in heavy if k is not None]
    found = F.coalesce(key.isin(given), F.lit(False)) if given else F.lit(False)
    return found | key.isNull() if None in heavy else found


def parts_of(key: Column, heavy: dict, rows: int | None = None) -> Column:
    """Number of tasks for a key: 1, or for a hot one the power of two that keeps each within its rows."""
    by_parts: dict[int, list] = {}
    for value, n in heavy.items():
        by_parts.setdefault(1 << max(1, (-(-n // (rows or ROWS_PER_TASK)) - 1).bit_length()), []).append(value)
    out = F.lit(1)
    for parts, values in by_parts.items():
        out = F.when(is_heavy(key, values), parts).otherwise(out)
    return out


def salted_join(
    left: DataFrame, right: DataFrame, key: str, how: str, spread: Sequence[str], heavy: dict | None = None
) -> DataFrame:
    """Equi-join on `key` where `left` may have hot keys.

    Rows of a hot key are spread by a hash of `spread` over as many sub-keys as its rows need; the right rows of hot keys
    alone are repeated once per sub-key. NULL keys match nothing, so they are spread over all hash values. Every left row
    meets each of its right rows exactly once, hence any of inner, left, left_semi and left_anti is exact.
    """
    if heavy is None:
        heavy = heavy_values(left, key)
    if not heavy:
        return left.join(right, key, how)
    known = {k: n for k, n in heavy.items() if k is not None}
    hashed = F.xxhash64(*spread)
    salt = F.when(F.col(key).isNull(), hashed).otherwise(F.pmod(hashed, parts_of(F.col(key), known).cast("bigint")))
    left = left.withColumn("_salt", salt)
    copies = F.sequence(F.lit(0).cast("bigint"), (parts_of(F.col(key), known) - 1).cast("bigint"))
    right = right.withColumn("_salt", F.explode(copies))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def bounded_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    spread: Sequence[str],
    max_rows: int = 200_000,
    heavy: dict | None = None,
) -> DataFrame:
    """Join with a right side that is usually small: its rows are counted up to `max_rows` + 1 first.

    Within the bound it is broadcast; beyond it the salted join takes over.
    """
    if right.limit(max_rows + 1).count() <= max_rows:
        return left.join(F.broadcast(right), key, how)
    return salted_join(left, right, key, how, spread, heavy)
