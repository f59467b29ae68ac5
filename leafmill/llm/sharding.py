"""Operator 4: placement by a permutation-filled lookup table.

Each shard has an order of preference over all slots of a table of prime size: it starts at one hash of its name and
steps by another. The shards take turns, each claiming the next slot on its list that is still free, until the table is
full. So slots are shared evenly (counts differ by one), and when a shard goes, nearly all other slots keep theirs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots: a prime, at least a hundred times the number of shards. The table has this many rows whatever the input.
SLOTS = 65_537


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> np.ndarray:
    """The number of the shard (in the order given) that holds each slot."""
    if len(set(shards)) != len(shards) or not 0 < len(shards) <= slots:
        raise ValueError("shards must be distinct, at least one, and no more than slots")
    if slots < 3 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be an odd prime")
    at = [xxhash.xxh64_intdigest(s, seed=1) % slots for s in shards]
    step = [xxhash.xxh64_intdigest(s, seed=2) % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while free:
        for k in range(min(len(shards), free)):
            slot = at[k]
            while table[slot] >= 0:
                slot = (slot + step[k]) % slots
            table[slot] = k
            at[k] = slot
        free -= min(len(shards), free)
    return np.array(table, np.int32)


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: 60 bits of the MD5 of its text, so that other systems can find a row's shard too."""
    bits = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10)
    return F.pmod(bits.cast("long"), F.lit(slots)).cast("int")


def table_rows(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard): one row for each slot."""
    rows = [(i, shards[k]) for i, k in enumerate(lookup_table(shards, slots).tolist())]
    return spark.createDataFrame(rows, "slot int, shard string")


def place(df: DataFrame, shards: Sequence[str], key: str = "doc_id", slots: int = SLOTS) -> DataFrame:
    """`df` with `slot` and `shard`. Equal keys meet in one shard; a null key is placed as the empty text.

    The table has `slots` rows, so it is always broadcast; no row of `df` is shuffled. Columns of `df` that are called
    slot or shard are replaced. An empty table gives an empty table.
    """
    table = F.broadcast(table_rows(df.sparkSession, shards, slots))
    return df.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), slots)).join(table, "slot", "left").select(
        *(c for c in df.columns if c not in ("slot", "shard")), "slot", "shard"
    )


def write_shards(df: DataFrame, path: str, shards: Sequence[str], key: str = "doc_id", files: int = 8) -> None:
    """Parquet under `path`, a folder for each shard, about `files` files in each, so no task writes a whole shard."""
    piece = F.pmod(F.xxhash64(*(F.col(c) for c in df.columns)), F.lit(files))
    placed = place(df, shards, key).withColumn("_piece", piece)
    placed.repartition(len(shards) * files, "shard", "_piece").drop("_piece").write.partitionBy("shard").parquet(path)
