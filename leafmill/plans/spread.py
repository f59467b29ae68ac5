"""Keep all cores busy on small inputs of heavy rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text in a partition whose tasks hold a multiple of it, as when pages are cut into sorted tokens.
PART_CHARS = 4_000_000


def spread(df: DataFrame) -> DataFrame:
    """Rows spread over the cores if the scan has fewer partitions than there are cores; else `df` as it is.

    For tables of texts and pages, where the work per row is many times the cost of moving it. A large table has more
    splits than the cluster has cores, so it is never shuffled here.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def parts_for(df: DataFrame, text_col: str) -> int:
    """Partitions that hold PART_CHARS of `text_col` on average; 0 if there are no more of these than cores.

    The lengths are summed first. Left to adaptive execution, partitions grow with the table up to 64 MB as compressed.
    """
    chars = 0 if df.isStreaming else df.agg(F.sum(F.length(text_col))).first()[0] or 0
    parts = -(-chars // PART_CHARS)
    return parts if parts > df.sparkSession.sparkContext.defaultParallelism else 0


def by_key(df: DataFrame, key: str, parts: int) -> DataFrame:
    """`df` shuffled by `key` into `parts` partitions; 0 leaves their number to Spark."""
    return df.repartition(parts, key) if parts else df.repartition(key)
