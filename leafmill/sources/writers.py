"""Documents to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dump_json(df: DataFrame, exclude_none: bool = True, out: str = "value") -> DataFrame:
    """One JSON object per row; null fields are left out unless asked for."""
    body = F.to_json(F.struct(*df.columns), {"ignoreNullFields": str(exclude_none).lower()})
    return df.select(body.alias(out))


def write_documents(
    df: DataFrame, path: str, exclude_none: bool = True, format: str = "json", mode: str = "errorifexists"
) -> None:
    """Write JSON lines or parquet. Files follow the partitions of `df`; nothing is gathered first."""
    if format == "json":
        dump_json(df, exclude_none).write.mode(mode).text(path)
    else:
        df.write.mode(mode).format(format).save(path)
