"""Run a function over whole texts in Arrow batches, a bounded number of bytes at a time."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leafmill.session import checkpoint_root

#: Bytes of text that a task holds as Python objects at once; a single longer text is a piece of its own.
PIECE_BYTES = 4 << 20


def text_pieces(batch: pa.RecordBatch, column: int = 1, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most `limit` bytes in the string column, or one row."""
    if not batch.num_rows:
        return
    texts = batch.column(column)
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = np.cumsum(sizes, dtype=np.int64)
    start, done = 0, 0
    while start < len(at):
        stop = max(start + 1, int(np.searchsorted(at, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start, done = stop, int(at[stop - 1])


def importable(spark: SparkSession) -> None:
    """Python workers find this library where the driver has it, if it came neither by --py-files nor PYTHONPATH."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def with_columns(df: DataFrame, text_col: str, make: Callable[[], Callable[[list[str]], list]], fields: str) -> DataFrame:
    """`df` with `fields` added. `make()` is called once in a task and gives a function from texts (null: empty) to one
    list or Arrow array for each field. The names of the fields must not be names of `df`."""
    added = StructType.fromDDL(fields)
    if clash := set(added.names) & set(df.columns):
        raise ValueError(f"columns {sorted(clash)} exist already")
    schema = StructType([*df.schema, *added])
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        types = [f.type for f in to_arrow_schema(added)]
        work = make()
        for batch in batches:
            for piece in text_pieces(batch, at):
                got = work([t or "" for t in piece.column(at).to_pylist()])
                arrays = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(got, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*piece.columns, *arrays], schema.names)
        pa.default_memory_pool().release_unused()  # the worker waits for other tasks, maybe of other operators

    importable(df.sparkSession)
    return df.mapInArrow(run, schema)


def over_texts(
    df: DataFrame, id_col: str, text_col: str, make: Callable[[], Callable[[list[str]], list]], fields: str
) -> DataFrame:
    """(id, fields) for each row of `df`; see with_columns(). Only the two columns are read."""
    source = df.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return with_columns(source, "_text", make, fields).drop("_text")


def shared_folder(spark: SparkSession) -> None:
    """Checkpoints go to the folder that the cluster names in spark.checkpoint.dir; tests set one of their own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_root(spark))


def kept(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder: later reads don't compute it again, and a lost executor costs no more
    than its own tasks."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """`df` as a Parquet table in the shared folder: narrower than a checkpoint, and Spark knows its size. spent() removes
    it before the session ends."""
    path = f"{checkpoint_root(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.written_at = path
    return back


def spent(df: DataFrame) -> None:
    """Removes what written() wrote. Nothing that is still to be computed may read it."""
    context = df.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(df.written_at)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def small_side(df: DataFrame, most_rows: int) -> DataFrame:
    """`df` marked for broadcast if it has at most `most_rows` rows, which are counted first; else as it is, so that the
    join shuffles both sides."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df
