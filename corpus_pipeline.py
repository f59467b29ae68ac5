"""A corpus from raw documents to token digests, in five stages. Each gets what the one before kept."""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from leafmill.llm.common import written  # noqa: E402
from leafmill.llm.decontaminate import decontaminated  # noqa: E402
from leafmill.llm.order_minhash import one_of_each  # noqa: E402
from leafmill.llm.pieces import encode_decode  # noqa: E402
from leafmill.llm.quality import quality_filter  # noqa: E402
from leafmill.llm.queries import PIECE_MODEL, table, token_digests  # noqa: E402
from leafmill.llm.secret_scan import mask_secrets  # noqa: E402

#: Cuts that an encoder keeps: fewer than op3_sentencepiece's, as executors here have the memory of the stages before.
CUTS = 100_000
#: SQL can't express these stages; tests/llm hold them against brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the fences of their language and source reject go."""
    return quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least id stays."""
    return one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with four fifths of a benchmark item's shingles go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; no document goes. n_chars follows the new text."""
    masked = mask_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of each document that is left."""
    return token_digests(encode_decode(docs, PIECE_MODEL, cuts=CUTS))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("SentencePiece encoding and decoding", piece_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written to the shared folder, and the next stage reads them from there."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
