"""Registered queries of this subpackage, one for each operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import (
    decontaminate, licenses, order_minhash, phrases, pieces, quality, repeats, secret_scan, sharding, spelling, token_counts,
    urls, vectors,
)
from leafmill.llm import sql as S
from registry.base import Entries

ENTRIES = Entries()
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SHARDS = [f"shard-{k:04d}" for k in range(256)]

BLOCK, ALLOW = ["net/", "example.com/de/"], ["example.net/en/", "org/fr/"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_digests(encoded: DataFrame) -> DataFrame:
    """Counts and digests of what encode_decode() returns."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@ENTRIES.add("op3_sentencepiece")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(pieces.encode_decode(table(spark, sf_dir, "documents"), PIECE_MODEL))


@ENTRIES.add("op6_quality_rules", S.OP6)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judged(docs).select("doc_id", *quality.BASE, "base_failed", "kept")


@ENTRIES.add("op7_url_filter", S.OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark, BLOCK, ALLOW))


@ENTRIES.add("op9_secret_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))

    def joined(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id", *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in secret_scan.KINDS[:3]),
        F.sha2(joined(of(*secret_scan.KINDS[:3])), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


@ENTRIES.add("op1_license_scan", S.op1())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.template_table(spark))


@ENTRIES.add("op4_sharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), SHARDS)


@ENTRIES.add("op8_token_counts")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, RANKS, public_tokenizers.PATTERN)


@ENTRIES.add("op10_decontamination", S.OP10)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@ENTRIES.add("op5_suffix_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@ENTRIES.add("op2_order_minhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@ENTRIES.add("op11_vector_dedup", S.OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.vector_classes(table(spark, sf_dir, "embeddings"))


@ENTRIES.add("op12_spelling_variants", S.OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


@ENTRIES.add("op13_phrases", S.OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))
