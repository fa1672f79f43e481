"""Registered queries of the text operators, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import (
    bpe,
    divergence,
    exact_dedup,
    hard_negatives,
    near_dedup,
    packing,
    pii,
    quality,
    secret_scan,
    sql,
    staging,
    substring_dedup,
    suffix_dedup,
    token_counts,
    token_files,
    tokens,
)
from loadlens.llm.staging import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = dict(sql.ORACLES)


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging.find_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(documents(spark, sf_dir))


@query
def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokens.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    parts = stage(packing.pieces(documents(spark, sf_dir), vocabulary), "pieces")
    return packing.pack(parts.drop("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokens.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    path = staging.new_folder(spark, "token-files")
    token_files.write(documents(spark, sf_dir), path, vocabulary, end_id=2)
    return token_files.crc32(token_files.read(spark, path))


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    decoded = bpe.decode(bpe.encode(documents(spark, sf_dir), ranks), ranks)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids_text", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(documents(spark, sf_dir)))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(suffix_dedup.remove(documents(spark, sf_dir)))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(substring_dedup.remove(documents(spark, sf_dir)))


@query
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(documents(spark, sf_dir), words=4, percent=80)


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir))
    return found.select("doc_id", "start", "stop", F.sha2("value", 256).alias("value_sha256"), "probability", "secret")


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = tokens.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    stored = stage(token_counts.prefix_counts(documents(spark, sf_dir), vocabulary), "prefix-counts")
    return token_counts.fit(stored, 1024).select("doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars", "fit_tokens")


@query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging.find_package(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0, label=label)
