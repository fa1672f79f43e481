"""The corpus pipeline: stages over ``documents``, each one written and read again."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import exact_dedup, near_dedup, packing, quality, secret_scan, staging, tokens

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Whose the folders are that the stages store intermediate tables in.
OWNER = "corpus pipeline"


def _stage(fn: Stage) -> Stage:
    """A stage whose folders go when the next one begins, since its result is written by then."""

    @wraps(fn)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        staging.find_package(spark)
        staging.clean(spark, OWNER)
        with staging.owned_by(OWNER):
            return fn(spark, docs, sf_dir)

    return call


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules or the learned list reject go: texts that are NULL, empty or short too.
    Each row is judged by its own text, rows without an id and rows that share one included."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_stage
def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that of the largest id; NULL counts as empty. Rows
    that share text and id all stay, and so does a group without any id."""
    return exact_dedup.keep_one(docs)


@_stage
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones stays, that of the least id. Rows without an id and
    texts without words stay. Rows that share an id stay or go together."""
    return near_dedup.keep_one(docs)


@_stage
def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked and ``n_chars`` counted anew; every row stays, by whatever id. NULL texts stay
    NULL."""
    masked = secret_scan.clean(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


@_stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their token ids and their places in the sequences. NULL and
    empty texts are a piece of the end id alone; repeated rows and rows without an id are packed each."""
    packed = packing.pack_documents(docs, tokens.read_vocabulary(TOKENIZER))
    return packed.select("sequence_id", "offset", "doc_id", "piece", "start", "length", "ids_crc32", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("secret scan", secret_stage),
    ("best-fit packing", packing_stage),
]

#: Merges, a learned forest and sketches are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what is left in the shared folder is what the rows of the last one are read from."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = staging.new_folder(spark, name.replace(" ", "-"))
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            staging.delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
