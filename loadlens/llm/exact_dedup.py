"""Exact duplicates through a persistent index of digests.

The index is a table bucketed and sorted by digest. A batch of new documents is reduced to one row
per digest, matched against the index by a sort-merge anti join, and the digests not seen before
are appended. Both sides are dealt by digest into the same number of buckets, so the index side of
every join is read without a shuffle, however large it has grown.

Defined results: NULL text counts as empty, and empty texts are equal. Of equal texts of one batch
the row with the largest id stays; a text that the index has already keeps the row it has there.
Rows with the same id and text count each, and all of them are marked kept if they hold the keep
id. A row without an id stays only if its group has no id at all. An empty batch returns no rows and leaves the index as it is. Only the two named columns are
read, so any further columns may have any names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm.staging import new_folder, stage

#: Buckets of an index, at least. Fixed when an index is made; 4096 buckets hold some 10^12 digests.
BUCKETS = 16
#: Slots that the rows of one digest are spread over, so that no group of copies meets in one task.
SALTS = 32


def open_index(spark: SparkSession, path: str, buckets: int = BUCKETS) -> str:
    """Name of the index table at ``path``, registered in this session; made empty if not there."""
    name = "digest_index_" + uuid.uuid5(uuid.NAMESPACE_URL, path).hex
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (digest STRING, keep_id BIGINT, group_size BIGINT) "
        f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
        f"LOCATION '{path}'"
    )
    return name


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, slot) of each document: SHA-256 of the text in UTF-8, nothing normalised."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("digest"),
    ).withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("smallint"))


def add_batch(docs: DataFrame, index: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Append the new digests of ``docs`` to ``index``; the decision for each document as
    (doc_id, keep_id, group_size, kept, text_sha256). ``group_size`` counts the rows of the text in
    this batch and, when the index had the text before, those of the batch that brought it.

    Copies are counted per (digest, slot) first. The decision goes back to the rows on the same
    pair, one row a pair, so a text that a third of all documents share is spread over the slots
    and nothing is multiplied.
    """
    spark = docs.sparkSession
    rows = stage(digests(docs, id_col, text_col), "digests")
    slots = rows.groupBy("digest", "slot").agg(F.max("doc_id").alias("top"), F.count("*").alias("n"))
    groups = stage(
        slots.groupBy("digest").agg(
            F.max("top").alias("top"), F.sum("n").alias("n"), F.collect_list("slot").alias("slots")
        ),
        "groups",
    )
    known = spark.table(index)
    fresh = groups.join(known.hint("merge"), "digest", "left_anti").select(
        "digest", F.col("top").alias("keep_id"), F.col("n").alias("group_size")
    )
    # decisions are fixed before the index grows
    decided = stage(
        groups.join(known.hint("merge"), "digest", "left").select(
            "digest",
            F.explode("slots").alias("slot"),
            F.coalesce("keep_id", "top").alias("keep_id"),
            (F.col("n") + F.coalesce("group_size", F.lit(0))).alias("group_size"),
        ),
        "decisions",
    )
    buckets = int(
        spark.sql(f"DESCRIBE EXTENDED {index}").where("col_name = 'Num Buckets'").first()["data_type"]
    )
    # dealt by digest into the buckets of the index: each task writes one bucket file
    fresh.repartition(buckets, "digest").write.insertInto(index)
    return rows.join(decided, ["digest", "slot"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``add_batch`` against a new index. It has a bucket for each shuffle partition, so that its rows
    are written as they are dealt, one file a task: with fewer buckets than tasks every task would
    write a small file into each bucket."""
    spark = docs.sparkSession
    buckets = max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return add_batch(docs, open_index(spark, new_folder(spark, "digest-index"), buckets), id_col, text_col)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Rows are told apart by id and text:
    rows that share both all stay."""
    kept = dedup(docs, id_col, text_col).where("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__digest")
    )
    digest = F.sha2(F.coalesce(docs[text_col], F.lit("")).cast("binary"), 256)
    return docs.join(
        kept, docs[id_col].cast("bigint").eqNullSafe(kept["__id"]) & (digest == kept["__digest"]), "left_semi"
    )
