"""Files of token ids in Simple-8b words.

A folder of files in ascending order of id. Each row of a file is a segment of whole documents:

    shard, segment   place in the order; shards are ranges of ids
    doc_ids, starts, lengths   the documents, ``starts`` counted from the start of the shard
    words, offsets, escapes   the ids of all of them in Simple-8b blocks (module ``simple8b``)

Parquet is the container, so that any store Spark can reach will do and a lost task leaves no part
of a file. A reader of some documents decodes only the blocks they lie in.

Defined results: NULL and empty texts hold the end id alone. Repeated rows are written each, in any
order among themselves. No rows give an empty folder of files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlens.llm import simple8b
from loadlens.llm.tokens import encoder, some, text_of

FORMAT = (
    "shard int, segment int, first_id bigint, n_ids bigint, doc_ids array<bigint>, starts array<bigint>, "
    "lengths array<bigint>, words binary, offsets array<int>, escapes binary"
)
_TYPES = (
    pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
    pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int32()), pa.binary(),
)
_NAMES = [x.split()[0] for x in FORMAT.split(", ")]


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int, shards: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode ``docs`` and write the files. Without ``shards`` Spark decides on them: at most the shuffle
    partitions, small ones put together where adaptive execution may."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard, start = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for segment, (doc_ids, texts) in enumerate(some(batches)):
            parts = [x + end for x in own.encode(texts)]
            lengths = np.array([len(x) // 4 for x in parts], np.int64)
            words, offsets, escapes = simple8b.encode(np.frombuffer(b"".join(parts), "<u4"))
            total = int(lengths.sum())
            row = (
                shard, segment, doc_ids[0], total, doc_ids, start + np.cumsum(lengths) - lengths,
                lengths, words.astype("<u8").tobytes(), offsets, escapes.tobytes(),
            )
            start += total
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _TYPES)], _NAMES)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    dealt = rows.repartitionByRange(shards, "doc_id") if shards else rows.repartitionByRange("doc_id")
    ordered = dealt.sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, FORMAT).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each document; ``start`` counts the ids of all documents
    before it, ``ids`` are little-endian unsigned 32-bit integers."""
    files = spark.read.schema(FORMAT).parquet(path)
    # one row a shard: their order is that of their first documents
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n"), F.min("first_id").alias("least"))
    before = Window.orderBy("least", "shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values = simple8b.decode(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["escapes"], np.uint8))
                raw, at, parts = values.astype("<u4").tobytes(), 0, []
                for n in row["lengths"]:
                    parts.append(raw[at : at + 4 * n])
                    at += 4 * n
                starts = np.array(row["starts"], np.int64) + row["first"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(starts), pa.array(row["lengths"], pa.int64()), pa.array(parts, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    columns = ["first", "doc_ids", "starts", "lengths", "words", "escapes"]
    # sent to the files, one row a shard; else they may be shuffled by it, whole
    return files.join(F.broadcast(firsts), "shard").select(*columns).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def crc32(rows: DataFrame) -> DataFrame:
    """``rows`` of ``read`` with the checksum of their ids in place of the ids."""
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
