"""Best-fit packing of documents into sequences by minimum bin slack.

A bin is opened with the longest piece left. A bitset of the sums that the lengths still available
can reach (subset-sum dynamic programming, one machine word per 64 sums) then tells the fullest
feasible rest, which is removed. Pieces of one length are interchangeable, so the search runs on
the histogram of lengths, at most one entry per length up to the capacity: a combination found is
used again until one of its lengths runs out, which gives at most as many combinations as there
are lengths. The histogram and the combinations are all that reaches the driver, and their size
depends on the capacity alone. The pieces never move: each learns its number among the pieces of
its length, and the combinations tell the place of that number.

Defined results: NULL and empty texts make one piece that holds the end id alone. Repeated rows
are packed each. No rows give no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.staging import stage
from loadlens.llm.tokens import encoder, some, text_of

CAPACITY = 2048

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids binary, ids_crc32 bigint, shard int, number bigint"


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of so many ids; only the first may be shorter."""
    first = total % capacity or min(total, capacity)
    starts = [0, *range(first, total, capacity)]
    return list(zip(starts, [first, *[capacity] * (len(starts) - 1)]))


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of each document with their ids. ``number`` counts the pieces of one length in one
    partition (``shard``)."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard, seen = encoder(vocabulary), TaskContext.get().partitionId(), {}
        for doc_ids, texts in some(batches):
            rows = []
            for doc_id, ids in zip(doc_ids, own.encode(texts)):
                ids += end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start : 4 * (start + length)]
                    number = seen[length] = seen.get(length, -1) + 1
                    rows.append((doc_id, k, start, length, part, zlib.crc32(part), shard, number))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64())
            names = [x.split()[0] for x in PIECE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return docs.select(F.col(id_col).cast("bigint"), text_of(text_col)).mapInArrow(run, PIECE)


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of which of ``lengths`` fill ``room`` best; longer ones are tried first."""
    mask, reach, taken = (1 << room + 1) - 1, 1, []
    for length in lengths:
        left, part = min(counts[length], room // length), 1
        while left > 0:  # 1, 2, 4, ... of a length stand for any number of it
            part = min(part, left)
            taken.append((length, part, reach))
            reach |= (reach << length * part) & mask
            left -= part
            part *= 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, part, before in reversed(taken):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + part
            at -= length * part
    return chosen


def combinations(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, pieces of each length in such a bin), for all pieces of the histogram."""
    counts = {k: n for k, n in sorted(histogram.items(), reverse=True) if n}
    found = []
    while counts:
        longest = next(iter(counts))
        counts[longest] -= 1
        bin_ = fullest(list(counts), counts, capacity - longest)
        counts[longest] += 1
        bin_[longest] = bin_.get(longest, 0) + 1
        times = min(counts[length] // n for length, n in bin_.items())
        for length, n in bin_.items():
            counts[length] -= times * n
            if not counts[length]:
                del counts[length]
        found.append((times, bin_))
    return found


def places(found: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """For runs of numbers of one length, ordered by (length, number): the first sequence, the
    pieces of that length in each sequence and the offset of the first of them."""
    rows, used, sequence = [], {}, 0
    for times, bin_ in found:
        offset = 0
        for length, n in sorted(bin_.items(), reverse=True):
            rows.append((length, used.get(length, 0), sequence, n, offset))
            used[length] = used.get(length, 0) + times * n
            offset += length * n
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "number", "sequence", "each", "offset"), table.T))


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each piece (length, shard and number as ``pieces`` makes them) its ``sequence_id`` and
    its ``offset`` there. ``parts`` is read twice and should be a stored table."""
    counted = parts.groupBy("length", "shard").agg(F.count("*").alias("n"))
    counted = stage(counted, "lengths")
    # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(combinations(histogram, capacity))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counted.select("length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    numbered = parts.join(firsts, ["length", "shard"]).withColumn("number", F.col("number") + F.col("first")).drop("first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (table["length"] << 44) + table["number"]
        for batch in batches:
            length, number = (batch.column(x).to_numpy() for x in ("length", "number"))
            k = np.searchsorted(keys, (length << 44) + number, "right") - 1
            turn = number - table["number"][k]
            sequence = table["sequence"][k] + turn // table["each"][k]
            offset = table["offset"][k] + turn % table["each"][k] * length
            yield batch.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema)
    return numbered.mapInArrow(run, f"{kinds}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_ids, ids) of each sequence, the ids of its pieces one after another."""
    own = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_ids"),
        F.aggregate(own, F.lit(b"").cast("binary"), lambda out, x: F.concat(out, x["ids"])).alias("ids"),
    )


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``pieces`` stored in the shared folder, then ``pack``."""
    return pack(stage(pieces(docs, vocabulary, capacity, end_id, id_col, text_col), "pieces"), capacity)
