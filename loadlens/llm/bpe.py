"""Byte-level BPE by a file of ranks: encoding with offsets, and decoding.

``pretoken`` cuts whole texts; the merges of a piece are worked out once and cached in the worker,
whose cache is bounded. A piece is merged as the rank files define it: the adjacent pair of lowest
rank first, the leftmost of equal ones, until no pair has a rank.

Defined results: NULL and empty texts have no ids and decode to nothing. Repeated rows are encoded
each. Ids that the file does not have cannot be decoded and raise an error.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import pretoken
from loadlens.llm.tokens import some, text_of

#: Pieces that a worker remembers; beyond it the cache starts anew.
CACHED = 600_000
#: From this many bytes on a piece is merged with a heap, in n log n steps.
LONG = 64


def read_ranks(path: str) -> bytes:
    """Content of a rank file, read on the driver (a fixed size, under 1 MB); it travels with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines() or [])}


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one piece."""
    if piece in ranks:
        return (ranks[piece],)
    if len(piece) >= LONG:
        return _merge_long(piece, ranks)
    parts = [piece[k : k + 1] for k in range(len(piece))]
    none = len(ranks)
    pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        best = min(pairs)
        if best == none:
            break
        k = pairs.index(best)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
        del pairs[k]
        if k < len(pairs):
            pairs[k] = ranks.get(parts[k] + parts[k + 1], none)
        if k:
            pairs[k - 1] = ranks.get(parts[k - 1] + parts[k], none)
    return tuple(ranks[x] for x in parts)


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same order of merges from a heap of (rank, place, end of the pair); outdated pairs are
    known by their ends and left out."""
    n = len(piece)
    after = list(range(1, n + 1))  # end of the part that starts here, 0 if none does
    before = list(range(-1, n))
    heap = []

    def push(k: int) -> None:
        middle = after[k]
        if middle < n and (rank := ranks.get(piece[k : after[middle]])) is not None:
            heapq.heappush(heap, (rank, k, middle, after[middle]))

    for k in range(n - 1):
        push(k)
    while heap:
        _, k, middle, end = heapq.heappop(heap)
        if after[k] != middle or middle < n and after[middle] != end:
            continue
        after[k], after[middle] = end, 0
        if end < n:
            before[end] = k
        push(k)
        if before[k] >= 0:
            push(before[k])
    ids, k = [], 0
    while k < n:
        ids.append(ranks[piece[k : after[k]]])
        k = after[k]
    return tuple(ids)


class _Pieces(dict):
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        ids = self[piece] = merge(piece, self.ranks)
        return ids


class Coder:
    def __init__(self, content: bytes):
        self.ranks = parse_ranks(content)
        self.pieces = _Pieces(self.ranks)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[bytes]]]:
        """(ids, pieces) of each text."""
        for _, _, pieces, bounds in pretoken.slices(texts):
            if len(self.pieces) > CACHED:
                self.pieces.clear()
            first = 0
            for stop in bounds:
                own = pieces[first:stop]
                yield list(chain.from_iterable(map(self.pieces.__getitem__, own))), own
                first = stop + 1

    def piece_starts(self, pieces: list[bytes]) -> list[int]:
        """For each piece, the number of ids before it."""
        return list(accumulate((len(self.pieces[x]) for x in pieces[:-1]), initial=0)) if pieces else []

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def coder(content: bytes) -> Coder:
    """One per worker process."""
    return Coder(content)


def encode(docs: DataFrame, content: bytes, offsets: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids) of each row, ids as little-endian unsigned 32-bit integers; with
    ``offsets`` also the first id (``piece_ids``) and the first byte (``piece_bytes``) of each piece."""
    schema = "doc_id bigint, n_tokens bigint, ids binary"
    types = [pa.int64(), pa.int64(), pa.binary()]
    if offsets:
        schema += ", piece_ids array<bigint>, piece_bytes array<bigint>"
        types += [pa.list_(pa.int64())] * 2
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(content)
        for doc_ids, texts in some(batches):
            rows = []
            for doc_id, (ids, pieces) in zip(doc_ids, own.encode(texts)):
                row = [doc_id, len(ids), np.array(ids, "<u4").tobytes()]
                if offsets:
                    row.append(own.piece_starts(pieces))
                    row.append(list(accumulate(map(len, pieces[:-1]), initial=0)) if pieces else [])
                rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return docs.select(F.col(id_col).cast("bigint"), text_of(text_col)).mapInArrow(run, schema)


def decode(rows: DataFrame, content: bytes) -> DataFrame:
    """``rows`` of ``encode`` with the decimal ids joined by commas (``ids_text``) and the decoded
    bytes (``decoded``) in place of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(content)
        shown = {rank: str(rank) for rank in own.bytes_of}
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                lists = [np.frombuffer(x, "<u4").tolist() for x in part.column(2).to_pylist()]
                texts = [",".join(map(shown.__getitem__, x)) for x in lists]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([own.decode(x) for x in lists], pa.binary())],
                    ["doc_id", "n_tokens", "ids_text", "decoded"],
                )

    schema = "doc_id bigint, n_tokens bigint, ids_text string, decoded binary"
    return rows.select("doc_id", "n_tokens", "ids").mapInArrow(run, schema)
