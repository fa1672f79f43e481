"""Token ids of whole texts by a tokenizer file of the public ``tokenizers`` library.

For a byte-level file the texts are cut by ``pretoken`` and only pieces not met before go through
the library's merges; the ids of the others come from a cache of bounded size in each worker. Strings
of the file's added tokens are single ids, as the library has them. Files with any other normaliser
or pre-tokeniser, or with added tokens that strip or want whole words, are handed whole texts. Pieces
are looked up once for each run of texts, and their ids are put in order by Arrow.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm import pretoken

#: Pieces that a worker remembers; beyond it the cache starts anew.
CACHED = 700_000


def read_vocabulary(path: str) -> str:
    """Content of a tokenizer file. It is read on the driver and travels with the tasks (a fixed
    size, some MB), so executors need no such file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level files write for each byte: printable Latin-1 stays, the
    others are numbered from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {byte: chr(byte) for byte in plain}
    for byte in range(256):
        if byte not in letters:
            letters[byte] = chr(256 + len(letters) - len(plain))
    return letters


class _Pieces(dict):
    """Ids of a piece as little-endian 32-bit integers, made at first use."""

    def __init__(self, model):
        self.model, self.letters = model, byte_letters()

    def __missing__(self, piece: bytes) -> bytes:
        tokens = self.model.tokenize(piece.decode("latin-1").translate(self.letters))
        ids = self[piece] = np.array([x.id for x in tokens], "<u4").tobytes()
        return ids


class Encoder:
    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        kind = json.loads(vocabulary)
        before, added = kind.get("pre_tokenizer") or {}, kind.get("added_tokens") or []
        self.plain = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not kind.get("normalizer")
            and not any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in added)
        )
        self.added = {x["content"]: np.array([x["id"]], "<u4").tobytes() for x in added}
        longest = sorted(self.added, key=len, reverse=True)  # where several start at one place
        self.cuts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if added else None
        self.pieces = _Pieces(self.tokenizer.model)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text, in order."""
        if not self.plain:
            for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                yield np.array(x.ids, "<u4").tobytes()
            return
        if self.cuts is None or not any(self.cuts.search(x) for x in texts):
            yield from self._ordinary(texts)
            return
        parts = [self.cuts.split(x) for x in texts]  # ordinary text and added tokens by turns
        made = self._ordinary([x for own in parts for x in own[::2]])
        for own in parts:
            yield b"".join(self.added[x] if k % 2 else next(made) for k, x in enumerate(own))

    def _ordinary(self, texts: list[str]) -> Iterator[bytes]:
        """``encode`` of texts without added tokens."""
        for _, _, raw, places, bounds in pretoken.cuts(texts):
            if len(self.pieces) > CACHED:
                self.pieces.clear()
            buffers = [None, pa.py_buffer(places.astype("<i8")), pa.py_buffer(raw)]
            coded = pa.Array.from_buffers(pa.large_binary(), len(places) - 1, buffers).dictionary_encode()
            _, distinct, own = coded.dictionary.buffers()
            distinct, own = np.frombuffer(distinct, "<i8")[: len(coded.dictionary) + 1].tolist(), own.to_pybytes()
            known = [self.pieces[own[a:b]] for a, b in zip(distinct, distinct[1:])]
            ids = pa.array(known, pa.large_binary()).take(coded.indices)  # one after the other, as in the texts
            at, joined = np.frombuffer(ids.buffers()[1], "<i8"), memoryview(ids.buffers()[2])
            first = 0
            for stop in bounds:
                yield bytes(joined[at[first] : at[stop]])
                first = stop + 1


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One per worker process, with the pieces that earlier tasks have met."""
    return Encoder(vocabulary)


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def some(rows: Iterator[pa.RecordBatch], chars: int = 2_000_000) -> Iterator[tuple[list[int], list[str]]]:
    """(ids, texts) of a few rows at a time, with about so many characters, whatever the batch size."""
    for batch in rows:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        first = size = 0
        for k, n in enumerate(pc.binary_length(texts).to_pylist()):
            if k > first and size + n > chars:
                yield ids[first:k], texts[first:k].to_pylist()
                first, size = k, 0
            size += n
        if first < len(ids):
            yield ids[first:], texts[first:].to_pylist()


def encode(docs: DataFrame, vocabulary: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of each row: ids as little-endian unsigned 32-bit integers, ``end_id`` after
    them. NULL text counts as empty; each repeated row is encoded; other columns are not read."""
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for ids, texts in some(batches):
            values = [x + end for x in own.encode(texts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values, pa.binary())], ["doc_id", "ids"])

    return docs.select(F.col(id_col).cast("bigint"), text_of(text_col)).mapInArrow(run, "doc_id bigint, ids binary")
