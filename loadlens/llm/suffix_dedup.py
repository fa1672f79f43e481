"""Removal of long byte strings that occur more than once, by suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts anywhere else, in the same
document or another one, is removed; strings are judged on the input and never cross documents.
Candidate texts come from module ``repeats``; those of an anchor that are not settled by equality
go, as symbols between the places where any two of them part, into a suffix array built by
linear grouping construction (module ``suffix_array``). Neighbours in the array with a common
prefix of ``length`` bytes tell the repeated parts.

Defined results: NULL text counts as empty; texts under ``length`` bytes lose nothing unless they
repeat it, which they cannot. Of repeated strings no copy stays. Repeated rows repeat each other.
Rows that share an id are documents of their own, with one text or several. Rows without an id
keep their text and count for no other row. No rows give no rows.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import repeats
from loadlens.llm.staging import stage
from loadlens.llm.suffix_array import common_prefixes, suffix_array

LENGTH = 400
#: Bytes of a gram, or about a quarter of ``length`` if that is less.
GRAM = 64
_TABLE = repeats.mix(np.arange(1, 257, dtype=np.uint64))


def _grams(raw: np.ndarray, n: int, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place on; ``raw`` has ``gram`` bytes more than ``n``."""
    out, size = repeats.mix(np.ndarray((n + gram - 8,), "<u8", raw, strides=(1,)).copy()), 8
    while size < gram:
        out[:-size] = repeats.mix(out[:-size] + repeats.mix(out[size:] + np.uint64(size)))
        size *= 2
    return out[:n]


def _power(at_most: int, least: int) -> int:
    """The greatest power of 2 times ``least`` that is not over ``at_most``, ``least`` at least."""
    size = least
    while 2 * size <= at_most:
        size *= 2
    return size


def _texts(batch: pa.RecordBatch, at_once: int = 1_000_000) -> Iterator[tuple[int, int, list[bytes]]]:
    texts = batch.column("text").to_pylist()
    first = size = 0
    for k, text in enumerate(texts):
        if k > first and size + len(text) > at_once:
            yield first, k, texts[first:k]
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts), texts[first:]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))


def versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, version, text as bytes) of all rows, see ``repeats.with_versions``."""
    return repeats.with_versions(_rows(docs, id_col, text_col))


def segments(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    gram = _power(min(GRAM, length // 4), 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, version = batch.column("doc_id").to_numpy(), batch.column("version").to_numpy()
            for first, stop, some in _texts(batch):
                lengths = np.array([len(x) for x in some], np.int64)
                raw = np.frombuffer(b"".join(some) + bytes(gram), np.uint8)
                n = int(lengths.sum())
                found = repeats.runs(_grams(raw, n, gram), _TABLE[raw[:n]], lengths, length, gram)
                yield repeats.segment_batch(ids[first:stop], version[first:stop], found)

    return texts.where("doc_id IS NOT NULL").mapInArrow(run, repeats.SEGMENT)


def _cut(text: bytes, starts: np.ndarray, stops: np.ndarray) -> list[bytes]:
    return [text[a:b] for a, b in zip(starts.tolist(), stops.tolist())]


def by_suffix_array(strings: repeats.Strings) -> Iterator[tuple[int, int, int]]:
    """(string, start, stop) of parts that another string has at the same place."""
    text, owner, inside = array("q"), array("q"), array("q")
    for k, symbols in enumerate(strings.symbols):
        text.extend(symbols)
        text.append(0)
        owner.extend([k] * (len(symbols) + 1))
        inside.extend(range(len(symbols) + 1))
    order = suffix_array(text)
    common = common_prefixes(text, order)
    common.append(0)
    for rank, place in enumerate(order):
        breaks, at = strings.breaks[owner[place]], inside[place]
        shared = min(max(common[rank], common[rank + 1]), len(breaks) - 1 - at)
        if shared:
            yield owner[place], breaks[at], breaks[at + shared]


def repeated(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, version, starts, stops): parts of ``versions`` that repeat, in bytes, overlapping ones not
    yet merged."""
    found = stage(segments(texts, length), "segments")
    known = repeats.classify(found, earlier=False)
    compared = repeats.compare(known.classes, texts, _cut, length, 1, False, bytes, by_suffix_array)
    return repeats.spans(known.whole.unionByName(compared))


def remove(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept): the removed spans and the bytes that stay."""
    texts = versions(docs, id_col, text_col)
    return repeats.without_spans(texts, stage(repeated(texts, length), "spans"), bytes, b"", "n_bytes")


def report(removed: DataFrame) -> DataFrame:
    return removed.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("bigint").alias("n_removed"),
        (F.size("spans") / 2).cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
