"""Removal of long word sequences that an earlier document has, by suffix automata.

A window is ``length`` consecutive words of one document. Each word covered by a window whose
sequence also starts in a document with a smaller id is removed; windows are judged on the input.
Candidate texts come from module ``repeats``. They are dealt into shards by anchor; the texts of a
shard make a suffix automaton whose states know the least document id they occur in, and each text
of the shard is streamed through it: the matching statistics at a place are the longest stretch
ending there that a smaller document has, and those over the threshold give maximal spans. A shard
is only ever met by the texts that can match it, and only while its task runs.

Defined results: NULL text has no words; texts under ``length`` words lose nothing. The first
document of each window keeps it, also where it repeats it itself. Repeated rows keep theirs, since
none has a smaller id. Rows that share an id but not their text are documents of their own, neither
smaller than the other. Rows without an id keep their text and count for no other row. No rows give
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import repeats
from loadlens.llm.staging import stage
from loadlens.llm.suffix_dedup import _power, _texts, versions

LENGTH = 50
#: Words of a gram, or about a quarter of ``length`` if that is less.
GRAM = 8


class Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def segments(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    gram = _power(min(GRAM, length // 4), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Words()
        for batch in batches:
            ids, version = batch.column("doc_id").to_numpy(), batch.column("version").to_numpy()
            for first, stop, some in _texts(batch):
                # words end at the six ASCII blanks, where bytes.split() cuts
                words = [x.split() for x in some]
                lengths = np.array([len(x) for x in words], np.int64)
                own = hashes.of([x for own in words for x in own])
                # a gram that reaches past the end of a text is in no window
                found = repeats.runs(repeats.gram_hashes(own, gram), own, lengths, length, gram)
                yield repeats.segment_batch(ids[first:stop], version[first:stop], found)

    return texts.where("doc_id IS NOT NULL").mapInArrow(run, repeats.SEGMENT)


def _cut(text: bytes, starts: np.ndarray, stops: np.ndarray) -> list[bytes]:
    words = text.split()
    return [b" ".join(words[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]


def _units(part: bytes) -> bytes:
    return Words().of(part.split()).tobytes()


class Automaton:
    """Suffix automaton of several strings; ``least`` of a state is the least document it occurs in."""

    def __init__(self, strings: list[list[int]], docs: list[int]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.least = [-1], [0], [min(docs, default=0)]
        for symbols, doc in zip(strings, docs):
            last = 0
            for x in symbols:
                last = self._extend(last, x)
                self.least[last] = min(self.least[last], doc)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            self.least[up] = min(self.least[up], self.least[state])

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        self.least.append(np.iinfo(np.int64).max)
        return len(self.next) - 1

    def _extend(self, last: int, x: int) -> int:
        if x in self.next[last]:
            old = self.next[last][x]
            return old if self.length[old] == self.length[last] + 1 else self._clone(last, x, old)
        state = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and x not in self.next[at]:
            self.next[at][x] = state
            at = self.link[at]
        if at >= 0:
            old = self.next[at][x]
            self.link[state] = old if self.length[old] == self.length[at] + 1 else self._clone(at, x, old)
        return state

    def _clone(self, at: int, x: int, old: int) -> int:
        clone = self._state(self.length[at] + 1, self.link[old], dict(self.next[old]))
        self.link[old] = clone
        while at >= 0 and self.next[at].get(x) == old:
            self.next[at][x] = clone
            at = self.link[at]
        return clone

    def statistics(self, symbols: list[int], doc: int) -> Iterator[int]:
        """For each place of a string, the longest part ending there that a document under ``doc`` has."""
        state = size = 0
        for x in symbols:
            while state and x not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if x in self.next[state]:
                state = self.next[state][x]
                size += 1
            up, longest = state, size
            while up > 0 and self.least[up] >= doc:
                up = self.link[up]
                longest = self.length[up]
            yield longest if up > 0 else 0


def by_automaton(strings: repeats.Strings) -> Iterator[tuple[int, int, int]]:
    """(string, start, stop) of parts that a string of a smaller document has at the same place."""
    automaton = Automaton(strings.symbols, strings.docs)
    for k, (symbols, breaks, doc) in enumerate(zip(strings.symbols, strings.breaks, strings.docs)):
        for end, longest in enumerate(automaton.statistics(symbols, doc), 1):
            if longest:
                yield k, breaks[end - longest], breaks[end]


def repeated(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, version, starts, stops): parts of ``versions`` that an earlier document has, in words, not
    yet merged."""
    found = stage(segments(texts, length), "segments")
    known = repeats.classify(found, earlier=True)
    compared = repeats.compare(known.classes, texts, _cut, length, 8, True, _units, by_automaton)
    return repeats.spans(known.whole.unionByName(compared))


def remove(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, spans, kept): the removed spans, in words, and the kept words joined by a space."""
    texts = versions(docs, id_col, text_col)
    return repeats.without_spans(texts, stage(repeated(texts, length), "spans"), bytes.split, b" ", "n_words")


def report(removed: DataFrame) -> DataFrame:
    lengths = "cast(aggregate(sequence(0, size(spans) - 1, 2), 0L, (s, k) -> s + spans[k + 1] - spans[k]) AS bigint)"
    return removed.select(
        "doc_id",
        "n_words",
        F.expr(f"CASE WHEN size(spans) = 0 THEN 0L ELSE {lengths} END").alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
