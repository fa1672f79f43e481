"""Token counts of every prefix of a text, stored once and asked many times.

Prefix dynamic programming: the tokens of a prefix are the last token of that prefix before the
tokens of what is left of it, and a token is the last one exactly if it forms a stable pair with the
last token of the rest. So one pass over the positions of a piece gives the count at each of them
(all tokens that end at a position come from one automaton over the vocabulary). The counts of a
text are those of its pieces on top of the tokens before them. Two kinds of prefixes are cut into
other pieces than the whole text is, and are set right: those that end in a run of white space,
which then belongs together, and those that end inside a contraction. Strings of added tokens are
single ids where they are whole; a prefix that ends inside one sees ordinary text.

Stored are the differences from one position to the next, mostly 0 and 1, as bytes.

Defined results: NULL and empty texts have no positions and 0 tokens. Each repeated row has a result
of its own, and an id may be NULL. No rows give no rows. Other columns are not read. Counts may fall
from one prefix to the next, when a longer token closes; ``fit`` takes the longest prefix that fits.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import pretoken
from loadlens.llm.tokens import byte_letters, some, text_of

#: Pieces and pairs that a worker remembers; beyond it each cache starts anew.
CACHED = 700_000

STORED = "doc_id bigint, n_bytes bigint, n_chars bigint, n_tokens bigint, width int, steps binary"
_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
_NAMES = [x.split()[0] for x in STORED.split(", ")]


class _Pairs(dict):
    """Whether two tokens stay as they are when their texts are encoded together."""

    def __init__(self, model, letters: dict[int, str]):
        self.model, self.letters = model, letters

    def __missing__(self, key: tuple[int, int]) -> bool:
        if len(self) > CACHED:
            self.clear()
        text = "".join(map(self.letters.__getitem__, key))
        stable = self[key] = tuple(x.id for x in self.model.tokenize(text)) == key
        return stable


class _Pieces(dict):
    """Counts after each character of a piece, as little-endian 32-bit integers."""

    def __init__(self, vocabulary: str):
        import ahocorasick
        from tokenizers import Tokenizer

        kind = json.loads(vocabulary)
        self.model = Tokenizer.from_str(vocabulary).model
        of_letter = {ord(x): byte for byte, x in byte_letters().items()}
        words = kind["model"]["vocab"]
        self.pairs = _Pairs(self.model, {k: word for word, k in words.items()})
        self.automaton = ahocorasick.Automaton()
        for word, k in words.items():
            raw = word.translate(of_letter)  # one Latin-1 letter a byte
            self.automaton.add_word(raw, (k, len(raw), word))
        self.automaton.make_automaton()
        self.whole: dict[int, bool] = {}

    def _alone(self, k: int, word: str) -> bool:
        """Whether a token is what its own text is encoded to."""
        if k not in self.whole:
            self.whole[k] = [x.id for x in self.model.tokenize(word)] == [k]
        return self.whole[k]

    def counts(self, piece: bytes) -> list[int]:
        """Count after each byte of a piece, 0 for none first."""
        count, last = [0] + [-1] * len(piece), [0] * (len(piece) + 1)
        pairs = self.pairs
        for end, (k, length, word) in self.automaton.iter(piece.decode("latin-1")):
            end += 1
            if count[end] < 0:
                start = end - length
                if self._alone(k, word) if not start else pairs[last[start], k]:
                    count[end], last[end] = count[start] + 1, k
        return count

    def __missing__(self, piece: bytes) -> bytes:
        count = self.counts(piece)
        if len(piece) == 3 and piece in (b"'re", b"'ve", b"'ll"):
            count[2] = 2  # a contraction not yet whole: the apostrophe and a letter
        if piece.isascii():
            ends = count[1:]
        else:  # the last byte of a character is that before the first byte of another
            ends = [n for n, after in zip(count[1:], [*piece[1:], 0]) if after & 0xC0 != 0x80]
        made = self[piece] = np.array(ends, "<i4").tobytes()
        return made


class Counter:
    """Counts of all prefixes of texts by one byte-level tokenizer file."""

    def __init__(self, vocabulary: str):
        kind = json.loads(vocabulary)
        before = kind.get("pre_tokenizer") or {}
        if (
            kind["model"].get("type") != "BPE"
            or before.get("type") != "ByteLevel"
            or not before.get("use_regex", True)
            or before.get("add_prefix_space")
            or kind.get("normalizer")
            or kind["model"].get("ignore_merges")
        ):
            raise ValueError("prefix counts need a byte-level BPE file without a normalizer")
        added = kind.get("added_tokens") or []
        names = [x["content"] for x in added]
        if any(x.get("lstrip") or x.get("rstrip") or x.get("single_word") for x in added) or any(
            a != b and a in b for a in names for b in names
        ):
            raise ValueError("added tokens that strip, want whole words or hold each other are not supported")
        self.added = re.compile("|".join(map(re.escape, names))) if names else None
        self.pieces = _Pieces(vocabulary)

    def counts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """For each text, the tokens of its first 1, 2, ... characters."""
        parts, cuts = [], []  # of each text: (characters of a part, of the added token after it)
        for text in texts:
            own, at = [], 0
            for found in self.added.finditer(text) if self.added else ():
                parts.append(text[at : found.end() - 1])  # a prefix may end before the token is whole
                own.append((found.start() - at, len(found.group())))
                at = found.end()
            parts.append(text[at:])
            cuts.append(own)
        made = self._plain(parts)
        for own in cuts:
            if not own:
                yield next(made)
                continue
            before, whole = 0, []
            for chars, length in own:
                part = next(made) + before
                before = (part[chars - 1] if chars else before) + 1
                whole += [part, [before]]
            whole.append(next(made) + before)
            yield np.concatenate(whole)

    def _plain(self, texts: list[str]) -> Iterator[np.ndarray]:
        """``counts`` of texts without added tokens."""
        for first, stop, pieces, _ in pretoken.slices(texts):
            if len(self.pieces) > CACHED:
                self.pieces.clear()
            made = list(map(self.pieces.__getitem__, pieces))
            flat = np.frombuffer(b"".join(made), "<i4").astype(np.int64)
            size = np.array([len(x) >> 2 for x in made])
            total = flat[np.cumsum(size) - 1]
            base = np.cumsum(total) - total
            flat += np.repeat(base, size)

            joined = "\n".join(texts[first:stop]) + "\n"
            ends = np.cumsum([len(x) + 1 for x in texts[first:stop]]) - 1
            self._blanks(joined, ends, flat)
            starts = np.append(0, ends[:-1] + 1)
            for a, b in zip(starts.tolist(), ends.tolist()):
                yield flat[a:b] - (flat[a - 1] if a else 0)

    def _blanks(self, joined: str, ends: np.ndarray, flat: np.ndarray) -> None:
        """Set the counts of prefixes that end with a run of white space which the text goes on after:
        there the run is one piece, while in the text its last character stands apart."""
        kinds = pretoken.class_table()[np.frombuffer(joined.encode("utf-32-le"), "<u4")]
        blank = (kinds == pretoken.SPACE) | (kinds == pretoken.BLANK)
        blank[ends] = False
        firsts = np.flatnonzero(blank & ~np.append(False, blank[:-1]))
        lasts = np.flatnonzero(blank & ~np.append(blank[1:], False))
        goes_on = np.ones(len(joined) + 1, bool)
        goes_on[ends] = False
        runs = (lasts > firsts) & goes_on[lasts + 1]
        for a, b in zip(firsts[runs].tolist(), lasts[runs].tolist()):
            own = self.pieces[joined[a : b + 1].encode()]
            flat[b] = (flat[a - 1] if a else 0) + int.from_bytes(own[-4:], "little")


@lru_cache(maxsize=2)
def counter(vocabulary: str) -> Counter:
    """One per worker process, with the pieces that earlier tasks have met."""
    return Counter(vocabulary)


def prefix_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_chars, n_tokens, width, steps) of each row: ``steps`` holds the change of
    the count with each character, as signed integers of ``width`` bytes. Store it to ask it often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary)
        for ids, texts in some(batches):
            rows = []
            for doc_id, text, counts in zip(ids, texts, own.counts(texts)):
                steps = np.diff(counts, prepend=0)
                width = 1 if not len(steps) or -128 <= steps.min() and steps.max() < 128 else 4
                n_tokens = int(counts[-1]) if len(counts) else 0
                rows.append((doc_id, len(text.encode()), len(text), n_tokens, width, steps.astype(f"<i{width}").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)

    return docs.select(F.col(id_col).cast("bigint"), text_of(text_col)).mapInArrow(run, STORED)


def _counts(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Counts after 0, 1, 2, ... characters of each row of a stored batch."""
    for width, steps in zip(batch["width"].to_pylist(), batch["steps"]):
        yield np.append(0, np.cumsum(np.frombuffer(steps.as_buffer() or b"", f"<i{width}"), dtype=np.int64))


def fit(stored: DataFrame, budget: int) -> DataFrame:
    """For each row of ``prefix_counts``, whether its text needs more tokens than ``budget``, and the
    longest prefix that does not: ``fit_chars`` characters of ``fit_tokens`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars, tokens = [], []
            for counts in _counts(batch):
                at = len(counts) - 1 - int(np.argmax(counts[::-1] <= budget))
                chars.append(at)
                tokens.append(int(counts[at]))
            over = pc.greater(batch["n_tokens"], budget)
            yield pa.RecordBatch.from_arrays(
                [*(batch[x] for x in _NAMES[:4]), over, pa.array(chars, pa.int64()), pa.array(tokens, pa.int64())],
                [*_NAMES[:4], "over_limit", "fit_chars", "fit_tokens"],
            )

    names = ", ".join(STORED.split(", ")[:4])
    return stored.select(*_NAMES).mapInArrow(run, f"{names}, over_limit boolean, fit_chars bigint, fit_tokens bigint")


def spans(stored: DataFrame, cuts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Tokens of the prefixes that ``cuts`` (doc_id, chars) asks for: (doc_id, chars, prefix_tokens).
    Positions beyond the text take the whole text, negative or NULL ones none. Ids that repeat in
    ``stored`` give a row each; cuts without a text are dropped."""
    asked = cuts.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col("chars").cast("bigint").alias("chars"))
    rows = asked.join(stored.select("doc_id", "width", "steps"), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch["chars"].to_pylist()
            own = [int(x[min(max(k or 0, 0), len(x) - 1)]) for k, x in zip(asked, _counts(batch))]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["chars"], pa.array(own, pa.int64())], ["doc_id", "chars", "prefix_tokens"])

    return rows.select("doc_id", "chars", "width", "steps").mapInArrow(run, "doc_id bigint, chars bigint, prefix_tokens bigint")
