"""Windows that occur more than once in a corpus, found without comparing texts with each other.

Every window (so many bytes or words of one document) has an anchor, the place of the least hash
among its grams. Equal windows have equal anchors at equal places, so two documents share a window
only if they share an anchor, with the same text around it. Consecutive windows with one anchor
form a segment, of less than two windows' length; a text has one for some third of a window.

1. ``segments``: (anchor, class, document, place) of each segment; the class is a hash of its text.
2. ``classify``: anchors that occur once are done. If all segments of an anchor have one class,
   all their windows are equal. Only anchors with several classes need their texts compared.
3. ``contexts`` fetches one text for each of those classes; ``match`` compares those of an anchor.
   Parts that no other class can share are trimmed first, after which most are equal and collapse.
   The others are cut where any two of them part and so become short strings of symbols, and an
   index over these (suffix array or suffix automaton, from the caller) tells what they share.
4. ``by_cells`` compares the classes of anchors that have more of them than a task should hold, by
   hashes of parts that are cut finer and finer, in Spark's aggregates only.

A class is compared once, however many documents hold it, so groups of copies cost what one copy
costs, and no pair of documents is ever formed.

Documents are known by id and version (``with_versions``), so ids may repeat, with one text or several.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.staging import stage

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MORE = np.uint64(0xC2B2AE3D27D4EB4F)
#: Bits of a place in a batch of texts; the rest of 64 order the grams.
_PLACE = np.uint64(28)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them."""
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _MORE
    return x ^ (x >> np.uint64(32))


def gram_hashes(units: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` units (a power of 2) from each place on, by doubling; those that reach past
    the end of the array are of no use. Grams that are long for the window are rarely shared by
    chance, so fewer anchors need their texts compared."""
    out, size = mix(units), 1
    while size < gram:
        out[:-size] = mix(out[:-size] + mix(out[size:] + np.uint64(size)))
        size *= 2
    return out


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(_ODD), -1, 2**64))
            for name, base in (("up", _ODD), ("down", inverse)):
                steps = np.full(n, base)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def _window_places(grams: np.ndarray, width: int, at_once: int = 1 << 27) -> np.ndarray:
    """Place of the least of each ``width`` consecutive grams, the first of equal ones. Which gram that
    is depends on the window alone, so longer arrays are taken in parts, to fit places into their bits."""
    n = len(grams)
    if n - width + 1 > at_once:
        parts = range(0, n - width + 1, at_once)
        return np.concatenate([_window_places(grams[k : k + at_once + width - 1], width, at_once) + k for k in parts])
    key = (grams >> _PLACE << _PLACE) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    padded[:n] = key
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    least = np.minimum(back[:m], ahead[width - 1 : width - 1 + m])
    return (least & np.uint64((1 << 28) - 1)).astype(np.int64)


def runs(grams: np.ndarray, values: np.ndarray, lengths: np.ndarray, window: int, gram: int):
    """(document, place, left, right, anchor, class) of the segments of a batch of texts. A segment
    reaches ``left`` units before its anchor and ``right`` from it on."""
    n = len(grams)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    at = _window_places(grams, window - gram + 1)
    m = n - window + 1
    start = np.flatnonzero(ends[owner[:m]] - np.arange(m) >= window)
    if not len(start):
        return none, none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    place = at[start]
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    a, b, c = start[first], start[last] + window, place[first]
    up, down = _powers.to(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up, out=sums[1:])
    left, right = c - a, b - c
    shape = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
    cls = mix(((sums[b] - sums[a]) * down[a]) ^ mix(shape))
    doc = owner[a]
    return doc, c - (ends - lengths)[doc], left, right, grams[c], cls


#: Bits of the map of ids that repeat: 4 MB, as a table of at most 2**19 numbers that every task gets.
ID_BITS = 1 << 25


def with_versions(texts: DataFrame) -> DataFrame:
    """(doc_id, version, text) of ``texts`` (doc_id, text): the version is 0, or a hash of the text where
    other rows may have the id. Only ids are shuffled; those that repeat set a bit of a map of fixed
    size, and an id that meets the bit of another one merely gets a hash without need."""
    place = F.xxhash64("doc_id").bitwiseAND(F.lit(ID_BITS - 1))
    bit = F.expr("shiftleft(1L, cast(_place & 63 AS int))")
    again = texts.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    words = again.select(place.alias("_place")).groupBy(F.shiftright("_place", 6).alias("_word"))
    words = stage(words.agg(F.bit_or(bit).alias("_bits")), "repeated-ids")
    if words.isEmpty():
        return texts.select("doc_id", F.lit(0).cast("bigint").alias("version"), "text")
    marked = texts.withColumn("_place", place).join(F.broadcast(words), F.shiftright("_place", 6) == F.col("_word"), "left")
    text_hash = F.xxhash64("text")
    version = F.when(F.col("_bits").bitwiseAND(bit) != 0, F.when(text_hash == 0, 1).otherwise(text_hash)).otherwise(0)
    return marked.select("doc_id", F.when(F.col("doc_id").isNull(), 0).otherwise(version).cast("bigint").alias("version"), "text")


SEGMENT = "doc_id bigint, version bigint, at bigint, before int, after int, anchor bigint, cls bigint"


def segment_batch(doc_ids: np.ndarray, versions: np.ndarray, found) -> pa.RecordBatch:
    """Texts of one id and several versions have classes apart, as ``classify`` tells places by id."""
    doc, at, left, right, anchor, cls = found
    ids, version = doc_ids[doc], versions[doc]
    cls = np.where(version == 0, cls, mix(cls ^ mix(version.view(np.uint64))))
    arrays = (ids, version, at, left.astype(np.int32), right.astype(np.int32), anchor.view(np.int64), cls.view(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], [x.split()[0] for x in SEGMENT.split(", ")])


@dataclass
class Classified:
    whole: DataFrame  # (doc_id, version, start, stop): segments that repeat as a whole
    classes: DataFrame  # (anchor, cls, n, doc_id, version, ats, before, after): of anchors with several classes


def classify(segments: DataFrame, earlier: bool) -> Classified:
    """What repeats by its class alone, and the classes to compare. ``earlier``: only what occurs in
    a document of smaller id counts as repeated, else what occurs anywhere else. ``segments`` is
    read twice and should be a stored table."""
    totals = segments.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("cls").alias("low"), F.max("cls").alias("high"), F.min("doc_id").alias("first")
    )
    # stored, so that both sides of the join are plain exchanges and an anchor that very many
    # segments share is cut into parts
    many = stage(totals.where("n > 1"), "anchors").hint("merge")
    rows = stage(segments.join(many, "anchor"), "repeated")
    single, several = rows.where("low = high"), rows.where("low < high").drop("n", "first", "low", "high")
    # a document's segments of one class are one row from here on: a class may have very many segments
    # in each of its documents
    of_doc = several.groupBy("anchor", "cls", "doc_id", "version").agg(
        F.count("*").alias("n"),
        F.collect_set("at").alias("ats"),
        F.min("before").alias("before"),
        F.min("after").alias("after"),
    )
    of_doc = stage(of_doc, "by-document")
    classes = of_doc.groupBy("anchor", "cls").agg(
        F.sum("n").alias("n"), F.min(F.struct("doc_id", "version", "ats", "before", "after")).alias("one")
    )
    classes = stage(classes.select("anchor", "cls", "n", "one.*"), "classes")
    span = [(F.col("at") - F.col("before")).alias("start"), (F.col("at") + F.col("after")).alias("stop")]
    known = classes.select("anchor", "cls", F.col("doc_id").alias("first"), "n")
    joined = of_doc.drop("n").join(known.where("n > 1").hint("merge"), ["anchor", "cls"])
    if earlier:
        single, joined = single.where("doc_id > first"), joined.where("doc_id > first")
    joined = joined.select("doc_id", "version", F.explode("ats").alias("at"), "before", "after")
    whole = single.select("doc_id", "version", *span).unionByName(joined.select("doc_id", "version", *span))
    return Classified(whole, classes)


def contexts(classes: DataFrame, texts: DataFrame, cut: Callable[[bytes, np.ndarray, np.ndarray], list[bytes]]) -> DataFrame:
    """``classes`` with the bytes of their texts: ``cut`` gives those of units [start, stop) of a text."""
    wanted = classes.groupBy("doc_id", "version").agg(
        F.collect_list(F.struct("anchor", "cls", "n", "ats", "before", "after")).alias("wanted")
    )
    # of repeated rows one is read
    once = texts.where("version = 0").unionByName(texts.where("version <> 0").dropDuplicates(["doc_id", "version"]))
    joined = once.join(wanted.hint("merge"), ["doc_id", "version"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                doc_id, version, text, wanted_ = (row.column(i) for i in range(4))
                fields = wanted_.flatten()
                start = pc.list_element(fields.field("ats"), 0).to_numpy(zero_copy_only=False)
                before, after = (fields.field(x).to_numpy(zero_copy_only=False) for x in ("before", "after"))
                parts = cut(text[0].as_py(), start - before, start + after)
                own = [pa.array(np.full(len(parts), x[0].as_py(), np.int64)) for x in (doc_id, version)]
                yield pa.RecordBatch.from_arrays(
                    [fields.field("anchor"), fields.field("cls"), fields.field("n"), *own, fields.field("ats"), fields.field("before"), fields.field("after"), pa.array(parts, pa.binary())],
                    names,
                )

    schema = "anchor bigint, cls bigint, n bigint, doc_id bigint, version bigint, ats array<bigint>, before int, after int, part binary"
    names = [x.split()[0] for x in schema.split(", ")]
    return joined.select("doc_id", "version", "text", "wanted").mapInArrow(run, schema)


def _order(group: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by group and content, and the common prefix of each with the one before it
    in that order (0 at the start of a group)."""
    width = rows.shape[1]
    order = np.lexsort((rows.view(f"S{width}").ravel(), group))
    g, r = group[order], rows[order]
    common = np.zeros(len(rows), np.int64)
    differ = r[1:] != r[:-1]
    common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common[1:][g[1:] != g[:-1]] = 0
    return order, common


def _most(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The longest common prefix of each row with any other of its group."""
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(common, np.append(common[1:], 0))
    return out


@dataclass
class Strings:
    """Strings of symbols for the index: those of one anchor share symbols where they are equal."""

    symbols: list[list[int]]
    breaks: list[list[int]]  # offsets from the anchor, one more than symbols
    docs: list[int]
    counts: list[int]


#: Classes whose texts are compared at once; an anchor's classes are never split.
AT_ONCE = 20_000
#: Classes of one anchor that a task takes; anchors with more go to ``by_cells``.
AT_MOST = 5_000
#: Strings that go into an index at once, and what is left of the last one's anchor.
INDEXED = 1_000
#: Parts that a cell is cut into.
FAN = 8


def match(group: np.ndarray, left: list[bytes], right: list[bytes], docs: np.ndarray, counts: np.ndarray,
          window: int, unit: int, earlier: bool,
          index: Callable[[Strings], Iterator[tuple[int, int, int]]]) -> list[list[tuple[int, int]]]:
    """For each class of some anchors (``group``), the parts [start, stop) around its anchor that
    repeat, in bytes. ``left`` is read from the anchor outwards, in units. Classes whose every window
    repeats by their count alone may be left empty. ``window`` is in bytes."""
    m = len(group)
    ranges: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    sizes = [np.array([len(x) for x in side], np.int64) for side in (left, right)]
    rows = [np.frombuffer(b"".join(x.ljust(window, b"\0") for x in side), np.uint8).reshape(m, window) for side in (left, right)]
    live = np.arange(m)
    reach = [s.copy() for s in sizes]
    for _ in range(4):  # trim to what any other class of the anchor can share, until nothing changes
        if not len(live):
            return ranges
        before = [r[live].copy() for r in reach]
        for side in (0, 1):
            part = rows[side][live].copy()
            part[np.arange(window) >= reach[side][live, None]] = 0
            order, common = _order(group[live], part)
            longest = _most(order, common) // unit * unit
            reach[side][live] = np.minimum(reach[side][live], longest)
        keep = reach[0][live] + reach[1][live] >= window
        if keep.all() and all((reach[s][live] == before[s]).all() for s in (0, 1)):
            break
        live = live[keep]
    if not len(live):
        return ranges
    # equal trimmed texts collapse
    whole = np.zeros((len(live), 2 * window + 8), np.uint8)
    for side in (0, 1):
        part = rows[side][live].copy()
        part[np.arange(window) >= reach[side][live, None]] = 0
        whole[:, 8 + side * window : 8 + (side + 1) * window] = part
        whole[:, 4 * side : 4 * side + 4] = reach[side][live].astype(">u4").view(np.uint8).reshape(-1, 4)
    order, common = _order(group[live], whole)
    new = common < whole.shape[1]
    kind = np.empty(len(live), np.int64)
    kind[order] = np.cumsum(new) - 1
    kinds = int(new.sum())
    total = np.bincount(kind, counts[live], kinds).astype(np.int64)
    least = np.full(kinds, np.iinfo(np.int64).max)
    np.minimum.at(least, kind, docs[live])
    some = np.empty(kinds, np.int64)
    some[kind] = live  # one class for each kind
    done = docs[live] > least[kind] if earlier else total[kind] > 1
    for k in np.flatnonzero(done):
        i = live[k]
        ranges[i].append((-int(reach[0][i]), int(reach[1][i])))
    # anchors with several kinds left, at least one of them open
    open_kind = np.zeros(kinds, bool)
    open_kind[kind[~done]] = True
    g = group[some]
    _, gi = np.unique(g, return_inverse=True)
    wanted = (np.bincount(gi) > 1) & (np.bincount(gi, open_kind) > 0)
    chosen = np.flatnonzero(wanted[gi])
    if not len(chosen):
        return ranges
    found: dict[int, list[tuple[int, int]]] = {}
    for first, last in _whole(g[chosen], INDEXED):
        own = chosen[first:last]
        strings = _strings(g[own], [rows[s][some[own]] for s in (0, 1)], [reach[s][some[own]] for s in (0, 1)],
                           least[own], total[own], unit)
        parts: dict[int, list[tuple[int, int]]] = {}
        for k, a, b in index(strings):
            if b - a >= window:
                parts.setdefault(int(own[k]), []).append((a, b))
        found |= {k: merge(*np.array(x).T) for k, x in parts.items()}
    for k in np.flatnonzero(~done):
        ranges[live[k]].extend(found.get(int(kind[k]), ()))
    return ranges


def _whole(group: np.ndarray, at_once: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole groups of a sorted array, each ended by the group that takes it to ``at_once`` rows."""
    first = 0
    for last in (np.flatnonzero(group[1:] != group[:-1]) + 1).tolist():
        if last - first >= at_once:
            yield first, last
            first = last
    yield first, len(group)


def _strings(group: np.ndarray, rows: list[np.ndarray], reach: list[np.ndarray], docs: np.ndarray, counts: np.ndarray, unit: int) -> Strings:
    """Cut the texts of each anchor at every place where two of them part or one ends."""
    m = len(group)
    window = rows[0].shape[1]
    marks = []
    for side, sign in ((0, -1), (1, 1)):
        part = rows[side].copy()
        part[np.arange(window) >= reach[side][:, None]] = 0
        _, common = _order(group, part)
        order = np.lexsort((part.view(f"S{window}").ravel(), group))
        inner = np.flatnonzero(common > 0)
        marks.append((group[order[inner]], sign * (common[inner] // unit * unit)))
        marks.append((group, sign * reach[side]))
    marks.append((group, np.zeros(m, np.int64)))
    pairs = np.unique(np.stack([np.concatenate([x[0] for x in marks]), np.concatenate([x[1] for x in marks])]), axis=1)
    # texts from left to right, with sums of their hashes to get that of any part
    texts = np.concatenate([rows[0].reshape(m, window // unit, unit)[:, ::-1].reshape(m, window), rows[1]], axis=1)
    table = mix(np.arange(1, 257, dtype=np.uint64))
    up, _ = _powers.to(2 * window)
    sums = np.zeros((m, 2 * window + 1), np.uint64)
    np.cumsum(table[texts] * up, axis=1, out=sums[:, 1:])
    names: dict[tuple[int, int, int], int] = {}
    out = Strings([], [], docs.tolist(), counts.tolist())
    first = np.searchsorted(pairs[0], group)
    last = np.searchsorted(pairs[0], group, "right")
    for k in range(m):
        own = pairs[1][first[k] : last[k]]
        own = own[(own >= -reach[0][k]) & (own <= reach[1][k])]
        parts = np.diff(sums[k][own + window]).tolist()
        g = int(group[k])
        places = own.tolist()
        out.symbols.append([names.setdefault((g, a, h), len(names) + 1) for a, h in zip(places, parts)])
        out.breaks.append(places)
    return out


def resolve(parts: DataFrame, window: int, unit: int, earlier: bool, encode: Callable[[bytes], bytes],
            index: Callable[[Strings], Iterator[tuple[int, int, int]]]) -> DataFrame:
    """(doc_id, version, start, stop) in units, for the documents that stand for their class. ``window`` is in
    units of ``unit`` bytes, ``encode`` makes such units of a text. Classes are dealt by anchor."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Tables of whole anchors."""
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= AT_ONCE:
                table = pa.Table.from_batches(held)
                anchors = table.column("anchor").to_numpy()
                stop = int(np.searchsorted(anchors, anchors[-1]))  # the last anchor may go on
                if stop:
                    yield table.slice(0, stop)
                held = table.slice(stop).to_batches()
                rows -= stop
        if rows:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            left, right = [], []
            for part, before in zip(table.column("part").to_pylist(), table.column("before").to_pylist()):
                raw = encode(part)
                head = np.frombuffer(raw[: before * unit], np.uint8).reshape(-1, unit)
                left.append(head[::-1].tobytes())
                right.append(raw[before * unit :])
            docs, n = table.column("doc_id").to_numpy(), table.column("n").to_numpy()
            found = match(table.column("anchor").to_numpy(), left, right, docs, n, window * unit, unit, earlier, index)
            rows = [
                (doc, version, at + a // unit, at + b // unit)
                for doc, version, count, ats, own in zip(docs.tolist(), table.column("version").to_pylist(), n.tolist(), table.column("ats").to_pylist(), found)
                if earlier or count == 1
                for a, b in own
                for at in ats
            ]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows) if rows else ([], [], [], []))], ["doc_id", "version", "start", "stop"])

    dealt = parts.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "doc_id bigint, version bigint, start bigint, stop bigint")


def _cut_cells(wanted: DataFrame, window: int, unit: int, encode: Callable[[bytes], bytes], parent: int, width: int) -> DataFrame:
    """The cells of ``width`` in those of ``parent`` offsets that begin at ``lows``, for each class that
    has windows there. ``key`` is a hash of what all windows of a cell have in common, ``whole`` one
    of all that the class's windows there cover, from ``start`` to ``stop`` around the anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for large in batches:
            for at in range(0, large.num_rows, 1_000):
                batch = large.slice(at, 1_000)
                anchor, before, after = (batch.column(names.index(x)).to_numpy() for x in ("anchor", "before", "after"))
                raw = [encode(x) for x in batch.column(names.index("part")).to_pylist()]
                units = mix(np.frombuffer(b"".join(raw), f"<u{unit}").astype(np.uint64) + np.uint64(1))
                up, down = _powers.to(len(units) + 1)
                sums = np.zeros(len(units) + 1, np.uint64)
                np.cumsum(units * up[:-1], out=sums[1:])
                sizes = np.array([len(x) // unit for x in raw], np.int64)
                origin = np.cumsum(sizes) - sizes + before
                lows = batch.column(names.index("lows"))
                row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lows).to_numpy())
                low = lows.flatten().to_numpy().astype(np.int64)
                each = -(-parent // width)
                row, first = np.repeat(row, each), np.repeat(low, each)
                low = first + np.tile(np.arange(each) * width, len(low))
                high = np.minimum(np.minimum(low + width, first + parent), window) - 1
                a, b = np.maximum(low, window - after[row]), np.minimum(high, before[row])
                own = np.flatnonzero(a <= b)
                row, low, high, a, b = (x[own] for x in (row, low, high, a, b))
                place = origin[row]
                part = lambda x, y: (sums[y] - sums[x]) * down[x]
                key = mix(part(place - low, place + window - high) ^ mix(mix(anchor[row].view(np.uint64)) + low.astype(np.uint64)))
                shape = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
                whole = mix(part(place - b, place + window - a) ^ mix(key + shape))
                kept = batch.select(["anchor", "cls", "n", "doc_id", "version", "ats"]).take(pa.array(row))
                new = [pa.array(x.astype(np.int32)) for x in (low, -b, window - a)] + [pa.array(x.view(np.int64)) for x in (key, whole)]
                yield pa.RecordBatch.from_arrays(kept.columns + new, out)

    schema = "anchor bigint, cls bigint, n bigint, doc_id bigint, version bigint, ats array<bigint>, low int, start int, stop int, key bigint, whole bigint"
    out = [x.split()[0] for x in schema.split(", ")]
    names = wanted.columns
    return wanted.mapInArrow(run, schema)


def by_cells(parts: DataFrame, window: int, unit: int, earlier: bool, encode: Callable[[bytes], bytes]) -> DataFrame:
    """What ``resolve`` tells, however many classes an anchor has; ``parts`` should be a stored table.

    The windows of an anchor are told apart by the units they hold before it. A cell is a range of
    these offsets: windows can be equal only if their cells agree in what all their windows have in
    common (``key``), and all of them are equal if the cells agree as a whole. Of classes that agree
    as a whole one goes on, with the others of its key, to cells cut finer, down to single windows.
    So each class goes on in the few cells only in which it parts from the others."""
    found, parent = [], window
    wanted = parts.withColumn("lows", F.array(F.lit(0)))
    while True:
        width = -(-parent // FAN)
        cells = stage(_cut_cells(wanted, window, unit, encode, parent, width), "cells")
        kinds = cells.groupBy("key", "whole").agg(
            F.sum("n").alias("total"), F.min(F.struct("doc_id", "anchor", "cls")).alias("one")
        )
        kinds = stage(kinds.select("key", "whole", "total", F.col("one.doc_id").alias("first"), F.col("one.cls").alias("sign")), "kinds")
        equal = cells.join(kinds.where("total > 1").hint("merge"), ["key", "whole"])
        equal = equal.where("doc_id > first" if earlier else "n = 1")
        found.append(equal.select("doc_id", "version", F.explode("ats").alias("at"), "start", "stop"))
        if width == 1:
            break
        # keys with several kinds, of which at least one is not settled
        several = kinds.groupBy("key").agg(
            F.count("*").alias("kinds"), F.min("total").alias("least"), F.min("first").alias("low"), F.max("first").alias("high")
        )
        several = several.where("kinds > 1").where("low < high" if earlier else "least = 1").select("key")
        going = stage(kinds.join(stage(several, "several").hint("merge"), "key"), "going")
        # of the classes of one document each has places of its own
        chosen = "doc_id = first" if earlier else "doc_id = first AND cls = sign"
        lows = cells.join(going.hint("merge"), ["key", "whole"]).where(chosen)
        lows = stage(lows.groupBy("anchor", "cls").agg(F.collect_list("low").alias("lows")), "lows")
        if lows.isEmpty():
            break
        wanted, parent = parts.join(lows.hint("merge"), ["anchor", "cls"]), width
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.select("doc_id", "version", (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("stop")).alias("stop"))


def compare(classes: DataFrame, texts: DataFrame, cut: Callable[[bytes, np.ndarray, np.ndarray], list[bytes]], window: int, unit: int, earlier: bool,
            encode: Callable[[bytes], bytes], index: Callable[[Strings], Iterator[tuple[int, int, int]]]) -> DataFrame:
    """(doc_id, version, start, stop) in units, for the documents that stand for their class: ``resolve`` for
    the anchors that a task can hold, ``by_cells`` for the others."""
    sizes = classes.groupBy("anchor").agg(F.count("*").alias("classes"))
    large = stage(sizes.where(F.col("classes") > AT_MOST).select("anchor"), "large")
    if large.isEmpty():
        return resolve(contexts(classes, texts, cut), window, unit, earlier, encode, index)
    few = contexts(classes.join(large, "anchor", "left_anti"), texts, cut)
    many = stage(contexts(classes.join(large, "anchor", "left_semi"), texts, cut), "many")
    return resolve(few, window, unit, earlier, encode, index).unionByName(by_cells(many, window, unit, earlier, encode))


def spans(found: DataFrame) -> DataFrame:
    """(doc_id, version, starts, stops) from (doc_id, version, start, stop), each once, not yet merged."""
    both = F.collect_set(F.struct("start", "stop"))
    return found.groupBy("doc_id", "version").agg(both.alias("both")).select("doc_id", "version", F.col("both.start").alias("start"), F.col("both.stop").alias("stop"))


def merge(starts: np.ndarray, stops: np.ndarray) -> list[tuple[int, int]]:
    """Maximal spans, in order; spans that touch are one."""
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], np.maximum.accumulate(stops[order])
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > b[:-1]
    first = np.flatnonzero(new)
    return list(zip(a[first].tolist(), b[np.append(first[1:], len(a)) - 1].tolist())) if len(a) else []


def without_spans(texts: DataFrame, spans: DataFrame, units: Callable[[bytes], Sequence], joint: bytes, count: str) -> DataFrame:
    """(doc_id, ``count``, spans, kept): how many ``units`` a text has, the removed spans as a flat list,
    and what stays, put together with ``joint``."""
    joined = texts.join(spans.hint("merge"), ["doc_id", "version"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts_, starts, stops = batch.columns
            some, held = [], 0
            for k in range(batch.num_rows):
                own, kept, at, flat = units(texts_[k].as_py()), [], 0, []
                if starts[k].is_valid:
                    for a, b in merge(*(np.array(x[k].as_py()) for x in (starts, stops))):
                        kept.append(own[at:a])
                        flat += (a, b)
                        at = b
                kept.append(own[at:])
                whole = b"".join(kept) if isinstance(own, bytes) else joint.join(x for part in kept for x in part)
                some.append((ids[k].as_py(), len(own), flat, whole))
                held += len(whole)
                if held > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*some), types)], names)
                    some, held = [], 0
            if some:
                yield pa.RecordBatch.from_arrays([pa.array(x, y) for x, y in zip(zip(*some), types)], names)

    names = ["doc_id", count, "spans", "kept"]
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
    schema = f"doc_id bigint, {count} bigint, spans array<bigint>, kept binary"
    return joined.select("doc_id", "text", "start", "stop").mapInArrow(run, schema)
