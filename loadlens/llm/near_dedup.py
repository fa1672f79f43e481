"""Near duplicates: documents whose sets of word shingles are alike.

1. One pass over the texts gives the size and the digest of each shingle set and its fast similarity
   sketch (module ``sketch``), cut into bands. Equal sets are one class from here on.
2. Classes that share a band are candidates. Each is compared on the full sets with one class of the
   band only, the one whose bands are the most common, so a band of m classes costs m comparisons.
3. What is linked by now is one component. Links between different components are then found by
   prefix filtering: in one fixed order of all shingles, rare ones first, two sets that are alike
   share one of their first shingles, at places early enough. Pairs within a component are left out,
   and those left are compared on the full sets.

So no cap is set on the size of a band, and links are only lost if all bands of two alike sets
differ: (1 - s**4)**32, 5e-8 at the threshold of 0.8 and less above it.

Defined results: words end at ASCII white space, A-Z are lower-cased. A text with fewer words than a
shingle is one shingle; one without words, or NULL, has none and is linked with nothing. Repeated
rows share their class; rows that share an id must share their text. A row without an id joins the
class of its set, if a row with an id has it, and is linked with nothing else. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm import sketch
from loadlens.llm.components import components
from loadlens.llm.repeats import mix
from loadlens.llm.staging import stage
from loadlens.llm.substring_dedup import Words
from loadlens.llm.suffix_dedup import _rows, _texts

SHINGLE = 5
PERCENT = 80
BANDS = 32
ROWS = 4
#: Counters for the frequency of shingles, which only set the order of prefixes: 2 MB, whatever the input.
COUNTERS = 1 << 18


def _sets(batch: pa.RecordBatch, hashes: Words, words: int):
    """(first, stop, shingles, bounds) of some texts of a batch at a time."""
    for first, stop, texts in _texts(batch):
        own = [x.lower().split() for x in texts]  # bytes: only A-Z change, only ASCII blanks cut
        lengths = np.array([len(x) for x in own], np.int64)
        elements, owners = sketch.shingle_sets(hashes.of([x for some in own for x in some]), lengths, words)
        yield first, stop, elements, owners


def sketched(docs: DataFrame, words: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands): size and digest of the set, and its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Words()
        for batch in batches:
            for first, stop, elements, owners in _sets(batch, hashes, words):
                n = stop - first
                digests = []
                for seed in (1, 2):
                    total = np.zeros(n, np.uint64)
                    np.add.at(total, owners, mix(elements ^ mix(np.array([seed], np.uint64))))
                    digests.append(pa.array(total.view(np.int64)))
                sizes = np.bincount(owners, minlength=n)
                own = sketch.bands(sketch.sketches(elements, owners, n, BANDS * ROWS), ROWS).view(np.int64)
                offsets = pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(own.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, n), pa.array(sizes.astype(np.int64)), *digests, lists],
                    ["doc_id", "n_shingles", "d1", "d2", "bands"],
                )

    schema = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>"
    return _rows(docs, id_col, text_col).mapInArrow(run, schema)


def full_sets(docs: DataFrame, wanted: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the documents in ``wanted`` (node)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Words()
        for batch in batches:
            for first, stop, elements, owners in _sets(batch, hashes, words):
                n = stop - first
                bounds = np.searchsorted(owners, np.arange(n + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(elements.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), lists], ["node", "shingles"])

    texts = _rows(docs, id_col, text_col)
    # both sides grow with the corpus: a merge join at every size; its partitioning serves the
    # choice of one among repeated rows as well
    some = texts.join(wanted.select(F.col("node").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
    return some.dropDuplicates(["doc_id"]).mapInArrow(run, "node bigint, shingles array<bigint>")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike. Each pair fetches its two sets by merge joins, which
    cut a node with many pairs into parts."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.select("a", "b").hint("merge").join(left, "a").join(right.hint("merge"), "b")
    both = both.withColumn("same", F.size(F.array_intersect("x", "y")))
    return both.where(100 * F.col("same") >= percent * (F.size("x") + F.size("y") - F.col("same"))).select("a", "b")


def first_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """(shingle, node, component, place, n): the first shingles of each set in an order common to all
    sets, by how many sets have a shingle of the same counter and then by hash."""
    counter = F.shiftrightunsigned("shingle", 64 - (COUNTERS.bit_length() - 1)).cast("int")
    counts = sets.select(F.explode("shingles").alias("shingle")).groupBy(counter.alias("c")).agg(F.count("*").alias("n"))
    table = np.zeros(COUNTERS, np.int64)
    for row in counts.toLocalIterator():  # at most COUNTERS rows
        table[row["c"]] = row["n"]
    ranks = np.unique(table, return_inverse=True)[1].astype(np.uint32)
    shared = sets.sparkSession.sparkContext.broadcast(ranks)
    shift = np.uint64(64 - (COUNTERS.bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                node, component = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                own = np.array(batch.column(2)[k].values).view(np.uint64)
                n = len(own)
                m = n - -(-percent * n // 100) + 1
                first = own[np.lexsort((own, rank[(own >> shift).astype(np.int64)]))[:m]]
                arrays = (first.view(np.int64), np.full(m, node), np.full(m, component), np.arange(m), np.full(m, n))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], names)

    names = ["shingle", "node", "component", "place", "n"]
    return sets.select("node", "component", "shingles").mapInArrow(run, ", ".join(f"{x} bigint" for x in names))


def across(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may be alike. A pair that first meets in a shingle at
    these places can share no more than what follows it in the shorter rest."""
    rows = stage(first_shingles(sets, percent), "first-shingles")
    a, b = rows.alias("a"), rows.alias("b")
    rest = F.least(F.expr("a.n - a.place"), F.expr("b.n - b.place"))
    on = (
        F.expr("a.shingle = b.shingle AND a.node < b.node AND a.component <> b.component")
        & F.expr(f"100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)")
        & ((100 + percent) * rest >= percent * F.expr("a.n + b.n"))
    )
    return a.join(b, on).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


def near_dedup(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents linked directly or through others share
    the least id among them, and the document of that id is kept."""
    rows = stage(sketched(docs, words, id_col, text_col), "sketched")
    classes = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2", "n_shingles").agg(F.min(F.struct("doc_id", "bands")).alias("one"))
    classes = stage(classes.select("d1", "d2", "n_shingles", F.col("one.doc_id").alias("node"), "one.bands"), "classes")
    banded = classes.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    many = banded.groupBy("band").agg(F.count("*").alias("m")).where("m > 1")
    shared = stage(banded.join(many, "band"), "shared")
    # a band's members are compared with the one whose bands are the most common: the text that the
    # others were made from, where there is one, rather than just another variant
    weighted = shared.join(shared.groupBy("node").agg(F.sum("m").alias("weight")), "node")
    best = F.max(F.struct("weight", (-F.col("node")).alias("minus"), "n"))
    leaders = weighted.groupBy("band").agg(best.alias("best"))
    leaders = leaders.select("band", F.struct((-F.col("best.minus")).alias("node"), F.col("best.n").alias("n")).alias("one"))
    met = stage(weighted.join(leaders, "band").select("node", "n", "one").distinct(), "met")
    wanted = met.select("node").distinct()
    sets = stage(full_sets(docs, wanted, words, id_col, text_col), "sets")
    pairs = met.where(
        f"one.node <> node AND 100 * least(n, one.n) >= {percent} * greatest(n, one.n)"
    ).select(F.col("one.node").alias("a"), F.col("node").alias("b"))
    links = stage(verify(pairs, sets, percent), "links")
    known = stage(components(links), "components")
    placed = sets.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    more = stage(verify(across(placed, percent), sets, percent), "links")
    linked = known if more.isEmpty() else components(links.union(more))
    final = classes.join(linked, "node", "left").select(
        "d1", "d2", "n_shingles", F.coalesce("component", "node").alias("component_id")
    )
    out = rows.select("doc_id", "n_shingles", "d1", "d2").join(final, ["d1", "d2", "n_shingles"], "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns. Rows without an id cannot be told apart and
    all stay, since one of them may be linked with nothing."""
    kept = near_dedup(docs, words, percent, id_col, text_col).where("kept").select(F.col("doc_id").alias("__id"))
    named = docs.where(F.col(id_col).isNotNull())
    named = named.join(kept, named[id_col].cast("bigint") == kept["__id"], "left_semi")
    return named.unionByName(docs.where(F.col(id_col).isNull()))
