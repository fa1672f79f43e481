"""How much the sources of a language differ in their words, exactly, with late strings.

Terms travel as 64-bit digests; a text's terms are counted where the text is read. Strings are
looked at twice: the least and the greatest string of every digest that is kept tell whether
different terms share it, in which case its occurrences are counted again by string (``split``), and
the rows that are returned get their text by a join in the end.

Of each language the terms in at least ``least`` of its documents count. A group is a (lang, source)
that occurs. With n the occurrences of a term in a group, N their sum over the kept terms and V the
number of these, its share is p = 1 + floor(10^9 (n + 5) / (N + 5 V)), in integers.

* ``pair``: for each group and each other source of its language, the sum of |p - q| over all kept
  terms. Terms that neither has are the same for all, so only the others are compared, in dense
  tiles of sources by blocks of terms; the pairs of a tile are summed before they are shuffled.
* ``term``: the kept terms of a group whose share is above that of the whole language, ``top`` of
  them by the difference.

Defined results: NULL text, lang or source count as ''. Every row is a document of its own, repeated
ids included; ids are not read. Groups without terms take part with shares of no occurrences. A
language without kept terms has pairs of value 0; one with one source has no pairs. Ties are settled
by the text of the item, in the order of its UTF-8 bytes. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.staging import stage

#: What stands between terms: all of ASCII but letters.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Characters whose terms are counted together before they leave the task.
AT_ONCE = 8_000_000
#: Sources a tile and terms a block of the dense comparison.
TILE, BLOCK = 128, 512
#: Bits of the sieve that keeps most terms without a chance from leaving the tasks; 4 MB at any size of
#: the corpus. What it lets through by mistake is dropped by a join.
SIEVE = 1 << 25

COUNTS = "lang string, source string, digest bigint, n bigint, docs bigint"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with about ``AT_ONCE`` bytes of text at a time, whatever the batch size."""
    held, size = [], 0
    for batch in batches:
        first = 0
        for k, n in enumerate(pc.binary_length(batch["text"]).to_pylist()):
            if size and size + n > AT_ONCE:
                held.append(batch.slice(first, k - first))
                yield pa.concat_batches(held)
                held, size, first = [], 0, k
            size += n
        held.append(batch.slice(first))
    if held:
        yield pa.concat_batches(held)


def _digests(terms: pa.Array, bits: int) -> np.ndarray:
    import xxhash

    digest, raw = xxhash.xxh3_64_intdigest, memoryview(terms.buffers()[2] or b"")
    places = np.frombuffer(terms.buffers()[1], "<i4")[terms.offset : terms.offset + len(terms) + 1].tolist()
    made = np.array([digest(raw[a:b]) for a, b in zip(places, places[1:])], np.uint64)
    return (made & np.uint64((1 << bits) - 1)).view(np.int64)


def sieve(digests: DataFrame) -> bytes:
    """Bitmap of the lower bits of the digests: at most ``SIEVE`` / 64 numbers reach the driver."""
    place = F.col("digest").bitwiseAND(SIEVE - 1)
    words = digests.groupBy(F.shiftright(place, 6).alias("word"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(digest & 63 as int))")).alias("bits")).toPandas()
    made = np.zeros(SIEVE // 64, np.int64)
    made[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return made.tobytes()


def _passes(own: bytes, digests: np.ndarray) -> np.ndarray:
    place = digests & (SIEVE - 1)
    return (np.frombuffer(own, np.int64)[place >> 6] >> (place & 63)) & 1 == 1


def _sums(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys and the sums of the values of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return [keys[first], *(np.add.reduceat(x[order], first) if len(first) else x[:0] for x in values)]


def occurrences(docs: DataFrame, by_source: bool, strings: bool, bits: int = 64, through: bytes | None = None, apart: bool = False) -> DataFrame:
    """Occurrences (``n``) and documents (``docs``) of each term in some texts of one language, or of
    one group if ``by_source``; with ``strings``, the ``term`` itself as well. Several rows a term.
    Terms that the sieve ``through`` stops are left out. With ``apart``, the terms stand in rows of
    their own, without a source or occurrences, one for each language that some texts have them in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            rows = pc.split_pattern_regex(pc.ascii_lower(chunk["text"]), BETWEEN)
            coded = pc.dictionary_encode(rows.flatten())
            terms = coded.dictionary
            if not len(terms):
                continue
            code = coded.indices.to_numpy().astype(np.int64)
            of_row = pc.list_parent_indices(rows).to_numpy().astype(np.int64)
            digests = _digests(terms, bits)
            real = pc.greater(pc.binary_length(terms), 0).to_numpy(zero_copy_only=False)
            real = (real if through is None else real & _passes(through, digests))[code]
            pairs = np.sort(of_row[real] * len(terms) + code[real])  # a document's occurrences of a term
            first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else pairs
            n = np.diff(np.append(first, len(pairs)))
            of_row, code = np.divmod(pairs[first], len(terms))
            langs = chunk["lang"].dictionary_encode()
            of_lang = langs.indices.to_numpy().astype(np.int64)
            sources = chunk["source"].dictionary_encode()
            group = of_lang * len(sources.dictionary) + sources.indices.to_numpy() if by_source else of_lang
            once = np.unique(of_lang[of_row] * len(terms) + code) if apart else None
            keys, n, count = _sums(group[of_row] * len(terms) + code, n, np.ones(len(n), np.int64))
            group, code = np.divmod(keys, len(terms))
            lang, source = np.divmod(group, len(sources.dictionary)) if by_source else (group, None)
            columns = [
                langs.dictionary.take(pa.array(lang)),
                sources.dictionary.take(pa.array(source)) if by_source else pa.nulls(len(keys), pa.string()),
                pa.array(digests[code]),
                pa.array(n),
                pa.array(count),
            ]
            if strings or apart:
                columns.append(terms.take(pa.array(code)) if strings else pa.nulls(len(keys), pa.string()))
            names = [x.split()[0] for x in (COUNTS + ", term string").split(", ")][: len(columns)]
            yield pa.RecordBatch.from_arrays(columns, names)
            if apart:
                lang, code = np.divmod(once, len(terms))
                zeros = pa.array(np.zeros(len(once), np.int64))
                columns = [langs.dictionary.take(pa.array(lang)), pa.nulls(len(once), pa.string()), pa.array(digests[code])]
                yield pa.RecordBatch.from_arrays([*columns, zeros, zeros, terms.take(pa.array(code))], names)

    return docs.mapInArrow(run, COUNTS + ", term string" * (strings or apart))


def kept_terms(docs: DataFrame, least: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """(lang, source, digest, split, n) of the kept terms that a group has, and the strings (lang,
    digest, least, most) of the digests; both stored."""
    by_lang = occurrences(docs, False, False, bits).groupBy("lang", "digest").agg(F.sum("docs").alias("docs"))
    likely = stage(by_lang.where(F.col("docs") >= least).select("lang", "digest"), "likely-terms")
    own = sieve(likely)
    # counts and strings come from one reading of the texts; a row with a string has no source
    both = occurrences(docs, True, False, bits, own, apart=True).groupBy("lang", "source", "digest", "term")
    both = stage(both.agg(F.sum("n").alias("n")), "term-occurrences")
    strings = both.where("source IS NULL").groupBy("lang", "digest").agg(F.min("term").alias("least"), F.max("term").alias("most"))
    strings = stage(strings.join(likely, ["lang", "digest"], "left_semi"), "term-strings")
    shared = strings.where("least <> most").select("lang", "digest")
    alone = strings.where("least = most").select("lang", "digest")

    counts = both.where("source IS NOT NULL").select("lang", "source", "digest", "n")
    counts = counts.join(alone, ["lang", "digest"], "left_semi").withColumn("split", F.lit(""))
    if not shared.isEmpty():
        again = occurrences(docs, True, True, bits, sieve(shared))
        again = again.groupBy("lang", "source", "digest", F.col("term").alias("split"))
        again = again.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).join(shared, ["lang", "digest"], "left_semi")
        whole = Window.partitionBy("lang", "digest", "split")
        again = again.withColumn("docs", F.sum("docs").over(whole)).where(F.col("docs") >= least)
        counts = counts.unionByName(again.drop("docs"))
    return stage(counts, "term-counts"), strings


def _share(n: str, total: str) -> Column:
    """The share of ``n`` occurrences, exact beyond 64 bits."""
    return F.expr(f"1 + (cast({n} + 5 as decimal(28, 0)) * 1000000000) div cast({total} as decimal(28, 0))")


def statistics(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """Of each group its number ``place`` in its language, N + 5 V (``total``), that of its language
    (``whole``), V (``terms``), and the share of a term it does not have (``none``)."""
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    terms = counts.select("lang", "digest", "split").distinct().groupBy("lang").agg(F.count("*").alias("terms"))
    groups = docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(terms, "lang", "left")
    groups = groups.fillna(0, ["n", "terms"]).withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = groups.withColumn("whole", F.sum("n").over(Window.partitionBy("lang")) + 5 * F.col("terms"))
    groups = groups.withColumn("total", F.col("n") + 5 * F.col("terms")).drop("n")
    return groups.withColumn("none", F.when(F.col("terms") > 0, _share("0", "total")).otherwise(0))


def _tile(key: tuple, table: pa.Table) -> pa.Table:
    """Of each pair of sources of two tiles, the sum over one block of terms of what their difference
    is above that of terms which neither has."""
    _, _, left, right = (x.as_py() for x in key)
    place, share = (table[x].to_numpy() for x in ("place", "p"))
    base = pc.is_null(table["digest"]).to_numpy()
    sources, of_source = np.unique(place, return_inverse=True)
    none = np.zeros(len(sources), np.int64)
    none[of_source[base]] = share[base]
    table, of_source, share = table.filter(pa.array(~base)), of_source[~base], share[~base]
    split = pc.dictionary_encode(table["split"].combine_chunks())
    _, digest = np.unique(table["digest"].to_numpy(), return_inverse=True)
    terms, of_term = np.unique(digest * (len(split.dictionary) + 1) + split.indices.to_numpy(), return_inverse=True)
    dense = np.repeat(none[:, None], len(terms), axis=1)
    dense[of_source, of_term] = share
    first, second, sums = [], [], []
    for k in np.flatnonzero(sources // TILE == left):
        others = np.flatnonzero((sources // TILE == right) & (sources > sources[k]))
        first.append(np.full(len(others), sources[k]))
        second.append(sources[others])
        sums.append(np.abs(dense[others] - dense[k]).sum(axis=1) - len(terms) * np.abs(none[others] - none[k]))
    parts = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (first, second, sums)]
    lang = pa.array([key[0].as_py()] * len(parts[0]), pa.string())
    return pa.Table.from_arrays([lang, *(pa.array(x.astype(np.int64)) for x in parts)], ["lang", "first", "second", "more"])


def pair_rows(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """The ``pair`` part, without ranks."""
    sized = groups.select(
        "lang", "source", "place", "none", "terms",
        F.ceil(F.col("terms") / BLOCK).cast("bigint").alias("blocks"),
        F.floor(F.max("place").over(Window.partitionBy("lang")) / TILE).alias("tiles"),
    )
    # each group's share of a term it does not have, for every block of terms
    base = sized.where("blocks > 0").select(
        "lang", "place", "tiles", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"),
        F.lit(None).cast("bigint").alias("digest"), F.lit("").alias("split"), F.col("none").alias("p"),
    )
    block = F.pmod(F.xxhash64("digest", "split"), F.col("blocks")).alias("block")
    own = shares.join(sized.select("lang", "source", "blocks", "tiles"), ["lang", "source"])
    own = own.select("lang", "place", "tiles", block, "digest", "split", "p")
    tile = F.floor(F.col("place") / TILE)
    rows = base.unionByName(own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles"))))
    rows = rows.withColumns({"left": F.least(tile, F.col("other")), "right": F.greatest(tile, F.col("other"))})
    dealt = rows.select("lang", "block", "left", "right", "place", "digest", "split", "p")
    more = dealt.groupBy("lang", "block", "left", "right").applyInArrow(_tile, "lang string, first bigint, second bigint, more bigint")
    more = more.groupBy("lang", "first", "second").agg(F.sum("more").alias("more"))

    a = sized.select("lang", "source", "place", "none", "terms")
    b = sized.select("lang", F.col("source").alias("item"), F.col("place").alias("_place"), F.col("none").alias("_none"))
    pairs = a.join(b, "lang").where("place <> _place")  # all of these are rows of the result
    pairs = pairs.withColumns({"first": F.least("place", "_place").cast("bigint"), "second": F.greatest("place", "_place").cast("bigint")})
    value = F.col("terms") * F.abs(F.col("none") - F.col("_none")) + F.coalesce(F.col("more"), F.lit(0))
    return pairs.join(more, ["lang", "first", "second"], "left").select("lang", "source", "item", value.alias("value"))


def term_rows(shares: DataFrame, strings: DataFrame, top: int) -> DataFrame:
    """The ``term`` part, without ranks: all rows that may be among the first ``top``."""
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    more = shares.where("p > q").withColumn("value", F.col("p") - F.col("q"))
    more = more.withColumn("_rank", F.rank().over(best)).where(F.col("_rank") <= top)  # ties at the end stay
    item = F.when(F.col("split") == "", F.col("least")).otherwise(F.col("split"))
    return more.join(strings.select("lang", "digest", "least"), ["lang", "digest"]).select("lang", "source", item.alias("item"), "value")


def audit(docs: DataFrame, least: int = 30, top: int = 50, bits: int = 64, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank); see the module. ``bits`` shortens the digests, for tests
    of the split."""
    text = {"lang": lang_col, "source": source_col, "text": text_col}
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for name, c in text.items()])
    counts, strings = kept_terms(docs, least, bits)
    groups = stage(statistics(docs, counts), "groups")
    whole = Window.partitionBy("lang", "digest", "split")
    shares = counts.withColumn("_n", F.sum("n").over(whole)).join(groups, ["lang", "source"])
    shares = shares.withColumns({"p": _share("n", "total"), "q": _share("_n", "whole")})
    shares = stage(shares.select("lang", "source", "place", "digest", "split", "p", "q"), "shares")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pair_rows(shares, groups).withColumns({"part": F.lit("pair"), "rank": F.row_number().over(order)})
    terms = term_rows(shares, strings, top).withColumns({"part": F.lit("term"), "rank": F.row_number().over(order)})
    return pairs.select(columns).unionByName(terms.where(F.col("rank") <= top).select(columns))
