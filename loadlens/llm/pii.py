"""Personal data by patterns, and terms that give it away.

Patterns find the values to protect (entities). A term near an entity then counts as disclosing if
what it says about the entity is a large part of the entity's own information: with p(t|e) from the
distinct contexts of the entity, and p(t) and p(e) from the documents of the whole corpus,

    PMI(t; e) = log2(p(t|e) / p(t))   >=   ``alpha`` * IC(e) = -``alpha`` * log2 p(e)

Terms over the threshold are reported as spans of kind ``term`` wherever they stand near that
entity. Copies of a context count once, and ``evidence`` distinct contexts are needed. A context is
the ``CONTEXT`` code points of the text on either side, whatever stands there; other matches of the
entity's kind in it count as so many zeros. Terms farther away are not counted.

Defined results: NULL text counts as empty; a document without findings has zero counts and empty
span lists. Rows are told apart by their place in the input, so repeated rows are reported each.
Overlapping kinds are all reported. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.staging import stage

#: Kinds in the order of reports: (pattern, text that must be there, test of a match ``hit``).
#: Possessive repeats and the lookbehind only save retries that cannot match; \G lets a match start
#: right after the one before.
KINDS: dict[str, tuple[str, str, str]] = {
    "email": (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        "true",
    ),
    "ip": (
        r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
        ".",
        "forall(split(hit, '[.]'), x -> length(ltrim('0', x)) < 4 AND "
        "coalesce(try_cast(right(x, 9) AS int), 0) <= 255 )",
    ),
    "card": (
        r"[0-9](?:[\x20-]?[0-9])++",
        "",
        "length(digits) BETWEEN 16 AND 19 AND aggregate(sequence(1, length(digits)), 0, (s, k) -> s + "
        "CASE WHEN k % 2 = 1 THEN cast(substring(reverse(digits), k, 1) AS int) "
        "ELSE element_at(array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), cast(substring(reverse(digits), k, 1) AS int) + 1) END) % 10 = 0",
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+", "length(digits) BETWEEN 8 AND 15"),
}
#: What stands for a span in a sanitised text; terms are generalised to their kind as well.
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}

#: Code points on either side of an entity that are its context.
CONTEXT = 120
#: A term: a run of at least 3 letters, compared in lower case.
TERM = r"\p{L}{3,}"


def _hits(kind: str) -> Column:
    """Matches of a kind: (kind, k, gap before it in code points, the match, its context)."""
    pattern, needed, _ = KINDS[kind]
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if needed:
        found = F.when(text.contains(needed), found)
    return found.alias(kind)


def _context(kind: str, side: str) -> str:
    """The code points on one side of match ``k``, put together from the gaps and matches there."""
    hits, gaps, n = kind, f"{kind}_gaps", CONTEXT
    most = -(-n // 2)  # a match has two code points at least
    if side == "before":
        first, number = f"greatest(k - {most}, 0) + 1", f"least(k, {most})"
        pairs = f"zip_with(slice({gaps}, {first}, {number}), slice({hits}, {first}, {number}), (g, x) -> concat(right(g, {n}), repeat('0', least(length(x), {n}))))"
        out = f"right(concat(array_join({pairs}, ''), right({gaps}[k], {n})), {n})"
    else:
        pairs = f"zip_with(slice({hits}, k + 2, {most}), slice({gaps}, k + 3, {most}), (x, g) -> concat(repeat('0', least(length(x), {n})), left(g, {n})))"
        out = f"left(concat(left({gaps}[k + 1], {n}), array_join({pairs}, '')), {n})"
    # numbers too short for a card need no context
    return f"CASE WHEN length(h) < 16 THEN '' ELSE {out} END" if kind == "card" else out


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, hits) of each row: all pattern matches, those that fail their test included."""
    out = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    out = out.select("row", "doc_id", "text", *(_hits(kind) for kind in KINDS))
    for kind, (pattern, _, _) in KINDS.items():
        # only texts with matches are cut at them
        gaps = F.when(F.size(kind) > 0, F.split("text", pattern, -1))
        out = out.withColumn(f"{kind}_gaps", gaps)
    each = [
        f"CASE WHEN {kind}_gaps IS NULL THEN array() ELSE transform({kind}, (h, k) -> named_struct("
        f"'kind', '{kind}', 'k', k, 'gap', length({kind}_gaps[k]), 'hit', h, "
        f"'before', {_context(kind, 'before')}, 'after', {_context(kind, 'after')})) END"
        for kind in KINDS
    ]
    kinds = "array<struct<kind:string,k:int,gap:int,hit:string,before:string,after:string>>"
    each = [f"cast({x} AS {kinds})" for x in each]
    return out.select("row", "doc_id", F.expr(f"concat({', '.join(each)})").alias("hits"))


def entities(found: DataFrame) -> DataFrame:
    """(row, kind, place, hit, start, end, before, after) of the matches that pass their test."""
    rows = found.select("row", F.inline("hits"))
    order = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(order))
    rows = rows.withColumn("digits", F.regexp_replace("hit", "[^0-9]", ""))
    valid = " ".join(f"WHEN kind = '{kind}' THEN {test}" for kind, (_, _, test) in KINDS.items())
    place = " ".join(f"WHEN kind = '{kind}' THEN {k}" for k, kind in enumerate(KINDS))
    return rows.where(f"CASE {valid} END").select(
        "row", "kind", F.expr(f"CASE {place} END").alias("place"), "hit",
        (F.col("end") - F.length("hit")).alias("start"), "end", "before", "after",
    )


def term_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, df): the number of documents that hold each term, over the whole corpus."""
    terms = F.array_distinct(F.regexp_extract_all(F.lower(F.col(text_col).cast("string")), F.lit(TERM), F.lit(0)))
    return docs.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def _near(side: str, offset: str) -> str:
    """Terms of one side of the context with their places in the text."""
    return (
        f"transform(regexp_extract_all({side}, '(?<!\\\\p{{L}}){TERM.replace(chr(92), chr(92) * 2)}', 0), (t, k) -> named_struct('term', lower(t), "
        f"'start', {offset} + aggregate(slice(split({side}, '(?<!\\\\p{{L}}){TERM.replace(chr(92), chr(92) * 2)}', -1), 1, k + 1), 0, (s, x) -> s + length(x)) "
        f"+ aggregate(slice(regexp_extract_all({side}, '(?<!\\\\p{{L}}){TERM.replace(chr(92), chr(92) * 2)}', 0), 1, k), 0, (s, x) -> s + length(x)), "
        "'length', length(t)))"
    )


def disclosing(docs: DataFrame, known: DataFrame, alpha: float = 0.9, evidence: int = 2, text_col: str = "text") -> DataFrame:
    """(row, start, end) of the terms near an entity that give it away. ``known``: ``entities``."""
    value = F.lower("hit").alias("entity")
    # a term cut by the edge of its context is left out
    cut = known.withColumn("before", F.expr(f"CASE WHEN length(before) = {CONTEXT} THEN regexp_replace(before, '^\\\\p{{L}}+', '') ELSE before END"))
    cut = cut.withColumn("after", F.expr(f"CASE WHEN length(after) = {CONTEXT} THEN regexp_replace(after, '\\\\p{{L}}+$', '') ELSE after END"))
    near = cut.select(
        "row", value, F.xxhash64("before", "after").alias("context"),
        F.inline(F.expr(f"concat({_near('before', 'start - length(before)')}, {_near('after', 'end')})")),
    )
    near = stage(near, "near")
    total = docs.count()
    seen = near.groupBy("entity", "term", "context").agg(F.lit(1).alias("one"))
    pairs = seen.groupBy("entity", "term").agg(F.count("*").alias("co")).where(F.col("co") >= evidence)
    held = cut.groupBy(value, "row").agg(F.lit(1).alias("one")).groupBy("entity").agg(F.count("*").alias("rows"))
    contexts = near.groupBy("entity", "context").agg(F.lit(1).alias("one")).groupBy("entity").agg(F.count("*").alias("contexts"))
    scored = pairs.join(held, "entity").join(contexts, "entity").join(term_counts(docs, text_col), "term")
    pmi = F.log2(F.col("co") / F.col("contexts") * total / F.col("df"))
    strong = scored.where(pmi >= alpha * F.log2(total / F.col("rows"))).select("entity", "term")
    # a term that lies in an entity of another kind is part of that entity
    spans = near.join(strong, ["entity", "term"]).select("row", "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    inside = spans.join(known.select("row", F.col("start").alias("s"), F.col("end").alias("e")), "row").where("start < e AND s < end")
    return spans.join(inside.select("row", "start", "end").distinct(), ["row", "start", "end"], "left_anti")


def find(docs: DataFrame, alpha: float = 0.9, evidence: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, spans) with spans (place, kind, start, end), entities by kind
    and then terms, in code points, end exclusive."""
    found = stage(candidates(docs, id_col, text_col), "candidates")
    known = stage(entities(found.where(F.size("hits") > 0)), "entities")
    terms = disclosing(docs, known, alpha, evidence, text_col)
    spans = known.select("row", "place", "kind", "start", "end").unionByName(
        terms.select("row", F.lit(len(KINDS)).alias("place"), F.lit("term").alias("kind"), "start", "end")
    )
    lists = spans.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("place", "start", "end", "kind"))).alias("spans")
    )
    empty = F.expr("cast(array() AS array<struct<place:int,start:bigint,end:bigint,kind:string>>)")
    return found.select("row", "doc_id").join(lists, "row", "left").select("doc_id", F.coalesce("spans", empty).alias("spans"))


def report(spans: DataFrame) -> DataFrame:
    """The counts and digests of ``find``."""
    text = "array_join(transform({}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"
    base = text.format(f"filter(spans, x -> x.place < {len(KINDS)})")
    return spans.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(spans, x -> x.kind = '{kind}')) AS bigint)").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(F.expr(base), 256).alias("base_sha256"),
        F.expr(text.format("spans")).alias("spans"),
    )


def sanitise(docs: DataFrame, spans: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each span masked; of overlapping spans the first, and of those the longest, gives
    the mask. Without ``spans``, those of ``find``, for rows numbered on their own: ids may repeat or be
    NULL. Given ``spans`` (of ``find``) are matched by id, so each row's id must be its own and not
    NULL, else this raises."""
    own = F.array_sort(
        F.transform("spans", lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("end"), x["kind"].alias("kind")))
    )
    masks = F.create_map(*(F.lit(x) for pair in MASKS.items() for x in pair))
    rows = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), F.col(id_col).cast("bigint").alias("id"))
    if spans is None:
        rows = stage(rows.withColumn("id", F.monotonically_increasing_id()), "numbered")
        spans = find(rows, id_col="id")
    elif not spans.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        raise ValueError("ids are NULL or repeat: call without spans")
    rows = rows.join(spans.select(F.col("doc_id").alias("id"), own.alias("spans")), "id", "left").withColumn("masks", masks)
    out = F.expr(
        "aggregate(coalesce(spans, array()), named_struct('at', 0L, 'out', ''), (s, x) -> CASE WHEN x.start < s.at THEN s ELSE "
        "named_struct('at', -x.end, 'out', concat(s.out, substring(text, cast(s.at + 1 AS int), cast(x.start - s.at AS int)), masks[x.kind])) END, "
        "s -> concat(s.out, substring(text, cast(s.at + 1 AS int))))"
    )
    return rows.withColumn("text", out).select(*[F.col("text" if c == text_col else f"row.`{c}`").alias(c) for c in docs.columns])
