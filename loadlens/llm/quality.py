"""Quality statistics of whole texts and a decision list learned from labels.

The statistics are DataFrame expressions over the arrays of words and lines of a text. The list is
learned by sequential covering: a rule, a conjunction of thresholds, is grown on two thirds of the
labelled rows by information gain, pruned on the others, and kept if it is precise there; the rows
it covers are taken away and the next rule is grown. Each step is one aggregation of the labelled
rows into counts per statistic and threshold bin, a few hundred rows whatever the input, so all
labelled rows count. The result is one ordered CASE expression.

Defined results: NULL text has no words and counts as empty. A document without words fails the base
rules, as any with under 50 words. Repeated rows are judged each. Rows without a label, or labels
without a document, teach nothing; with no labels the list is empty and keeps everything. No rows
give no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.staging import stage

#: White space that words are cut at.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
_BLANK = r"[\x20\x09-\x0D]+"

#: The statistics that rules may use, as SQL over the columns of ``statistics``.
RATES = {
    "words": "n_words",
    "mean_word_length": "100 * word_chars div greatest(n_words, 1)",
    "symbol_rate": "1000 * n_symbols div greatest(word_chars, 1)",
    "exclaim_rate": "1000 * n_exclaims div greatest(word_chars, 1)",
    "upper_rate": "1000 * n_upper div greatest(word_chars, 1)",
    "dup_line_rate": "1000 * n_dup_lines div greatest(n_lines, 1)",
    "repeat_rate": "1000 * n_repeat_words div greatest(n_words, 1)",
}


def _left_of(text: Column, others: str) -> Column:
    """Number of characters that are not in the class ``others``."""
    return F.length(F.regexp_replace(text, others, "")).cast("bigint")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, n_exclaims, n_upper, base_failed; with ``whole``, all its columns as ``row`` besides."""
    row = [F.struct("*").alias("row")] if whole else []
    also = ["row"] if whole else []
    text = F.col("text")
    out = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *row,
    ).withColumn("trimmed", F.btrim(text, F.lit(BLANKS)))
    out = out.select(
        "doc_id",
        F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", _BLANK)).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("lines"),
        _left_of(text, "[^#*$%&|<>]+").alias("n_symbols"),
        _left_of(text, "[^!]+").alias("n_exclaims"),
        _left_of(text, r"[^\p{Lu}]+").alias("n_upper"),
        *also,
    )
    out = out.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").cast("bigint").alias("n_lines"),
        "n_exclaims",
        "n_upper",
        # hashes of the 3-word windows; ``words`` is a column here, so it is not split again
        F.expr(
            "CASE WHEN size(words) < 3 THEN cast(array() AS array<bigint>) ELSE "
            "transform(sequence(0, size(words) - 3), i -> xxhash64(words[i], words[i + 1], words[i + 2])) END"
        ).alias("windows"),
        *also,
    )
    out = out.withColumn(
        "placed",
        F.expr(
            "CASE WHEN size(array_distinct(windows)) < size(windows) THEN "
            "array_sort(transform(windows, (w, i) -> struct(w, i))) END"
        ),
    )
    # starts of windows whose neighbour in hash order is the same window
    out = out.withColumn(
        "starts",
        F.expr(
            "CASE WHEN placed IS NOT NULL THEN array_sort(transform(filter(placed, (x, k) -> "
            "(k > 0 AND placed[greatest(k - 1, 0)].w = x.w) OR "
            "(k + 1 < size(placed) AND placed[least(k + 1, size(placed) - 1)].w = x.w)), x -> x.i)) END"
        ),
    )
    # each such window adds the words that the one before does not cover
    out = out.withColumn(
        "n_repeat_words",
        F.expr(
            "CASE WHEN starts IS NULL THEN 0L ELSE cast(aggregate(starts, "
            "struct(0 AS n, -3 AS last), (s, x) -> struct(s.n + least(3, x - s.last) AS n, x AS last), s -> s.n) AS bigint) END"
        ),
    )
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "n_lines", "n_exclaims", "n_upper",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        *also,
    )


@dataclass
class Condition:
    rate: str
    above: bool  # over the threshold, or at most the threshold
    threshold: int
    bin: int

    def sql(self) -> str:
        return f"({RATES[self.rate]}) {'>' if self.above else '<='} {self.threshold}"

    def on_bins(self) -> Column:
        return F.col(self.rate) > self.bin if self.above else F.col(self.rate) <= self.bin


@dataclass
class DecisionList:
    """Rules that reject, in order; what none of them covers is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def sql(self) -> str:
        if not self.rules:
            return "true"
        cases = (f"WHEN {' AND '.join(c.sql() for c in rule)} THEN false" for rule in self.rules)
        return f"CASE {' '.join(cases)} ELSE true END"

    def verdict(self) -> Column:
        return F.expr(self.sql())


def _counts(rows: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
    """(bad, good) rows per statistic and bin: at most len(RATES) * (bins + 1) rows."""
    pairs = ", ".join(f"'{r}', {r}" for r in RATES)
    long = rows.selectExpr("bad", "n", f"stack({len(RATES)}, {pairs}) AS (rate, bin)")
    found = long.groupBy("rate", "bin").agg(
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("q"),
    )
    return {(r["rate"], r["bin"]): (r["p"], r["q"]) for r in found.collect()}


def _best(counts: dict[tuple[str, int], tuple[int, int]], cuts: dict[str, list[int]], least: int) -> Condition | None:
    """The threshold of highest information gain for the bad rows."""
    best, gain = None, 0.0
    for rate, thresholds in cuts.items():
        bins = [counts.get((rate, b), (0, 0)) for b in range(len(thresholds) + 1)]
        p_all, q_all = (sum(x[i] for x in bins) for i in (0, 1))
        if not p_all:
            continue
        before, p, q = math.log2(p_all / (p_all + q_all)), 0, 0
        for b, threshold in enumerate(thresholds):
            p, q = p + bins[b][0], q + bins[b][1]
            for above, x, y in ((False, p, q), (True, p_all - p, q_all - q)):
                if x >= least and (g := x * (math.log2(x / (x + y)) - before)) > gain + 1e-9:
                    best, gain = Condition(rate, above, threshold, b), g
    return best


def learn(stats: DataFrame, labels: DataFrame, bins: int = 24, max_rules: int = 12, max_conditions: int = 4,
          precision: float = 0.95, least: int = 5) -> DecisionList:
    """Decision list from ``stats`` and ``labels`` (doc_id, quality: 0 is bad). A rule stays if at
    least ``precision`` of what it covers in the pruning rows is bad and both parts have ``least``
    bad rows under it."""
    own = labels.where("quality IS NOT NULL").groupBy("doc_id").agg((F.max("quality") == 0).alias("bad"))
    rows = stats.join(own, "doc_id").selectExpr(
        "bad", "pmod(xxhash64(doc_id), 3) < 2 AS grow", *(f"{sql} AS {rate}" for rate, sql in RATES.items())
    )
    rows = stage(rows, "labelled")
    parts = [k / (bins + 1) for k in range(1, bins + 1)]
    # thresholds from the bad rows and from the good ones alike
    marks = rows.groupBy("bad").agg(*(F.percentile_approx(r, parts, 2000).alias(r) for r in RATES)).collect()
    cuts = {r: sorted({x for row in marks for x in row[r]}) for r in RATES}
    binned = [
        f"size(filter(array({', '.join(f'{x}L' for x in cuts[r])}), x -> x < {r})) AS {r}" if cuts[r] else f"0 AS {r}"
        for r in RATES
    ]
    grid = rows.selectExpr("bad", "grow", *binned).groupBy("bad", "grow", *RATES).agg(F.count("*").alias("n"))
    left = stage(grid, "grid")
    found = DecisionList()
    while len(found.rules) < max_rules:
        rule: list[Condition] = []
        covered = left.where("grow")
        while len(rule) < max_conditions:
            condition = _best(_counts(covered), cuts, least)
            if condition is None:
                break
            rule.append(condition)
            covered = covered.where(condition.on_bins())
        if not rule:
            break
        # prune: the first so many conditions that are worth most on the other rows
        under, sums = F.lit(True), []
        for condition in rule:
            under = under & condition.on_bins()
            sums += [F.sum(F.when(under & F.col("bad"), F.col("n"))), F.sum(F.when(under & ~F.col("bad"), F.col("n")))]
        row = [x or 0 for x in left.where("NOT grow").agg(*sums).first()]
        worth = [((p - q) / (p + q) if p + q else -1.0, p, q) for p, q in zip(row[::2], row[1::2])]
        at = max(range(len(rule)), key=lambda k: (worth[k][0], -k))
        _, p, q = worth[at]
        if p < least or p < precision * (p + q):
            break
        rule = rule[: at + 1]
        found.rules.append(rule)
        under = F.lit(True)
        for condition in rule:
            under = under & condition.on_bins()
        left = left.where(~under)
    return found


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``statistics`` with ``kept``: false under the base rules or the learned list."""
    stats = stage(statistics(docs, id_col, text_col), "statistics")
    return stats.withColumn("kept", ~F.col("base_failed") & learn(stats, labels).verdict())


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns. Each row has a verdict of its
    own, whatever its id: rows without one and rows that share one are judged by their texts."""
    stats = stage(statistics(docs, id_col, text_col, whole=True), "judged-rows")
    return stats.where(~F.col("base_failed") & learn(stats, labels).verdict()).select("row.*")
