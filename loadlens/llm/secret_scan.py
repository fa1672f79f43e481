"""Secrets in texts, with a random forest that removes false positives.

Patterns propose candidates: key blocks, values assigned to a telling name, and long runs of key
characters, each searched on its own. Each candidate is described by its length, its transitions between classes of
characters, how much of it words of the corpus cover, how like a path it and its source are, and
the words next to it. A random forest (Spark's) trained on labelled candidates decides.

Labels are a table (value, secret); ``rule_labels`` makes one from the candidates themselves, where
published key formats or assignments leave no doubt. A value counts once in training, however
often it occurs, and at most ``TRAINED`` values of each label are used, those of least hash.

Defined results: NULL text counts as empty and has no findings. Repeated rows are reported each.
If either label has fewer than ``LEAST`` values there is no forest: a candidate counts as secret if
the rules say so or, where they say nothing, if it is assigned to a telling name. No rows give no rows. Texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.staging import stage
from loadlens.llm.tokens import some, text_of

#: Values of each label that a forest is trained on, at most.
TRAINED = 20_000
LEAST = 5
#: Words of the dictionary: the most common ones of 3 to 6 letters. A bound on what is sent to tasks.
DICTIONARY = 5_000
MASK = "[SECRET]"

_NAMES = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth)"
#: Kinds of candidates: (pattern, least length), each searched in the whole text. A span of an earlier
#: kind is cut out of those of later kinds.
_KINDS = {
    "block": (re.compile(r"(?P<value>-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?!-----BEGIN ).)*?-----END [A-Z ]*PRIVATE KEY-----)", re.DOTALL), 1),
    "named": (re.compile(rf"(?i:(?<![A-Za-z]){_NAMES}[\"']?[ \t]*[:=][ \t]*[\"']?)(?P<value>[^\s\"']{{6,}})"), 6),
    "run": (re.compile(r"(?P<value>[A-Za-z0-9+/_-]{16,}={0,2})"), 16),
}
_TELLING = re.compile(_NAMES, re.IGNORECASE)
_EXAMPLE = re.compile(r"test|example|sample|doc|spec|fixture", re.IGNORECASE)
#: Formats that only keys have: published prefixes of access keys, and key blocks.
_FORMAT = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}$|gh[pousr]_[A-Za-z0-9]{36}$|-----BEGIN ")

FEATURES = (
    "length", "letters", "digits", "capitals", "others", "distinct", "transitions", "letter_digit", "case_changes",
    "longest_letters", "covered", "slashes", "source_depth", "source_example", "telling_before", "assigned",
    "quoted", "telling_after",
)


@lru_cache(maxsize=100_000)
def _class(char: str) -> int:
    return 0 if char.islower() else 1 if char.isupper() else 2 if char.isdigit() else 3


def _covered(value: str, words: frozenset[str]) -> float:
    """The greatest share of the characters that dictionary words can cover side by side."""
    low = value.lower()
    best = [0] * (len(low) + 1)
    for end in range(1, len(low) + 1):
        best[end] = best[end - 1]
        for size in range(3, 7):
            if size <= end and best[end - size] + size > best[end] and low[end - size : end] in words:
                best[end] = best[end - size] + size
    return best[-1] / max(1, len(low))


def _spans(text: str) -> list[tuple[int, int, str]]:
    """(start, stop, kind) of the candidates of a text, in order, none overlapping."""
    taken: list[tuple[int, int, str]] = []
    for kind, (pattern, least) in _KINDS.items():
        own, k = [], 0
        for found in pattern.finditer(text):
            at, stop = found.span("value")
            while k < len(taken) and taken[k][1] <= at:
                k += 1
            j = k
            while j < len(taken) and taken[j][0] < stop:
                if taken[j][0] - at >= least:
                    own.append((at, taken[j][0], kind))
                at = max(at, taken[j][1])
                j += 1
            if stop - at >= least:
                own.append((at, stop, kind))
        taken = sorted(taken + own)
    return taken


def features(value: str, before: str, after: str, source: str, words: frozenset[str]) -> list[float]:
    n = max(1, len(value))
    kinds = [_class(x) for x in value]
    pairs = [(a, b) for a, b in zip(kinds, kinds[1:]) if a != b]
    longest = max((len(x) for x in re.findall(r"[^\W\d_]+", value)), default=0)
    return [
        float(len(value)), kinds.count(0) / n, kinds.count(2) / n, kinds.count(1) / n, kinds.count(3) / n,
        len(set(value)) / n, len(pairs) / n, sum(2 in x and 3 not in x for x in pairs) / n,
        sum(x in ((0, 1), (1, 0)) for x in pairs) / n, longest / n, _covered(value, words),
        value.count("/") / n, float(source.count("/")), float(bool(_EXAMPLE.search(source))),
        float(bool(_TELLING.search(before))), float(before.rstrip("\"' ")[-1:] in ("=", ":")),
        float(before[-1:] in ("'", '"')), float(bool(_TELLING.search(after))),
    ]


def _described(text: str, source: str, words: frozenset[str]) -> list[tuple[int, int, str, list[float], int | None]]:
    """(start, stop, value, features, rule) of the candidates of a text."""
    out = []
    for start, stop, kind in _spans(text):
        value = text[start:stop]
        if kind == "named":  # marks that end a sentence are not part of it
            value = value.rstrip(".,;)")
            stop = start + len(value)
        described = features(value, text[max(0, start - 24) : start], text[stop : stop + 24], source, words)
        out.append((start, stop, value, described, _rule(value, kind == "named")))
    return out


def _rule(value: str, named: bool) -> int | None:
    """What the rules are sure of: 1 a secret, 0 none, else nothing."""
    if _FORMAT.match(value):
        return 1
    letters, digits = sum(x.isalpha() for x in value), sum(x.isdigit() for x in value)
    if named:  # a password may be a word or a number
        return 1 if len(value) >= 12 and letters and digits else None
    return 0 if not digits or not letters else None


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> frozenset[str]:
    """The words of 3 to 6 letters that most documents have; ties by the word."""
    found = F.regexp_extract_all(F.lower(F.col(text_col).cast("string")), F.lit(r"(?<!\p{L})\p{L}{3,6}(?!\p{L})"), F.lit(0))
    words = docs.select(F.explode(F.array_distinct(found)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return frozenset(r["word"] for r in words.orderBy(F.desc("n"), "word").limit(size).collect())


def candidates(docs: DataFrame, words: frozenset[str], id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(doc_id, digest, start, stop, value, features, rule) in code points, end exclusive; ``digest`` is
    the SHA-256 of the text."""
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sources, at = batch.column(2).to_pylist(), 0
            for ids, texts in some([batch]):
                rows = []
                for doc_id, text in zip(ids, texts):
                    own = _described(text, sources[at], known)
                    digest = hashlib.sha256(text.encode()).hexdigest() if own else None
                    rows += [(doc_id, digest, *x) for x in own]
                    at += 1
                types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.float64()), pa.int32())
                columns = zip(*rows) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    schema = "doc_id bigint, digest string, start bigint, stop bigint, value string, features array<double>, rule int"
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(F.col(id_col).cast("bigint"), text_of(text_col), path).mapInArrow(run, schema)


def rule_labels(found: DataFrame) -> DataFrame:
    """(value, secret) of the values that the rules are sure of, wherever they stand."""
    values = found.groupBy("value").agg(F.max("rule").alias("secret"), F.count_if(F.col("rule").isNull()).alias("open"))
    return values.where("secret = 1 OR (secret = 0 AND open = 0)").select("value", "secret")


def _samples(found: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(value, secret, features): one candidate for each labelled value, at most ``most`` a label."""
    own = found.groupBy("value").agg(F.min("features").alias("features")).join(labels, "value")
    own = own.withColumn("h", F.xxhash64("value"))
    parts = [own.where(F.col("secret") == s).orderBy("h", "value").limit(most) for s in (0, 1)]
    return parts[0].unionByName(parts[1])


def train(found: DataFrame, labels: DataFrame, most: int = TRAINED, trees: int = 24, depth: int = 6, seed: int = 7) -> RandomForestClassificationModel | None:
    """A forest from the labelled values, or None with too few of either label."""
    rows = stage(_samples(found, labels, most), "labelled")
    sizes = {r["secret"]: r["n"] for r in rows.groupBy("secret").agg(F.count("*").alias("n")).collect()}
    if min(sizes.get(0, 0), sizes.get(1, 0)) < LEAST:
        return None
    # a bounded table in one order: the same trees in every run
    rows = rows.coalesce(1).sortWithinPartitions("h", "value")
    rows = rows.select(array_to_vector("features").alias("features"), F.col("secret").cast("double").alias("label"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird")
    return forest.fit(rows)


def judge(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """``found`` with ``probability`` and ``secret``."""
    if model is None:
        telling, assigned = (F.col("features")[FEATURES.index(x)] for x in ("telling_before", "assigned"))
        score = F.coalesce(F.col("rule").cast("double"), F.round(0.4 * telling + 0.3 * assigned, 6))
        return found.withColumn("probability", score).withColumn("secret", F.col("probability") >= 0.5)
    rows = found.withColumn("vector", array_to_vector("features"))
    model.setFeaturesCol("vector").setProbabilityCol("chances").setPredictionCol("decision").setRawPredictionCol("votes")
    out = model.transform(rows).withColumn("probability", F.round(vector_to_array("chances")[1], 6))
    return out.withColumn("secret", F.col("probability") >= 0.5).drop("vector", "chances", "decision", "votes")


def clean(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``docs`` with all secrets masked, by a forest trained on the candidates of ``docs``."""
    words = dictionary(docs, text_col)
    found = stage(candidates(docs, words, id_col, text_col, path_col), "candidates")
    return mask(docs, words, train(found, rule_labels(found) if labels is None else labels), text_col, path_col)


def scan(docs: DataFrame, labels: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(doc_id, digest, start, stop, value, probability, secret) of every candidate."""
    found = stage(candidates(docs, dictionary(docs, text_col), id_col, text_col, path_col), "candidates")
    model = train(found, rule_labels(found) if labels is None else labels)
    return judge(found, model).select("doc_id", "digest", "start", "stop", "value", "probability", "secret")


def forest(model: RandomForestClassificationModel) -> list[tuple[np.ndarray, ...]]:
    """Of each tree the feature and the threshold, the nodes to the left and to the right (for leaves
    themselves) and the share of secrets, by node: a fixed size, for use inside tasks."""
    trees = []
    for tree in model.trees:
        table, waiting = [], [tree._call_java("rootNode")]
        while waiting:  # breadth first: the children of a node get the next numbers
            node, k = waiting.pop(0), len(table)
            stats = list(node.impurityStats().stats())
            row = [0, 0.0, k, k, stats[1] / sum(stats)]
            if node.getClass().getSimpleName() == "InternalNode":
                row[:2] = node.split().featureIndex(), node.split().threshold()
                row[2:4] = k + len(waiting) + 1, k + len(waiting) + 2
                waiting += [node.leftChild(), node.rightChild()]
            table.append(row)
        trees.append(tuple(np.array(x) for x in zip(*table)))
    return trees


def chances(trees: list[tuple[np.ndarray, ...]] | None, described: np.ndarray, rules: list[int | None]) -> np.ndarray:
    """``probability`` of ``judge``, computed from the rows of features."""
    if trees is None:
        telling, assigned = (described[:, FEATURES.index(x)] for x in ("telling_before", "assigned"))
        fixed = 0.4 * telling + 0.3 * assigned
        return np.round([f if r is None else float(r) for f, r in zip(fixed, rules)], 6)
    votes = np.zeros(len(described))
    for feature, threshold, left, right, share in trees:
        at = np.zeros(len(described), np.int64)
        while True:
            goes_left = described[np.arange(len(at)), feature[at]] <= threshold[at]
            to = np.where(goes_left, left[at], right[at])
            if (to == at).all():
                break
            at = to
        votes += share[at]
    return np.round(votes / len(trees), 6)


def mask(docs: DataFrame, words: frozenset[str], model: RandomForestClassificationModel | None, text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """``docs`` with each secret replaced by ``MASK``, found and judged as ``candidates`` and ``judge`` do
    it, in one pass and without a join: ids are not read, and every row keeps its other columns. NULL
    texts stay NULL."""
    trees = None if model is None else forest(model)
    place, source = docs.columns.index(text_col), docs.columns.index(path_col) if path_col else None
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            texts = batch.column(place).to_pylist()
            sources = [""] * len(texts) if source is None else batch.column(source).cast(pa.string()).to_pylist()
            found = [(k, *x) for k, text in enumerate(texts) if text for x in _described(text, sources[k] or "", known)]
            if found:
                described = np.array([x[4] for x in found])
                secret = chances(trees, described, [x[5] for x in found]) >= 0.5
                for own, (k, start, stop, *_) in list(zip(secret, found))[::-1]:  # from the end: places stay
                    if own:
                        texts[k] = texts[k][:start] + MASK + texts[k][stop:]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, kinds)


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each secret of ``found`` (of ``scan``) replaced by ``MASK``. Findings belong to an id,
    which may be NULL, and a text, so rows that share an id are told apart by their texts."""
    spans = found.where("secret").groupBy(F.col("doc_id").alias("id"), "digest").agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans")
    )
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("own"), text_of(text_col).alias("text"))
    rows = rows.join(spans, F.col("own").eqNullSafe(F.col("id")) & (F.sha2(F.col("text").cast("binary"), 256) == F.col("digest")), "left")
    masked = F.expr(
        "CASE WHEN spans IS NULL THEN row.`" + text_col + "` ELSE aggregate(spans, named_struct('at', 0L, 'out', ''), "
        "(s, x) -> named_struct('at', x.stop, 'out', concat(s.out, "
        f"substring(text, cast(s.at + 1 AS int), cast(x.start - s.at AS int)), '{MASK}')), "
        "s -> concat(s.out, substring(text, cast(s.at + 1 AS int)))) END"
    )
    return rows.select(*[masked.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
