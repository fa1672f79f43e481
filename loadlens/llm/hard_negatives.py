"""Hard negatives for labelled vectors by a vertical scan that bounds what is left (BOND).

Vectors are dealt into shelves, on which they stand dimension by dimension. Every anchor visits every
shelf: the dimensions are read in descending order of the anchor's own magnitudes; what the dimensions
not yet read can add to a score lies between the sums of the least and greatest products that the
shelf's column ranges allow. Candidates whose bounds cannot reach the best found so far, or the
window asked for, leave the bitmap, and those that remain in the end have their exact scores. The
first scan finds each anchor's positives, the second one the negatives in the window of each.

A shelf's rows come before its anchors in one sorted partition, so a task holds one shelf (at most
about ``SHELF`` vectors) and a batch of anchors. Anchors are a stated part of the rows, and each of
them meets all rows; the shelves are as many as the shuffle partitions, more where they would be
too large.

Scores are integers: each component becomes floor(scale * x). They are computed in 64-bit floats as
long as these are exact, else in unbounded integers; a score beyond 64 bits is an error.

Defined results: rows whose id, label or vector is NULL, or that have a NULL or non-finite component,
take no part. Missing dimensions of shorter vectors count as 0. Rows that share an id are rows of
their own: each anchor row has its results, and other rows of its id may be its positives. Ties go
to the smaller id. Anchors without a positive, positives without a negative, and tables without rows
give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.staging import stage

#: Vectors a shelf.
SHELF = 32_768
#: Dimensions between two looks at the bounds.
STRIDE = 8
#: Integers up to here are exact as 64-bit floats.
EXACT = 1 << 53


def prepare(vectors: DataFrame, label: Column, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(row, vec_id, label, v) of the rows that take part, stored; ``row`` is a number of their own."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), label.alias("label"), x.cast("array<double>").alias(vector_col))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
    # kept as doubles: those beyond 2^53 are whole already, and their floor may not fit 64 bits
    whole = lambda e: F.when(F.abs(e) < EXACT, F.floor(e).cast("double")).otherwise(e)
    v = F.transform(vector_col, lambda e: whole(e * F.lit(float(scale))))
    return stage(rows.select("vec_id", "label", v.alias("v"), F.monotonically_increasing_id().alias("row")), "vectors")


def _unbounded(x: np.ndarray) -> np.ndarray:
    """Whole floats as Python's integers."""
    return np.array([int(e) for e in x.ravel()], object).reshape(x.shape)


class Shelf:
    """Vectors by dimension, with the range of each dimension."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.rows, self.ids, self.labels = rows, ids, labels
        self.columns = np.ascontiguousarray(vectors.T)
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)
        self.reach = max(np.abs(self.least).max(initial=0), np.abs(self.most).max(initial=0))

    def scan(self, anchor: np.ndarray, alive: np.ndarray, useful: Callable) -> tuple[np.ndarray, np.ndarray]:
        """(places, exact scores) of the candidates that ``useful(least, most)`` never turned down,
        given bounds of the scores of all that are alive."""
        size = min(len(anchor), len(self.columns))  # what one of them lacks is 0
        anchor, columns, least, most = anchor[:size], self.columns[:size], self.least[:size], self.most[:size]
        if np.abs(anchor).max(initial=0) * self.reach * size >= EXACT:
            anchor, columns, least, most = (_unbounded(x) for x in (anchor, columns, least, most))
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * least, anchor * most])
        low, high = ends.min(axis=0)[order], ends.max(axis=0)[order]
        # after k dimensions, the rest adds between rest_low[k] and rest_high[k]
        rest_low = np.append(low[::-1].cumsum()[::-1], 0)
        rest_high = np.append(high[::-1].cumsum()[::-1], 0)
        places = np.flatnonzero(alive)
        score = np.zeros(len(places), anchor.dtype)
        for first in range(0, size, STRIDE):
            if not len(places):
                break
            stop = min(first + STRIDE, size)
            everyone = len(places) == len(alive)
            for d in order[first:stop]:
                score = score + anchor[d] * (columns[d] if everyone else columns[d][places])
            if stop < size:
                stay = useful(score + rest_low[stop], score + rest_high[stop])
                if not stay.all():
                    places, score = places[stay], score[stay]
        return places, score


def _kth(values: np.ndarray, k: int):
    """The k-th largest value."""
    if values.dtype == object:
        return sorted(values, reverse=True)[k - 1]
    return np.partition(values, len(values) - k)[len(values) - k]


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by score, ties by id."""
    if len(ids) > k:
        near = np.flatnonzero(scores >= _kth(scores, k))
    else:
        near = np.arange(len(ids))
    order = sorted(near.tolist(), key=lambda j: (-scores[j], ids[j]))
    return np.array(order[:k], np.int64)


def best(shelf: Shelf, row: int, label: int, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the first ``k`` other rows of the label."""

    def useful(least, most):
        return most >= _kth(least, k) if len(least) > k else np.ones(len(least), bool)

    places, score = shelf.scan(anchor, (shelf.labels == label) & (shelf.rows != row), useful)
    first = _first(shelf.ids[places], score, k)
    return shelf.ids[places][first], score[first]


def inside(shelf: Shelf, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each window, ids and scores of the first ``k`` rows of other labels with a score in it."""

    def useful(least, most):
        stay = np.zeros(len(least), bool)
        for low, high in windows:
            may = (most >= low) & (least <= high)
            sure = (least >= low) & (most <= high)
            if sure.sum() > k:
                may &= most >= _kth(least[sure], k)
            stay |= may
        return stay

    places, score = shelf.scan(anchor, shelf.labels != label, useful)
    ids = shelf.ids[places]
    for low, high in windows:
        own = np.flatnonzero((score >= low) & (score <= high))
        first = own[_first(ids[own], score[own], k)]
        yield ids[first], score[first]


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list column, shorter ones filled up with zeros."""
    size = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    width = int(size.max(initial=0))
    made = np.zeros((len(size), width))
    made[np.arange(width) < size[:, None]] = flat
    return made


def _visit(rows: DataFrame, anchors: DataFrame, shelves: int, extra: str, schema: str, answer: Callable) -> DataFrame:
    """Every anchor on every shelf. ``answer(shelf, anchor as a dict)`` yields tuples of ``schema``;
    ``extra`` names a column of the anchors that it needs besides."""
    shelf = F.pmod(F.xxhash64("row"), F.lit(shelves))
    kind = anchors.schema[extra].dataType if extra else "int"
    held = rows.select(shelf.alias("shelf"), F.lit(0).alias("kind"), "row", "vec_id", "label", "v", F.lit(None).cast(kind).alias("extra"))
    guests = anchors.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shelves - 1).cast("bigint"))).alias("shelf"), F.lit(1).alias("kind"),
        "row", "vec_id", "label", "v", (F.col(extra) if extra else F.lit(None).cast(kind)).alias("extra"),
    )
    dealt = held.unionByName(guests).repartition(shelves, "shelf").sortWithinPartitions("shelf", "kind")
    fields = [x.split() for x in schema.split(", ")]
    types = [{"bigint": pa.int64(), "int": pa.int32()}[x[1]] for x in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, current = [], None, None
        for batch in batches:
            places = batch["shelf"].to_numpy()
            guest = batch["kind"].to_numpy() == 1
            cuts = np.flatnonzero((places[1:] != places[:-1]) | (guest[1:] != guest[:-1])) + 1
            for first, stop in zip([0, *cuts], [*cuts, len(places)]):
                part = batch.slice(first, stop - first)
                if places[first] != at:
                    held, at, current = [], places[first], None
                if not guest[first]:
                    held.append(part)
                    continue
                if held:
                    whole = pa.concat_batches(held)
                    current = Shelf(*(whole[x].to_numpy(zero_copy_only=False) for x in ("row", "vec_id", "label")), _matrix(whole["v"]))
                    held = []
                if current is None:
                    continue  # a shelf without rows
                names = ["row", "vec_id", "label", "extra"]
                made = []
                for *own, vector in zip(*(part[x].to_pylist() for x in names), _matrix(part["v"])):
                    made += answer(current, {**dict(zip(names, own)), "v": vector})
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], [x[0] for x in fields])

    return dealt.mapInArrow(run, schema)


def mine(
    vectors: DataFrame, anchor: Column, *, label: Column | None = None, scale: int = 256, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for the rows that
    ``anchor`` (a condition on ``vec_id``) chooses and each of their first ``positives`` rows of the
    same label, the first ``negatives`` rows of other labels whose score is from ``low`` to ``high``
    percent of the positive's."""
    rows = prepare(vectors, F.col(label_col) if label is None else label, scale, id_col, vector_col)
    chosen = rows.where(anchor)
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shelves = max(partitions, -(-rows.count() // SHELF))

    def friends(shelf: Shelf, x: dict) -> list[tuple]:
        return [(x["row"], int(i), int(s)) for i, s in zip(*best(shelf, x["row"], x["label"], x["v"], positives))]

    near = _visit(rows, chosen, shelves, "", "row bigint, positive_id bigint, score bigint", friends)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    windows = near.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "score"))).alias("windows"))
    windows = stage(windows, "positives")  # at most ``positives`` entries a row

    def rivals(shelf: Shelf, x: dict) -> list[tuple]:
        bounds = [(-(-low * w["score"] // 100), high * w["score"] // 100) for w in x["extra"]]
        return [
            (x["row"], x["vec_id"], w["place"], w["positive_id"], w["score"], int(i), int(s))
            for w, found in zip(x["extra"], inside(shelf, x["label"], x["v"], bounds, negatives))
            for i, s in zip(*found)
        ]

    schema = "row bigint, anchor_id bigint, place int, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    far = _visit(rows, chosen.join(windows, "row"), shelves, "windows", schema, rivals)
    order = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return far.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
