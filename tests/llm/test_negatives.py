"""Hard negatives against a plain version."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadlens.llm import hard_negatives, queries, sql
from tests.compare import connect, differences

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, v string, shelf string, score string"


def plain(rows, positives=5, negatives=10):
    part = []
    for vec_id, v, label in rows:
        if vec_id is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        part.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for a in part:
        if a[0] % 10:
            continue
        scored = [(-sum(x * y for x, y in zip(a[1], b[1])), b[0], b[2]) for b in part if b is not a]
        for score, positive, _ in sorted(x for x in scored if x[2] == a[2])[:positives]:
            near = sorted(x[:2] for x in scored if x[2] != a[2] and -30 * score <= -100 * x[0] <= -90 * score)
            out += [(a[0], positive, k + 1, i, -score, -s) for k, (s, i) in enumerate(near[:negatives])]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*x, "a", "b", "c", "d") for x in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 10 == 0, **options).collect())


@pytest.fixture(scope="module")
def rows():
    choose = random.Random(7)
    centre = {k: [choose.gauss(0, 0.2) for _ in range(20)] for k in range(3)}
    made = [(k, [x + choose.gauss(0, 0.1) for x in centre[k % 3]], choose.choice([k % 3, 5])) for k in range(300)]
    made += [(k, made[k - 300][1], 1) for k in range(300, 340)]  # equal vectors: ties
    made += [(10, made[3][1], 0), (10, made[3][1], 0), (20, made[4][1], 2)]  # repeated ids and rows
    return made


def test_against_plain_version(spark, rows):
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, rows, positives=2, negatives=3) == plain(rows, 2, 3)


def test_odd_rows(spark, rows):
    odd = [
        (None, [0.1] * 20, 1), (400, None, 1), (410, [0.1] * 20, None), (420, [0.1, None], 1), (430, [float("nan")] * 20, 1),
        (440, [float("inf")] * 20, 1), (450, [], 1), (460, [0.3, -0.2], 1), (470, [0.1] * 25, 1), (480, [0.0] * 20, 9),
    ]
    assert mined(spark, rows + odd) == plain(rows + odd)


def test_scores_beyond_exact_floats(spark):
    choose = random.Random(8)
    rows = [(k, [choose.choice([1, 3]) * 10**4.0 + choose.random() for _ in range(4)], k % 2) for k in range(60)]
    big = [(k, [x * 10 for x in v], label) for k, v, label in rows]
    assert mined(spark, rows) == plain(rows) and mined(spark, big) == plain(big)


def test_nothing_to_mine(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == [] and mined(spark, [(0, [1.0], 1), (1, [1.0], 1)]) == []


def test_bounds_only_drop_what_cannot_be_found():
    choose = np.random.default_rng(9)
    vectors = np.floor(choose.normal(0, 40, (500, 64)) * (1.0 / np.arange(1, 65)))
    labels, ids = choose.integers(0, 3, 500), np.arange(500)
    shelf = hard_negatives.Shelf(ids, ids, labels, vectors)
    looked = []
    for a in range(40):
        score = vectors @ vectors[a]
        own = sorted((-score[k], k) for k in ids if labels[k] == labels[a] and k != a)[:5]
        found, scores = hard_negatives.best(shelf, a, labels[a], vectors[a], 5)
        assert list(zip(-scores, found)) == own
        alive = (labels == labels[a]) & (ids != a)
        places, _ = shelf.scan(vectors[a], alive, lambda least, most: most >= hard_negatives._kth(least, 5))
        looked.append(len(places) / alive.sum())
    assert np.mean(looked) < 0.5  # the rest left the bitmap early


def test_query(spark, sf_dir):
    df = queries.op13_hard_negatives(spark, sf_dir)
    assert differences(df, connect(sf_dir), sql.ORACLES["op13_hard_negatives"]) == []
