from __future__ import annotations

import random

import numpy as np

from loadlens.llm import components as C
from loadlens.llm import near_dedup as N
from loadlens.llm import sketch
from loadlens.llm.repeats import mix


def shingles(text, words):
    own = (text or "").encode().lower().split()
    if len(own) < words:
        return {tuple(own)} if own else set()
    return {tuple(own[k : k + words]) for k in range(len(own) - words + 1)}


def brute(pairs, words, percent):
    sets = {i: shingles(t, words) for i, t in pairs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                same = len(sets[a] & sets[b])
                if 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_chains_groups_and_borders_against_brute_force(make):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(5))
    texts = []
    for _ in range(6):
        words = [word() for _ in range(60)]
        for _ in range(25):  # a chain of edits, whose ends are no longer alike
            words[rng.randrange(60)] = word()
            texts.append(" ".join(words))
    texts += [x.upper() for x in texts[:5]] + texts[:4] + [" ".join(word() for _ in range(30)) for _ in range(30)]
    rng.shuffle(texts)
    pairs = list(enumerate(texts))
    for words, percent in ((4, 80), (5, 80), (3, 60)):
        assert got(N.near_dedup(make(pairs), words, percent)) == brute(pairs, words, percent)


def test_whole_table_against_brute_force(documents):
    pairs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert got(N.near_dedup(documents, 4, 80)) == brute(pairs, 4, 80)


def test_a_group_with_a_common_passage_and_no_links(make):
    """Many documents share half their text: candidates everywhere, no pair alike."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(6))
    passage = " ".join(word() for _ in range(40))
    pairs = list(enumerate([passage + " " + " ".join(word() for _ in range(30)) for _ in range(150)]))
    assert got(N.near_dedup(make(pairs), 4, 80)) == brute(pairs, 4, 80)


def test_odd_rows_and_none(odd, nothing):
    rows = {r["doc_id"]: r for r in N.near_dedup(odd, 4).where("doc_id IS NOT NULL").collect()}
    assert rows[0]["n_shingles"] == 0 and rows[0]["component_id"] == 0 and rows[0]["kept"]
    assert rows[4]["n_shingles"] == 1 and rows[5]["component_id"] == 4
    kept = N.keep_one(odd, 4)
    assert kept.columns == odd.columns
    assert kept.where("text = 'alone here'").count() == 1 and kept.where("text = 'a' AND doc_id IS NOT NULL").count() == 1
    assert N.near_dedup(nothing).count() == 0


def test_sketch_estimates_similarity_and_fills_every_coordinate():
    rng = np.random.default_rng(4)
    for same, size in ((0.8, 400), (0.3, 400), (0.5, 3)):
        shared = int(2 * size * same / (1 + same))
        pool = mix(rng.integers(0, 2**63, 4 * size + 4, dtype=np.uint64))
        a, b = np.unique(pool[:size]), np.unique(np.concatenate([pool[:shared], pool[size : 2 * size - shared]]))
        owners = np.repeat([0, 1], [len(a), len(b)])
        out = sketch.sketches(np.concatenate([a, b]), owners, 3, 512)
        assert (out[:2] != np.uint64(2**64 - 1)).all() and (out[2] == np.uint64(2**64 - 1)).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((out[0] == out[1]).mean() - true) < (0.12 if size > 10 else 0.45)


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(110)]
    edges += [(k, k + 1) for k in range(1000, 1040)] + [(5000 + k, 5000) for k in range(60)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    out = {r["node"]: r["component"] for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {x: find(x) for x in list(root)}
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0
