from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loadlens.llm import repeats, substring_dedup, suffix_dedup
from loadlens.llm.suffix_array import common_prefixes, suffix_array


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(text):
    order = suffix_array(text)
    assert order == sorted(range(len(text)), key=lambda i: text[i:])
    common = common_prefixes(text, order)
    for k in range(1, len(order)):
        a, b = text[order[k - 1] :], text[order[k] :]
        assert common[k] == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_suffix_array_of_a_long_run():
    assert suffix_array([1] * 20_000) == list(range(19_999, -1, -1))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=9), min_size=1, max_size=5), st.data())
def test_matching_statistics(strings, data):
    docs = [data.draw(st.integers(1, 4)) for _ in strings]
    automaton = substring_dedup.Automaton(strings, docs)
    for symbols, doc in zip(strings, docs):
        earlier = [s for s, d in zip(strings, docs) if d < doc]
        for end, got in enumerate(automaton.statistics(symbols, doc), 1):
            want = max(
                (n for n in range(end + 1) if any(symbols[end - n : end] == s[k : k + n] for s in earlier for k in range(len(s) - n + 1))),
                default=0,
            )
            assert got == want


def bytes_removed(texts, length):
    count = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        covered = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                covered[i : i + length] = True
        out.append(covered)
    return out


def words_removed(docs, length):
    first = {}
    for doc, words in sorted(docs, key=lambda x: x[0]):
        for i in range(len(words) - length + 1):
            first.setdefault(tuple(words[i : i + length]), doc)
    out = {}
    for doc, words in docs:
        covered = np.zeros(len(words), bool)
        for i in range(len(words) - length + 1):
            if first[tuple(words[i : i + length])] < doc:
                covered[i : i + length] = True
        out[doc] = covered
    return out


def rows_without_words(docs, length):
    """What ``words_removed`` tells, for rows whose ids may repeat."""
    first = {}
    for doc, words in docs:
        for i in range(len(words) - length + 1):
            window = tuple(words[i : i + length])
            first[window] = min(doc, first.get(window, doc))
    out = []
    for doc, words in docs:
        covered = np.zeros(len(words), bool)
        for i in range(len(words) - length + 1):
            if first[tuple(words[i : i + length])] < doc:
                covered[i : i + length] = True
        out.append(covered)
    return out


def mixed(seed, documents=60):
    """Texts with shared passages, edits, runs and copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rng.randint(20, 60))) for _ in range(4)]
    texts = []
    for _ in range(documents):
        kind = rng.random()
        if texts and kind < 0.15:
            texts.append(rng.choice(texts))
        elif texts and kind < 0.35:
            words = rng.choice(texts).split(" ")
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = word()
            texts.append(" ".join(words))
        elif kind < 0.45:
            texts.append((word() + " ") * rng.randint(1, 80))
        else:
            parts = [" ".join(word() for _ in range(rng.randint(0, 40)))]
            for _ in range(rng.randint(0, 3)):
                parts += [rng.choice(passages)[rng.randint(0, 9) :], " ".join(word() for _ in range(rng.randint(0, 12)))]
            texts.append(" ".join(parts))
    return texts


def one_passage(seed, documents=90):
    """Texts that hold parts of one passage among words of their own, some of them twice."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    passage = [word() for _ in range(50)]
    out = []
    for _ in range(documents):
        words = [word() for _ in range(rng.randint(0, 8))]
        for _ in range(rng.choice((1, 1, 2))):
            words += passage[rng.randint(0, 12) : rng.randint(35, 50)] + [word() for _ in range(rng.randint(0, 8))]
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("seed, length", [(1, 40), (2, 64), (3, 100)])
def test_bytes_against_brute_force(make, seed, length):
    texts = mixed(seed)
    out = {r["doc_id"]: r for r in suffix_dedup.remove(make(texts), length).collect()}
    for k, (text, covered) in enumerate(zip(texts, bytes_removed([t.encode() for t in texts], length))):
        raw = text.encode()
        assert bytes(out[k]["kept"]) == bytes(b for b, c in zip(raw, covered) if not c), k
        edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(int), [0]])))
        assert out[k]["spans"] == edges.tolist() and out[k]["n_bytes"] == len(raw)


@pytest.mark.parametrize("seed, length", [(4, 8), (5, 12), (6, 20)])
def test_words_against_brute_force(make, seed, length):
    texts = mixed(seed)
    docs = [(k, t.encode().split()) for k, t in enumerate(texts)]
    want = words_removed(docs, length)
    out = {r["doc_id"]: r for r in substring_dedup.remove(make(texts), length).collect()}
    for doc, words in docs:
        assert bytes(out[doc]["kept"]) == b" ".join(w for w, c in zip(words, want[doc]) if not c), doc


@pytest.mark.parametrize("op", [suffix_dedup, substring_dedup])
def test_registered_lengths_on_the_whole_table(documents, op):
    rows = documents.collect()
    report = {r["doc_id"]: r for r in op.report(op.remove(documents)).collect()}
    if op is suffix_dedup:
        texts = [(r["text"] or "").encode() for r in rows]
        want = bytes_removed(texts, 400)
        for r, text, covered in zip(rows, texts, want):
            assert report[r["doc_id"]]["n_removed"] == covered.sum()
            kept = np.frombuffer(text, np.uint8)[~covered].tobytes()
            assert report[r["doc_id"]]["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    else:
        docs = [(r["doc_id"], (r["text"] or "").encode().split()) for r in rows]
        want = words_removed(docs, 50)
        for doc, words in docs:
            assert report[doc]["n_words"] == len(words) and report[doc]["n_removed"] == want[doc].sum()


@pytest.mark.parametrize("op, length", [(suffix_dedup, 400), (substring_dedup, 50)])
def test_odd_rows_and_none(odd, nothing, op, length):
    out = op.remove(odd, length)
    assert out.count() == odd.count()
    assert op.remove(nothing, length).count() == 0
    kept = {r["doc_id"]: bytes(r["kept"]) for r in out.collect()}
    assert kept[0] == b"" and kept[4] == b"a"
    if op is suffix_dedup:
        assert kept[10] == b"" and kept[11] == b""  # runs repeat themselves everywhere
    else:
        assert kept[11].count(b" ") == 11_999  # the first document keeps what it repeats itself


def test_a_text_stays_somewhere_when_ids_clash(make):
    rng = random.Random(3)
    v, w = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(120)) for _ in range(2))
    rows = substring_dedup.remove(make([(1, w), (5, v), (5, w), (7, v)]), 50).collect()
    assert sorted((r["doc_id"], bytes(r["kept"]).decode()) for r in rows) == [(1, w), (5, ""), (5, v), (7, "")]


@pytest.mark.parametrize("most", [5_000, 3])
@pytest.mark.parametrize("op, length", [(suffix_dedup, 64), (substring_dedup, 12)])
@pytest.mark.parametrize("texts", [one_passage(9), mixed(10)], ids=["passage", "mixed"])
def test_ids_of_several_texts_and_repeated_rows(make, monkeypatch, op, length, texts, most):
    monkeypatch.setattr(repeats, "AT_MOST", most)
    pairs = [(k // 3 if k % 2 else k, t) for k, t in enumerate(texts)]
    pairs += pairs[:5] + [pairs[7]] * 40
    if op is suffix_dedup:
        raw = [t.encode() for _, t in pairs]
        kept = [bytes(b for b, c in zip(text, x) if not c) for text, x in zip(raw, bytes_removed(raw, length))]
    else:
        docs = [(k, t.encode().split()) for k, t in pairs]
        kept = [b" ".join(w for w, c in zip(words, x) if not c) for (_, words), x in zip(docs, rows_without_words(docs, length))]
    want = sorted((k, x) for (k, _), x in zip(pairs, kept))
    assert sorted((r["doc_id"], bytes(r["kept"])) for r in op.remove(make(pairs), length).collect()) == want


def test_places_in_parts():
    grams = np.random.default_rng(2).integers(0, 50, 1_000, dtype=np.uint64) << np.uint64(28)
    for width in (1, 7, 64):
        whole = repeats._window_places(grams, width)
        for at_once in (1, 10, 333, 1_000):
            assert (repeats._window_places(grams, width, at_once) == whole).all()


def test_windows_beyond_16_bits(make):
    rng = random.Random(4)
    shared = "".join(rng.choice("abcdefgh") for _ in range(70_000))
    texts = [shared + "x" * 5, "yy" + shared[:69_000] + "z", "q" + shared[:60_000]]
    out = {r["doc_id"]: r["spans"] for r in suffix_dedup.remove(make(texts), 66_000).collect()}
    assert out == {0: [0, 69_000], 1: [2, 69_002], 2: []}


def test_segments_cover_every_window_once():
    rng = np.random.default_rng(1)
    lengths = np.array([0, 5, 30, 7, 200], np.int64)
    values = rng.integers(0, 3, int(lengths.sum()), dtype=np.uint64)
    doc, at, left, right, _, _ = repeats.runs(repeats.mix(values), values, lengths, 7, 1)
    windows = sorted((d, a - b + k) for d, a, b, c in zip(doc, at, left, right) for k in range(b + c - 6))
    assert windows == [(d, k) for d, n in enumerate(lengths) for k in range(n - 6)]


@pytest.mark.parametrize("op, length", [(suffix_dedup, 64), (substring_dedup, 12)])
@pytest.mark.parametrize("texts", [one_passage(7), mixed(8)], ids=["passage", "mixed"])
def test_anchors_with_many_contexts_do_not_meet_in_a_task(make, monkeypatch, op, length, texts):
    seen, resolve = [], repeats.resolve

    def watched(parts, *rest):
        seen.append(max((r["count"] for r in parts.groupBy("anchor").count().collect()), default=0))
        return resolve(parts, *rest)

    monkeypatch.setattr(repeats, "AT_MOST", 3, raising=False)
    monkeypatch.setattr(repeats, "resolve", watched)
    out = {r["doc_id"]: bytes(r["kept"]) for r in op.remove(make(texts), length).collect()}
    assert seen and max(seen) <= 3
    if op is suffix_dedup:
        raw = [t.encode() for t in texts]
        want = {k: bytes(b for b, c in zip(raw[k], x) if not c) for k, x in enumerate(bytes_removed(raw, length))}
    else:
        docs = [(k, t.encode().split()) for k, t in enumerate(texts)]
        covered = words_removed(docs, length)
        want = {k: b" ".join(w for w, c in zip(words, covered[k]) if not c) for k, words in docs}
    assert out == want


def test_an_index_takes_few_anchors_at_once(monkeypatch):
    rng, window, anchors, m, most = random.Random(5), 24, 9, 14, 20
    word = lambda n: bytes(rng.randrange(97, 123) for _ in range(n))
    group, left, right, seen = [], [], [], []
    for anchor in range(anchors):  # excerpts of one passage, each with ends of its own
        before, after = word(window), word(window)
        for _ in range(m):
            a, b = rng.randint(6, window), rng.randint(6, window)
            group.append(anchor)
            left.append(before[:a] + word(window - a))
            right.append(after[:b] + word(window - b))

    def index(strings):
        seen.append(len(strings.symbols))
        return suffix_dedup.by_suffix_array(strings)

    monkeypatch.setattr(repeats, "INDEXED", most, raising=False)
    n = len(group)
    found = repeats.match(np.array(group), left, right, np.arange(n), np.ones(n, np.int64), window, 1, False, index)
    assert len(seen) > 1 and max(seen) < most + m
    windows = {}
    for k in range(n):
        text = left[k][::-1] + right[k]
        for at in range(window + 1):
            windows.setdefault((group[k], at, text[at : at + window]), []).append(k)
    want = [set() for _ in range(n)]
    for (_, at, _), those in windows.items():
        for k in those if len(those) > 1 else ():
            want[k].update(range(at - window, at))
    assert [{x for a, b in some for x in range(a, b)} for some in found] == want and sum(map(bool, want)) > n // 2
