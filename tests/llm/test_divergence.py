"""Divergence of sources against a plain version."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from loadlens.llm import divergence, queries, sql
from tests.compare import connect, differences

SCHEMA = "doc_id bigint, text string, lang string, source string, digest string, term string, n string, place string"


def plain(docs, least, top):
    rows = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in docs]
    seen = Counter((lang, t) for lang, _, terms in rows for t in set(terms))
    kept = defaultdict(list)
    for (lang, t), n in seen.items():
        if n >= least:
            kept[lang].append(t)
    counts, langs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in rows:
        mine = [t for t in terms if seen[lang, t] >= least]
        counts[lang, source].update(mine)
        langs[lang].update(mine)

    def shares(n, lang):
        total = sum(n.values()) + 5 * len(kept[lang])
        return {t: 1 + 10**9 * (n[t] + 5) // total for t in kept[lang]}

    of_group = {key: shares(n, key[0]) for key, n in counts.items()}
    of_lang = {lang: shares(n, lang) for lang, n in langs.items()}
    out = set()
    for (lang, source), n in counts.items():
        p, q = of_group[lang, source], of_lang[lang]
        others = [(x, of_group[k, x]) for k, x in counts if k == lang and x != source]
        parts = {
            "pair": [(x, int(np.abs(np.array(list(p.values()), int) - np.array(list(o.values()), int)).sum())) for x, o in others],
            "term": [(t, p[t] - q[t]) for t in p if n[t] and p[t] > q[t]],
        }
        for part, items in parts.items():
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out |= {(lang, source, part, x, v, k + 1) for k, (x, v) in enumerate(items) if part == "pair" or k < top}
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def docs():
    choose = random.Random(5)
    words = [f"w{chr(97 + k)}" for k in range(26)] + ["É", "é", "ß", "中文", "Wa", "x-y", "9z", "\x00q", "\U0001f642"]
    rows = []
    for k in range(400):
        text = " ".join(choose.choices(words[: 5 + k % 30], k=choose.randint(0, 40)))
        rows.append((text, choose.choice(["en", "en", "de", None, ""]), choose.choice(["s0", "s0", "s1", "s2", None, "é"])))
    rows += [(None, "en", "s3"), ("", "xx", "only"), ("wa wa " * 3000, "xx", "other"), ("wa", "yy", "one"), *rows[:5]]
    return rows


@pytest.fixture(scope="module")
def frame(spark, docs):
    return spark.createDataFrame([(k // 2, *x, "a", "b", "c", "d") for k, x in enumerate(docs)], SCHEMA).repartition(3)


@pytest.mark.parametrize("bits", [64, 3])  # digests of 3 bits are shared by several terms each
def test_against_plain_version(frame, docs, bits):
    assert rows_of(divergence.audit(frame, least=20, top=7, bits=bits)) == plain(docs, 20, 7)


def test_texts_are_read_twice_where_no_digest_is_shared(frame, docs, monkeypatch):
    read = []
    monkeypatch.setattr(divergence, "occurrences", lambda *a, f=divergence.occurrences, **b: read.append(a[1:3]) or f(*a, **b))
    lower = frame.where("lang = 'en'")
    assert rows_of(divergence.audit(lower)) == plain([x for x in docs if x[1] == "en"], 30, 50)
    assert len(read) == 2


def test_without_kept_terms(frame, docs):
    rows = rows_of(divergence.audit(frame, least=10_000, top=7))
    assert rows == plain(docs, 10_000, 7) and {r[4] for r in rows} == {0}


def test_more_sources_than_a_tile_and_more_terms_than_a_block(spark):
    choose = random.Random(6)
    words = ["".join(choose.choices("abcdefgh", k=7)) for _ in range(900)]
    rows = [(" ".join(choose.choices(words, k=30)), "en", f"s{choose.randint(0, 150)}") for _ in range(1500)]
    made = spark.createDataFrame([(0, *x, "a", "b", "c", "d") for x in rows], SCHEMA)
    assert rows_of(divergence.audit(made, least=2, top=3)) == plain(rows, 2, 3)


def test_shares_beyond_64_bits(spark):
    n, total = 3 * 10**15, 10**17 + 7
    df = spark.createDataFrame([(n, total)], "n bigint, total bigint").select(divergence._share("n", "total"))
    assert df.first()[0] == 1 + 10**9 * (n + 5) // total


def test_empty_table(frame):
    assert divergence.audit(frame.limit(0)).count() == 0


def test_query(spark, sf_dir):
    assert differences(queries.op12_divergence(spark, sf_dir), connect(sf_dir), sql.ORACLES["op12_divergence"]) == []
