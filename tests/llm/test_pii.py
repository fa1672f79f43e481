from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadlens.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, x in enumerate(reversed(digits)):
        n = int(x) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(x) <= 255 for x in hit.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def spans_of(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def check(docs):
    want = sorted(",".join(spans_of(r["text"])) for r in docs.collect())
    out = pii.report(pii.find(docs)).collect()
    base = [",".join(x for x in r["spans"].split(",") if not x.startswith("term")) for r in out]
    assert sorted(base) == want
    assert all(r["base_sha256"] == hashlib.sha256(b.encode()).hexdigest() for r, b in zip(out, base))
    for kind in PATTERNS:
        assert sum(r[f"n_{kind}"] for r in out) == sum(x.count(f"{kind}:") for x in want)


def test_whole_table_against_the_patterns(documents):
    check(documents)


def test_odd_rows_and_none(odd, nothing):
    check(odd)
    assert pii.find(nothing).count() == 0


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet="a1.@-+ ()%é25", max_size=60), min_size=200, max_size=200))
def test_random_texts_against_the_patterns(make, texts):
    check(make([*texts, "a@b.co_x@d.com 1.2.3.4.5.6.7.8 300.1.1.1 +1 (22) 333-4444 4111 1111 1111 1111", "0" * 18 + ".1.2.3"]))


def test_terms_that_give_an_entity_away(make):
    """A name that stands only near one address in two different contexts is disclosing; common words
    and words of a single context are not."""
    filler = [f"common words fill this line number{k} here" for k in range(60)]
    texts = [*filler, "common Zanzibarova writes jo@ex.org this", "this is common: jo@ex.org zanzibarova here"]
    copies = ["unique Oncebefore kim@ex.org line"] * 4  # one context, however often it is copied
    out = {r["doc_id"]: r for r in pii.find(make([*texts, *copies])).collect()}
    named = {(r["doc_id"], s["start"], s["end"]) for r in out.values() for s in r["spans"] if s["kind"] == "term"}
    assert named == {(60, 7, 18), (61, 26, 37)}
    masked = {r["doc_id"]: r["text"] for r in pii.sanitise(make([*texts, *copies]), pii.find(make([*texts, *copies]))).collect()}
    assert masked[60] == "common [TERM] writes [EMAIL] this"
    assert masked[62] == "unique Oncebefore [EMAIL] line"
    assert masked[0] == filler[0]


def test_context_goes_on_behind_other_matches(make):
    """Numbers that are no card, and other addresses, do not end the context of an entity."""
    filler = [f"common words fill this line number{k} here" for k in range(60)]
    card = "4111 1111 1111 1111"
    texts = [*filler, f"Zanzibarova, born 1970, card {card}", f"card {card}, of 2001: zanzibarova here"]
    texts += ["Quillfeather: a1@ex.org, jo@ex.org common", "this jo@ex.org, b2@ex.org and quillfeather words"]
    terms = {(r["doc_id"], s["start"], s["end"]) for r in pii.find(make(texts)).collect() for s in r["spans"] if s["kind"] == "term"}
    assert {(60, 0, 11), (61, texts[61].index("zanz"), texts[61].index("zanz") + 11)} <= terms
    assert {(62, 0, 12), (63, texts[63].index("quill"), texts[63].index("quill") + 12)} <= terms


def test_sanitise_rows_without_ids_and_with_shared_ones(make):
    docs = make([(None, "to ab@ex.org"), (1, "plain text here"), (1, "cd@ex.org is it"), (2, None), (2, None), (None, "to ab@ex.org")])
    docs = docs.withColumn("__id", F.lit(3)).withColumn("__out", F.lit("x"))
    out = pii.sanitise(docs)
    assert out.dtypes == docs.dtypes
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in out.collect())
    assert got == sorted([("None", "to [EMAIL]")] * 2 + [("1", "plain text here"), ("1", "[EMAIL] is it"), ("2", "None"), ("2", "None")])
    with pytest.raises(ValueError):
        pii.sanitise(docs, pii.find(docs))
