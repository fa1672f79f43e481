"""Prefix counts against the library, prefix by prefix."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadlens.llm import queries, token_counts, tokens
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")
END = "<|endoftext|>"


@pytest.fixture(scope="module")
def vocabulary():
    return tokens.read_vocabulary(PATH)


@pytest.fixture(scope="module")
def length():
    library = Tokenizer.from_file(PATH)
    return lambda text: len(library.encode(text, add_special_tokens=False).ids)


def test_every_prefix(vocabulary, length):
    parts = ["a", "b", " ", "  ", "\n", "'", "'l", "ll", "e", "1", "!", "é", "中", "the", " and", END, "<|", "|>", "\t", "　", "🙂", "'re", "v"]
    choose = random.Random(3)
    texts = ["".join(choose.choices(parts, k=choose.randint(1, 40))) for _ in range(400)]
    texts += ["", END, END + END, f"a  {END}  b!{END}", f"!<|end{END}oftext|>", "they'll we've  're 'lx ''ll", "\n\nword  x\n\n y", "aaaa" * 40]
    for text, counts in zip(texts, token_counts.Counter(vocabulary).counts(texts)):
        assert counts.tolist() == [length(text[:k]) for k in range(1, len(text) + 1)], text


def test_questions_of_stored_counts(spark, make, vocabulary, length):
    texts = [*ODD, f"one {END} two", "x  \n y"]
    stored = token_counts.prefix_counts(make([*enumerate(texts), (3, ODD[3]), (None, "alone")]), vocabulary).cache()
    rows = {r["doc_id"]: r for r in token_counts.fit(stored, 5).collect()}
    assert stored.count() == len(texts) + 2 and rows[None]["n_tokens"] == length("alone")
    for k, text in enumerate(x or "" for x in texts):
        row = rows[k]
        assert (row["n_bytes"], row["n_chars"], row["n_tokens"]) == (len(text.encode()), len(text), length(text))
        assert row["over_limit"] == (length(text) > 5)
        fits = [p for p in range(min(len(text), 400) + 1) if length(text[:p]) <= 5]
        if len(text) <= 400:
            assert (row["fit_chars"], row["fit_tokens"]) == (fits[-1], length(text[: fits[-1]]))
    asked = [(k, p) for k in (0, 1, 7, 8, len(texts) - 2, len(texts) - 1) for p in (-3, 0, 1, 4, 9, 10_000)] + [(None, 1), (999, 1), (8, None)]
    found = token_counts.spans(stored, spark.createDataFrame(asked, "doc_id bigint, chars int")).collect()
    assert len(found) == len(asked) - 2
    for r in found:
        text = texts[r["doc_id"]] or ""
        assert r["prefix_tokens"] == length(text[: max(r["chars"] or 0, 0)])


def test_wide_steps_and_empty_table(spark, nothing, vocabulary):
    assert token_counts.fit(token_counts.prefix_counts(nothing, vocabulary), 3).count() == 0
    schema = token_counts.STORED
    row = (1, 600, 2, 300, 4, b"\x2c\x01\x00\x00\x00\x00\x00\x00")
    assert token_counts.fit(spark.createDataFrame([row], schema), 299).first()["fit_chars"] == 0


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        token_counts.Counter(tokens.read_vocabulary(public_tokenizers.path("word_bpe_49k.json")))


def test_query(spark, sf_dir, documents, length):
    rows = {r["doc_id"]: r for r in queries.op11_token_counts(spark, sf_dir).collect()}
    texts = [(r["doc_id"], r["text"] or "") for r in documents.select("doc_id", "text").collect()]
    assert len(rows) == len(texts)
    for k, text in texts:
        assert (rows[k]["n_bytes"], rows[k]["n_tokens"], rows[k]["over_limit"]) == (len(text.encode()), length(text), length(text) > 1024)
        fit = rows[k]["fit_chars"]
        assert length(text[:fit]) == rows[k]["fit_tokens"] <= 1024
        assert fit == len(text) or length(text[: fit + 1]) > 1024
