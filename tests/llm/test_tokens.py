from __future__ import annotations

import base64
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loadlens.llm import bpe, packing, pretoken, simple8b, staging, token_files, tokens
from loadlens.llm.staging import stage
from tests.llm.conftest import ODD

VOCABULARY = tokens.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = Tokenizer.from_str(VOCABULARY)
LIBRARY.encode_special_tokens = True
TEXTS = [x for x in ODD if x is not None]


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def cut(texts):
    out = []
    for _, _, pieces, bounds in pretoken.slices(texts):
        first = 0
        for stop in bounds:
            out.append([x.decode() for x in pieces[first:stop]])
            first = stop + 1
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aseldmtrvLX'’ \n\t 　19é!.,-中ö", max_size=40), max_size=6))
def test_pieces_are_those_of_the_pattern(texts):
    assert cut(texts) == [regex.findall(public_tokenizers.PATTERN, x) for x in texts]


def test_lanes_and_runs_of_texts_do_not_show(documents):
    texts = [r["text"] or "" for r in documents.limit(60).collect()] + ["ab " * 5_000, "x" * 700_000, ""]
    assert cut(texts) == [regex.findall(public_tokenizers.PATTERN, x) for x in texts]


def test_ids_are_those_of_the_library(odd, documents):
    for docs in (odd, documents):
        got = {r["doc_id"]: ids_of(r["ids"]) for r in tokens.encode(docs, VOCABULARY).collect() if r["doc_id"] is not None}
        assert got == {r["doc_id"]: library(r["text"]) for r in docs.collect() if r["doc_id"] is not None}
    other = tokens.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    assert list(tokens.Encoder(other).encode(["Two words"]))[0] == np.array(
        Tokenizer.from_str(other).encode("Two words", add_special_tokens=False).ids, "<u4"
    ).tobytes()


def test_bpe_is_that_of_the_ranks_and_decodes(documents, odd, nothing):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for docs in (documents, odd):
        out = bpe.decode(bpe.encode(docs, RANKS), RANKS).collect()
        texts = sorted((r["text"] or "" for r in docs.collect()))
        assert sorted(bytes(r["decoded"]).decode() for r in out) == texts
        assert sorted(r["ids_text"] for r in out) == sorted(",".join(map(str, reference.encode_ordinary(x))) for x in texts)
    assert bpe.encode(nothing, RANKS).count() == 0
    rng = random.Random(3)
    for piece in ["a" * 5_000, *("".join(rng.choice("aathein") for _ in range(rng.randint(60, 200))) for _ in range(30))]:
        assert list(bpe.merge(piece.encode(), ranks)) == reference.encode_ordinary(piece)


def test_offsets_cut_ids_and_bytes_alike(documents):
    for r in bpe.encode(documents.limit(20), RANKS, offsets=True).collect():
        own, ids = bpe.coder(RANKS), ids_of(r["ids"])
        ends = [*r["piece_ids"][1:], len(ids)]
        sizes = [len(own.decode(ids[a:b])) for a, b in zip(r["piece_ids"], ends)]
        assert list(np.cumsum([0, *sizes])[:-1]) == r["piece_bytes"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=3_000))
def test_simple8b_round_trip(values):
    values = np.array(values, np.uint64)
    words, offsets, escapes = simple8b.encode(values)
    assert (simple8b.decode(words, escapes) == values).all()
    for block in range(len(offsets)):
        part = values[block * simple8b.BLOCK : (block + 1) * simple8b.BLOCK]
        assert (simple8b.decode_block(words, offsets, escapes, block) == part).all()


def test_simple8b_packs_runs():
    words, _, _ = simple8b.encode(np.zeros(960, np.uint64))
    assert len(words) == 4


@pytest.mark.parametrize("shards", [1, 7])
def test_token_files_read_back_in_order(spark, documents, odd, nothing, shards):
    for docs in (documents, odd, nothing):
        path = staging.new_folder(spark, "files")
        token_files.write(docs, path, VOCABULARY, end_id=2, shards=shards)
        got = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
        want = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"]))
        assert [r["doc_id"] for r in got] == [r["doc_id"] for r in want]
        assert sorted(ids_of(r["ids"]) for r in got) == sorted([*library(r["text"]), 2] for r in want)
        assert [r["start"] for r in got] == list(np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1])
        sums = {r["start"]: r["ids_crc32"] for r in token_files.crc32(token_files.read(spark, path)).collect()}
        assert sums == {r["start"]: zlib.crc32(bytes(r["ids"])) for r in got}


def test_token_files_are_read_without_a_shuffle_of_their_ids(spark, documents):
    path = staging.new_folder(spark, "files")
    token_files.write(documents, path, VOCABULARY, end_id=2, shards=3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = token_files.read(spark, path)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_few_documents_are_few_files_whatever_the_shuffle_partitions(spark, make):
    texts = [f"text {k}" for k in range(400)]
    path = staging.new_folder(spark, "files")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        token_files.write(make(texts), path, VOCABULARY, end_id=2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(list(Path(path).glob("part-*.parquet"))) <= 4
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
    assert [(r["doc_id"], ids_of(r["ids"])) for r in got] == [(k, [*library(x), 2]) for k, x in enumerate(texts)]
    assert [r["start"] for r in got] == list(np.cumsum([0, *(r["n_tokens"] for r in got)])[:-1])


def test_a_piece_is_looked_up_once_a_run():
    own, asked = tokens.Encoder(VOCABULARY), []

    class Counted(type(own.pieces)):
        def __getitem__(self, piece):
            asked.append(piece)
            return super().__getitem__(piece)

    own.pieces = Counted(own.tokenizer.model)
    texts = ["one two two é two", "", " two" * 500, "one"]
    assert [ids_of(x) for x in own.encode(texts)] == [library(x) for x in texts]
    assert len(asked) == len(set(asked))


def test_cut_lets_only_the_first_piece_be_short():
    assert packing.cut(5, 4) == [(0, 1), (1, 4)]
    assert packing.cut(8, 4) == [(0, 4), (4, 4)]
    assert packing.cut(3, 4) == [(0, 3)]


def least_bins(lengths, room):
    """Fewest bins by trying all partitions."""
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    best = len(lengths)
    for mask in range(1 << len(rest)):
        inside = [x for k, x in enumerate(rest) if mask >> k & 1]
        if first + sum(inside) <= room:
            best = min(best, 1 + least_bins([x for k, x in enumerate(rest) if not mask >> k & 1], room))
    return best


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=7))
def test_bins_are_near_the_fewest(lengths):
    found = packing.combinations({x: lengths.count(x) for x in lengths}, 12)
    used = sum(times for times, _ in found)
    assert sum(t * n * x for t, b in found for x, n in b.items()) == sum(lengths)
    assert all(sum(n * x for x, n in b.items()) <= 12 for _, b in found)
    assert used <= least_bins(sorted(lengths), 12) + 1


def test_fullest_is_the_best_subset_sum():
    rng = random.Random(5)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(5)}
        room = rng.randint(1, 60)
        chosen = packing.fullest(sorted(counts, reverse=True), counts, room)
        reach = {0}
        for x, n in counts.items():
            reach = {a + k * x for a in reach for k in range(n + 1)}
        assert sum(n * x for x, n in chosen.items()) == max(a for a in reach if a <= room)
        assert all(n <= counts[x] for x, n in chosen.items())


@pytest.mark.parametrize("capacity", [64, 2048])
def test_sequences_hold_every_id_once(documents, odd, nothing, capacity):
    for docs in (documents, odd):
        packed = stage(packing.pack_documents(docs, VOCABULARY, capacity), "packed")
        out = packed.collect()
        by = {}
        for r in out:
            by.setdefault(r["sequence_id"], []).append(r)
        total = 0
        for parts in by.values():
            at = 0
            for r in sorted(parts, key=lambda r: r["offset"]):
                assert r["offset"] == at and len(r["ids"]) == 4 * r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
                at += r["length"]
            assert at <= capacity
            total += at
        want = sorted([*library(r["text"]), 0] for r in docs.collect())
        assert total == sum(map(len, want))
        assert len(by) <= -(-total // capacity) * 1.02 + 1
        ids = {r["sequence_id"]: ids_of(r["ids"]) for r in packing.sequences(packed).collect()}
        assert sorted(len(x) for x in ids.values()) == sorted(sum(r["length"] for r in p) for p in by.values())
    assert packing.pack_documents(nothing, VOCABULARY).count() == 0


def test_added_tokens_are_single_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    from loadlens.llm import tokens as T

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own = T.Encoder(T.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))
    end = "<|endoftext|>"
    texts = ["plain  text", f"a {end} b", end, f"{end}{end}", f"x  {end}  !{end}", f"<|end{end}oftext|>", "", "<|endoftext"]
    assert own.plain
    got = [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)]
    assert got == [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert got[1] == [64, 220, 50256, 275]
