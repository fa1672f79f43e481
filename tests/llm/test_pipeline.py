from __future__ import annotations

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline as P
from loadlens.llm import quality, secret_scan, staging
from tests.llm.test_near import brute


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Each stage's documents, by the functions of STAGES."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out, left = [docs], []
    for name, stage in P.STAGES:
        out.append(staging.stage(stage(spark, out[-1], sf_dir), name.replace(" ", "-")))
        left.append({path for path, whose in staging._made if whose == P.OWNER})
    # no stage finds what the ones before it have stored
    assert all(not a & b for k, a in enumerate(left) for b in left[k + 1 :])
    # kept outside the folders that other tests clean
    staging._made.clear()
    return out


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_names_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality rules", "exact dedup", "near dedup", "secret scan", "best-fit packing"]
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_quality_stage(spark, sf_dir, stages):
    judged = quality.judge(stages[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = {r["doc_id"] for r in judged.where("kept").collect()}
    assert rows(stages[1]) == [x for x in rows(stages[0]) if x[0] in kept]


def test_dedup_stages_against_brute_force(stages):
    last = {}
    for doc, text in rows(stages[1]):
        last[text] = doc
    assert rows(stages[2]) == sorted((d, t) for t, d in last.items())
    linked = brute(rows(stages[2]), 5, 80)
    assert rows(stages[3]) == [(d, t) for d, t in rows(stages[2]) if linked[d][2]]


def test_secret_stage_masks_and_keeps(stages):
    before, after = dict(rows(stages[3])), dict(rows(stages[4]))
    assert set(before) == set(after)
    changed = [d for d in before if before[d] != after[d]]
    assert all(secret_scan.MASK in after[d] for d in changed)
    assert stages[4].where(F.col("n_chars") != F.length("text")).isEmpty()
    assert not any("AKIA" in t for t in after.values())


def test_packing_stage_holds_the_ids_of_the_masked_texts(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows(stages[4]))
    out = stages[5]
    assert out.agg(F.sum("length")).first()[0] == want
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").isEmpty()
    assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == {d for d, _ in rows(stages[4])}


def test_registered_with_the_other_queries():
    names = entry_point.queries()
    assert names["pipeline"] is P.run
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


TALK = "the long road went over hills and rivers to a town where people sold bread cheese and apples in the square "


def odd_rows(spark, texts):
    """Rows with no id, a shared id, NULL columns, repeated rows, and columns with names that clash."""
    rows = [(k, t, "en", "src", 1) for k, t in texts]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    made = spark.createDataFrame([*rows, (None, None, None, None, None)], schema)
    return made.withColumns({c: F.lit("x") for c in "__id __spans row spans id own digest kept words".split()})


def test_quality_stage_judges_rows_and_not_ids(spark, sf_dir):
    words = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)]
    good = " ".join(words)
    docs = odd_rows(spark, [(0, good), (0, "short text"), (None, good), (None, "short"), (5, None), (6, ""), (7, good), (7, good)])
    out = P.quality_stage(spark, docs, sf_dir)
    assert out.dtypes == docs.dtypes
    assert sorted((str(r["doc_id"]), r["text"]) for r in out.collect()) == sorted((i, good) for i in ("0", "None", "7", "7"))
    assert P.quality_stage(spark, docs.limit(0), sf_dir).count() == 0


def test_secret_stage_masks_rows_and_not_ids(spark, sf_dir):
    key = "AKIA" + "Q7ZP2MX4KD9RT5WB"
    docs = odd_rows(spark, [(None, f"x {key} y"), (1, f"z {key}"), (1, "plain alpha beta gamma delta alphabet"), (2, ""), (3, f"z {key}"), (3, f"z {key}")])
    out = P.secret_stage(spark, docs, sf_dir)
    assert out.dtypes == docs.dtypes
    masked = sorted((str(r["doc_id"]), str(r["text"]), r["n_chars"]) for r in out.collect())
    want = [("None", "x [SECRET] y"), ("1", "z [SECRET]"), ("1", "plain alpha beta gamma delta alphabet"), ("2", ""), ("3", "z [SECRET]"), ("3", "z [SECRET]")]
    assert masked == sorted([(i, t, len(t)) for i, t in want] + [("None", "None", None)])
    assert P.secret_stage(spark, docs.limit(0), sf_dir).count() == 0
    found = secret_scan.scan(docs)
    own = secret_scan.redact(docs, found)
    assert own.drop("n_chars").exceptAll(out.drop("n_chars")).isEmpty() and out.drop("n_chars").exceptAll(own.drop("n_chars")).isEmpty()


def test_other_stages_on_odd_rows(spark, sf_dir):
    docs = odd_rows(spark, [(0, "a b"), (None, "a b"), (4, "a b"), (5, None), (6, ""), (7, TALK), (7, TALK), (None, TALK)])
    kept = sorted((str(r["doc_id"]), str(r["text"])) for r in P.exact_stage(spark, docs, sf_dir).collect())
    assert kept == sorted([("4", "a b"), ("6", ""), ("7", TALK), ("7", TALK)])
    near = P.near_stage(spark, docs, sf_dir)
    assert near.dtypes == docs.dtypes and near.where("doc_id IS NULL").count() == 3
    packed = P.packing_stage(spark, docs, sf_dir)
    assert packed.count() == 9 and packed.where("doc_id IS NULL").count() == 3
    for stage in (P.exact_stage, P.near_stage, P.packing_stage):
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_run_leaves_only_what_its_rows_are_read_from(spark, sf_dir):
    import os

    root = staging.shared_folder(spark).removeprefix("file:")
    old = set(os.listdir(root))
    assert P.run(spark, sf_dir).count() > 0
    assert {x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - old} == {"secret-scan", "pieces", "lengths"}
