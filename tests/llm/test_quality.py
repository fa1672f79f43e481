from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loadlens.llm import quality as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if count[w] > 1:
            covered |= {k, k + 1, k + 2}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed,
    )


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_statistics_against_brute_force(documents, odd, make):
    runs = make(["a a a a", "a b c a b c", "a b a b a", "x y z\nx y z\n\nx y z \n", "a b c d a b c", "#*\n#*\n $%&|<>"])
    for docs in (documents, odd, runs):
        got = sorted(tuple(r) for r in Q.statistics(docs).select(*COLS).collect())
        assert got == sorted(brute(r["text"]) for r in docs.collect())


def test_nothing_in_nothing_out(spark, nothing, documents):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert Q.judge(nothing, labels).count() == 0
    judged = Q.judge(documents, labels)
    assert judged.where("kept <> (NOT base_failed)").isEmpty()


@pytest.fixture(scope="module")
def labelled(spark):
    """Bad rows: many symbols and few words, or much repetition."""
    rows = spark.range(3_000).select(
        F.col("id").alias("doc_id"),
        (F.pmod(F.xxhash64("id"), F.lit(900)) + 60).alias("n_words"),
        F.lit(3_000).cast("bigint").alias("word_chars"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(600)).alias("n_symbols"),
        F.lit(0).cast("bigint").alias("n_dup_lines"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(60)).alias("n_repeat_words"),
        F.lit(10).cast("bigint").alias("n_lines"),
        F.lit(0).cast("bigint").alias("n_exclaims"),
        F.lit(5).cast("bigint").alias("n_upper"),
    )
    bad = "(n_symbols > 300 AND n_words < 500) OR n_repeat_words >= 55"
    return rows, rows.select("doc_id", F.expr(f"CASE WHEN {bad} THEN 0 ELSE 1 END").alias("quality"))


def test_a_list_learns_a_conjunction(labelled):
    rows, labels = labelled
    train, held = rows.where("doc_id % 4 <> 0"), rows.where("doc_id % 4 = 0")
    rules = Q.learn(train, labels)
    assert any(len(rule) > 1 for rule in rules.rules)
    out = held.withColumn("kept", rules.verdict()).join(labels, "doc_id")
    right = out.where("kept = (quality = 1)").count() / out.count()
    assert right > 0.93
    assert out.where("quality = 1 AND NOT kept").count() < 0.02 * out.where("quality = 1").count()
    assert rules.sql().startswith("CASE WHEN ") and rules.sql().endswith("ELSE true END")


def test_order_of_rules_and_precision(labelled):
    rows, labels = labelled
    assert Q.learn(rows, labels.withColumn("quality", F.lit(1))).rules == []
    noise = rows.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(2))).cast("int").alias("quality"))
    assert Q.learn(rows, noise).rules == []


def test_labels_of_the_table(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = Q.judge(documents, labels).join(labels, "doc_id")
    clean = judged.where("quality = 1 AND NOT base_failed")
    assert clean.where("NOT kept").count() <= 0.02 * clean.count()
