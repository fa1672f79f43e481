from __future__ import annotations

import hashlib
from pathlib import Path

import pytest

from loadlens.llm import exact_dedup as X
from loadlens.llm import staging


def rows(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in df.collect()}


def test_largest_id_stays_and_empty_equals_null(make):
    out = X.dedup(make(["a", None, "a", "", "b", "a "]))
    assert rows(out) == {0: (2, 2, False), 1: (3, 2, False), 2: (2, 2, True), 3: (3, 2, True), 4: (4, 1, True), 5: (5, 1, True)}
    assert {r["text_sha256"] for r in out.where("doc_id IN (1, 3)").collect()} == {hashlib.sha256(b"").hexdigest()}


def test_a_second_batch_meets_the_index(spark, make):
    index = X.open_index(spark, staging.new_folder(spark, "index"), buckets=4)
    X.add_batch(make([(1, "a"), (2, "b")]), index).collect()
    second = rows(X.add_batch(make([(7, "a"), (8, "c"), (9, "c")]), index))
    assert second == {7: (1, 2, False), 8: (9, 2, False), 9: (9, 2, True)}
    assert sorted(r["keep_id"] for r in spark.table(index).collect()) == [1, 2, 9]
    plan = spark.table(index).groupBy("digest").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # dealt and sorted by digest already
    again = rows(X.add_batch(make([(20, "c")]), index))
    assert again == {20: (9, 3, False)} and spark.table(index).count() == 3


def test_a_hot_text_is_whole(make):
    out = X.dedup(make([(k, "hot" if k % 3 else f"t{k}") for k in range(900)]))
    hot = out.where("group_size = 600")
    assert hot.count() == 600 and [r["doc_id"] for r in hot.where("kept").collect()] == [899]


def test_odd_rows_and_none(odd, nothing):
    out = X.dedup(odd)
    assert out.count() == odd.count()
    assert X.dedup(nothing).count() == 0
    kept = X.keep_one(odd)
    assert kept.columns == odd.columns
    assert kept.where("text = 'alone here'").count() == 1 and kept.where("text = 'a'").count() == 1


@pytest.fixture
def many_partitions(spark, monkeypatch):
    """40 shuffle partitions, and repartition by a key into 40 at least, as on a cluster that deals finely."""
    frame = type(spark.range(0))
    deal = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, n, *keys: deal(self, max(n, 40) if keys else n, *keys))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    yield 40
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_new_index_has_one_file_a_task(make, many_partitions):
    assert X.dedup(make([f"t{k % 900}" for k in range(1000)])).where("kept").count() == 900
    (folder,) = {path for path, _ in staging._made if "digest-index" in path}
    assert len(list(Path(folder).rglob("part-*.parquet"))) <= many_partitions
