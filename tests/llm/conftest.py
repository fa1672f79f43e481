from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loadlens.llm import staging

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(autouse=True)
def clean(spark):
    staging.find_package(spark)
    yield
    staging.clean(spark)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts, or from (id, text) pairs, with columns whose names the operators use."""

    def build(items):
        pairs = [x if isinstance(x, tuple) else (k, x) for k, x in enumerate(items)]
        df = spark.createDataFrame([(i, t, "en", "src", None) for i, t in pairs], SCHEMA)
        clashes = "digest keep_id kept spans start stop ids words row node bands component_id value features secret length"
        return df.withColumns({c: F.lit("x") for c in clashes.split()}).repartition(3)

    return build


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Texts that every operator must take: none, empty, blank, short, repeated, odd characters, long.
ODD = [
    None, "", " ", "\n\t \x0b", "a", "a", "don't we'll  they've", "\x00\x01 　x", "é中文 ß", "aaaa " * 50,
    "x" * 30_000, "one two three four five six " * 2_000, None,
]


@pytest.fixture(scope="session")
def odd(make):
    return make([*enumerate(ODD), (3, ODD[3]), (None, "a"), (None, "alone here")])


@pytest.fixture(scope="session")
def nothing(make):
    return make([(0, "x")]).limit(0)
