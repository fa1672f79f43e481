"""Writing: whole targets, slices of a target, side tables, and table housekeeping."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadlens.operators.columns import conform


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace all rows of an existing table; columns are matched by name, not position."""
    target = df.sparkSession.table(table).schema
    conform(df, target).write.insertInto(table, overwrite=True)


def overwrite_slice(df: DataFrame, path: str, slice_: Mapping[str, str]) -> None:
    """Replace one partition of a partitioned Parquet target and leave the others alone.

    Every row must belong to the slice, else the write fails before anything changes. An
    empty frame leaves an empty slice. Partition values are compared as text. ``df`` runs
    once: its rows are counted as they are written. Writers do not exclude each other here;
    ``slices.SliceTable`` has that.
    """
    checked = df
    for c, v in slice_.items():
        text = F.col(c).cast("string")
        checked = checked.withColumn(
            c,
            F.when(text == v, F.col(c)).otherwise(
                F.raise_error(F.concat(F.lit(f"row outside the slice {c}={v}: "), F.coalesce(text, F.lit("NULL"))))
            ),
        )
    seen = Observation()
    (
        checked.observe(seen, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*slice_)
        .parquet(path)
    )
    if not seen.get["n"]:  # a dynamic overwrite leaves partitions alone that have no rows
        folder = "/".join(f"{c}={v}" for c, v in slice_.items())
        empty = df.sparkSession.createDataFrame([], df.drop(*slice_).schema)
        empty.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{folder}")


def checkpoint_table(df: DataFrame, name: str, location: str) -> DataFrame:
    """Write an intermediate as Parquet below a location, let the name point to it and read it back.

    The name is a view of the newest snapshot's folder, and the metastore replaces a view in one
    step: a reader finds the old snapshot or the new one, never none. ``df`` may read the table it
    replaces, and a write that fails leaves it as it was. Columns may change. The files of the
    snapshots before stay for readers that still use them; ``delete_folder`` removes them. A plain
    table of that name, as earlier versions of this library left them, is dropped first.
    """
    spark = df.sparkSession
    folder = f"{location.rstrip('/')}/{name.split('.')[-1].upper()}-{uuid4().hex[:8]}"
    df.write.parquet(folder)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")
    return spark.table(name)


def manage_output(df: DataFrame, name: str, mode: int = 0) -> DataFrame:
    """Keep an intermediate: 0 view only, 1 cached view, 2 cache, 3 memory and disk."""
    if mode == 0:
        df.createOrReplaceTempView(name)
    elif mode == 1:
        df.createOrReplaceTempView(name)
        df.sparkSession.sql(f"CACHE TABLE {name}")
    elif mode == 2:
        df = df.cache()
    elif mode == 3:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    else:
        raise ValueError(f"unknown output mode: {mode}")
    return df


def drop_tables_with_suffix(spark: SparkSession, db: str, suffix: str) -> list[str]:
    """Drop the tables of a database, side tables included, whose name ends with ``suffix`` in any case."""
    gone = [t for t in spark.catalog.listTables(db) if not t.isTemporary and t.name.upper().endswith(suffix.upper())]
    for t in gone:
        spark.sql(f"DROP {'VIEW' if t.tableType == 'VIEW' else 'TABLE'} IF EXISTS {db}.{t.name}")
    return [t.name for t in gone]


def _spec(spec: Mapping[str, str]) -> str:
    return ", ".join(f"{c} = '{v}'" for c, v in spec.items())


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder in any store Spark can reach.

    Spark has no public call for it, so this goes to the JVM's file system API and does
    not work over Spark Connect.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_partition(
    spark: SparkSession, table: str, spec: Mapping[str, str], purge_path: str | None = None
) -> None:
    """Drop one partition; with ``purge_path``, the files of an external table as well, by
    ``delete_folder`` (not over Spark Connect)."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(spec)})")
    if purge_path:
        delete_folder(spark, purge_path.rstrip("/") + "/" + "/".join(f"{c}={v}" for c, v in spec.items()))


# Folders that ``staging_folder`` has given out, and the bucketed tables in some of them.
_staged: list[str] = []
_tables: list[str] = []


def staging_folder(spark: SparkSession, root: str | None = None) -> str:
    """A new folder below ``root``, the shared checkpoint folder that the cluster names, or the
    session's warehouse folder, whichever is given first."""
    root = root or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
    _staged.append(f"{root.rstrip('/')}/staged-{uuid4().hex}")
    return _staged[-1]


# While an intermediate is written: its shuffle files go as soon as it is stored, since nothing reads them
# any more, and wide steps are not left to the interpreter, as the JVM does with larger methods.
WHILE_STAGING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for a while; afterwards the session has those from before."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# Joins of tables that are dealt by some of the join's columns: no further shuffle by all of them.
BY_SOME_KEYS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def staged(df: DataFrame, root: str | None = None, *, by_some_keys: bool = False) -> DataFrame:
    """Write an intermediate that several branches read, and read it back as a table.

    One run of the lineage instead of one per branch, column pruning for each reader, and
    nothing to recompute when an executor is lost. The shuffle files of the run are removed when it
    ends; ``clean_staged`` removes what it has written. With ``by_some_keys``, a join runs within the
    partitions of a side that is dealt by part of its key; not for keys of which one part may be hot.
    """
    folder = staging_folder(df.sparkSession, root)
    with settings(df.sparkSession, WHILE_STAGING | (BY_SOME_KEYS if by_some_keys else {})):
        df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def staged_by(df: DataFrame, keys: Sequence[str], buckets: int, root: str | None = None) -> DataFrame:
    """``staged``, but bucketed and sorted by ``keys``, one file a bucket.

    Tables stored by the same keys and number of buckets are joined and aggregated by them, or by
    them and further columns, without a shuffle. All rows of a key are one task's: keep hot keys
    out. Spark knows the buckets from its catalogue only, so this leaves a table there as well.
    """
    spark, folder = df.sparkSession, staging_folder(df.sparkSession, root)
    name = f"by_{keys[0]}_{uuid4().hex}"
    dealt = df.repartition(buckets, *keys)  # by the same hash as the buckets: a task writes one of them
    with settings(spark, WHILE_STAGING):
        dealt.write.bucketBy(buckets, *keys).sortBy(*keys).options(path=folder, compression="zstd").format("parquet").saveAsTable(name)
    _tables.append(name)
    return spark.table(name)


def clean_staged(spark: SparkSession) -> None:
    """Delete what ``staged`` and ``staged_by`` have written in this process, once no result reads it any more."""
    while _tables:
        spark.sql(f"DROP TABLE IF EXISTS {_tables.pop()}")
    while _staged:
        delete_folder(spark, _staged.pop())
