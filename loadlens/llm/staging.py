"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Folders that ``new_folder`` has given out and on whose behalf, for ``clean``.
_made: list[tuple[str, str | None]] = []
_owner: list[str | None] = [None]


@contextmanager
def owned_by(owner: str) -> Iterator[None]:
    """Folders given out inside belong to ``owner``, who can delete them apart from the others."""
    _owner.append(owner)
    try:
        yield
    finally:
        _owner.pop()


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset, one below the warehouse folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staged"
    return folder.rstrip("/")


def find_package(spark: SparkSession) -> None:
    """Let Python workers started from now on import this package from where the driver has it. On
    a cluster without a common folder, ship it with ``--py-files`` as any other package."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((path, _owner[-1]))
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into a new shared folder and read it back: lineage is cut there, so a
    lost executor costs no recomputation and several readers share one computation."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder. Uses the JVM's file system API, since Spark has none of its own; not available
    over Spark Connect."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clean(spark: SparkSession, owner: str | None = None) -> None:
    """Delete the folders that this process has made, or those of ``owner``, once no result reads them
    any more."""
    for path, whose in [x for x in _made if owner is None or x[1] == owner]:
        delete(spark, path)
        _made.remove((path, whose))
