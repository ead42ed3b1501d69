"""Tables written to the shared scratch folder.

An iterative job writes its state once a round, so each round plans against a
short lineage and a lost executor costs only the round under way. The folder is
``spark.checkpoint.dir``; a machine-local one is made only for a local master.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: list[tempfile.TemporaryDirectory] = []
_scopes: list[list[str]] = []


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not _local_folders:
        _local_folders.append(tempfile.TemporaryDirectory(prefix="skyroute-"))
    return _local_folders[0].name


def new_folder(spark: SparkSession) -> str:
    folder = f"{scratch_root(spark)}/skyroute/{uuid.uuid4().hex}"
    for made in _scopes[-1:]:
        made.append(folder)
    return folder


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the scratch folders that were made inside.

    Tables of operators read their folders when they are evaluated, so write or collect
    results inside, and make a folder for what shall stay outside.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for folder in _scopes.pop():
            delete_folder(spark, folder)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of a scratch folder's files."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def write_table(df: DataFrame, path: str | None = None, hashes: bool = False) -> DataFrame:
    """Write ``df`` as parquet and return a scan of it (replaces what is at ``path``).

    No dictionaries are tried for a table of ``hashes``, which are all different.
    """
    spark = df.sparkSession
    path = path or new_folder(spark)
    out = df.write.mode("overwrite").option("parquet.enable.dictionary", str(not hashes).lower())
    out.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no table handed to a caller reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_bucketed(
    df: DataFrame, keys: Sequence[str], buckets: int, path: str, dealt: bool = False
) -> tuple[DataFrame, str]:
    """Write ``df`` bucketed on ``keys``; return the table and its name.

    A join or aggregation on ``keys`` reads the buckets as they are, without a shuffle.
    Rows are hashed by the keys first, unless they are ``dealt`` so that the rows of one
    key are in one task.
    """
    spark = df.sparkSession
    name = f"skyroute_{uuid.uuid4().hex}"
    rows = df if dealt else df.repartition(buckets, *keys)
    rows.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return spark.table(name), name


def forget_table(spark: SparkSession, name: str) -> None:
    """Take a table with a path of its own out of the catalog; its files stay, and frames
    that read it go on doing so."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


class TwoSlots:
    """Alternate between two paths, so a round reads one and replaces the other."""

    def __init__(self, spark: SparkSession):
        self._folder = new_folder(spark)
        self._turn = 0

    def write(self, df: DataFrame) -> DataFrame:
        self._turn = 1 - self._turn
        return write_table(df, f"{self._folder}/{self._turn}")

    def keep_last(self, spark: SparkSession) -> None:
        """Delete the state before the last one."""
        delete_folder(spark, f"{self._folder}/{1 - self._turn}")
