"""A table of versioned rows by key that stays where it is while rounds change it.

The rows are bucketed by key once. A round appends only the rows it changed, as a new
partition ``round`` in the same buckets, so messages that are hashed by the key meet the
rows they concern without these being shuffled, and what a round writes is as large as
what it changed. The newest version of a key counts. When the appended versions outnumber
the rows there were, and ``least``, the newest ones are written anew, again without a
shuffle, so the versions stay below twice the rows and what one round may append.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skyroute.functions.scratch import delete_folder, new_folder, write_table

ROUND = "_round"
COMPACT_FROM = 1_000_000


class Resident:
    """Rows of ``rows`` by ``keys``, which identify them."""

    def __init__(self, rows: DataFrame, keys: Sequence[str], least: int = COMPACT_FROM):
        self.least = least
        self.spark = rows.sparkSession
        self.keys = list(keys)
        self.columns = rows.columns
        # The number of buckets is that of the shuffles, or Spark would deal one side anew.
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.round = 0
        self._create(rows.repartition(self.buckets, *self.keys).withColumn(ROUND, F.lit(0)))

    def _create(self, rows: DataFrame) -> None:
        self._folder, self._table = new_folder(self.spark), f"skyroute_{uuid.uuid4().hex}"
        written = Observation()
        try:
            (
                rows.observe(written, F.count(F.lit(1)).alias("n"))
                .write.partitionBy(ROUND)
                .bucketBy(self.buckets, *self.keys)
                .sortBy(*self.keys)
                .option("path", self._folder)
                .saveAsTable(self._table)
            )
            self.base, self.added = written.get["n"], 0
        except BaseException:
            self.drop()
            raise

    def versions(self) -> DataFrame:
        """All versions of all rows, with their round."""
        return self.spark.table(self._table)

    def _newest(self) -> tuple[list[str], Column]:
        others = [c for c in self.columns if c not in self.keys]
        return others, F.max_by(F.struct(*others, ROUND), ROUND).alias("_row")

    def _latest(self) -> DataFrame:
        others, newest = self._newest()
        found = self.versions().groupBy(*self.keys).agg(newest)
        return found.select(*self.keys, *[F.col("_row")[c].alias(c) for c in (*others, ROUND)])

    def latest(self) -> DataFrame:
        """The newest version of each row, without a shuffle."""
        return self._latest().select(*self.columns)

    def changed(self) -> DataFrame:
        """The rows that the last round appended; at first all."""
        return self.versions().filter(F.col(ROUND) == self.round).drop(ROUND)

    def join_latest(self, rows: DataFrame) -> DataFrame:
        """``rows``, one a key, with the columns of the newest version, null where there is none.

        ``rows`` must not have those columns. Only they are shuffled, if they are not
        hashed by the keys already; they are hashed in memory and the versions stream by.
        """
        others, newest = self._newest()
        own = [c for c in rows.columns if c not in self.keys]
        met = rows.hint("shuffle_hash").join(self.versions(), self.keys, "left")
        found = met.groupBy(*self.keys).agg(newest, *[F.first(c).alias(c) for c in own])
        return found.select(*self.keys, *own, *[F.col("_row")[c].alias(c) for c in others])

    def append(self, rows: DataFrame) -> int:
        """Append new versions, at most one a key; the number of them."""
        self.round += 1
        written = Observation()
        counted = rows.observe(written, F.count(F.lit(1)).alias("n"))
        # It may read the table it is appended to: only earlier rounds are read.
        counted.select(*self.columns, F.lit(self.round).alias(ROUND)).write.insertInto(self._table)
        n = written.get["n"]
        self.added += n
        if self.added > max(self.base, self.least):
            self._compact()
        return n

    def _compact(self) -> None:
        """Keep the newest versions alone; those of the last round stay in theirs."""
        old = self._table, self._folder
        number = F.when(F.col(ROUND) == self.round, F.col(ROUND)).otherwise(0)
        self._create(self._latest().withColumn(ROUND, number))
        self._delete(*old)

    def _delete(self, table: str, folder: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        delete_folder(self.spark, folder)

    def drop(self) -> None:
        self._delete(self._table, self._folder)

    def finish(self) -> DataFrame:
        """The newest versions as a table of their own; the store is deleted."""
        out = write_table(self.latest())
        self.drop()
        return out
