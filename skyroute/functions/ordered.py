"""Row numbers, running totals and successors over a whole table.

A window without a partition key moves every row to one task. Here the rows are written,
dealt to ranges by the bytes that were written, sorted and stored again with their part
and position. Each part is shifted by what the parts before it hold; only those figures,
one row a part, are broadcast. Where rows of one part have to meet again, the parts are
the buckets of the stored table, so there is no second shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyroute.functions.scratch import (
    delete_folder,
    folder_bytes,
    forget_table,
    new_folder,
    write_bucketed,
    write_table,
)

PART, POSITION, COPY = "_part", "_position", "_copy"
PART_BYTES = 64 << 20

# monotonically_increasing_id keeps the row's position in its low 33 bits.
_POSITION_MASK = (1 << 33) - 1


def sort_table(
    df: DataFrame,
    order: Sequence[str | Column],
    keep: Sequence[str] | None = None,
    unique: bool = False,
    bucketed: bool = False,
    size: int | None = None,
) -> DataFrame:
    """Write ``df`` in ``order`` with the columns ``_part`` and ``_position``.

    Equal rows are told apart by a running id, so a large group of copies spreads
    over several ranges; ``unique`` says that ``order`` has no ties. A part has about
    ``PART_BYTES`` as written, whatever the input; there are at least as many parts as
    shuffle partitions. With ``bucketed`` a part's rows are one task's when read.
    ``size`` says that ``df`` is stored in so many bytes already.
    """
    spark = df.sparkSession
    columns = list(keep or df.columns)
    order = list(order)
    if not unique:
        df = df.withColumn(COPY, F.monotonically_increasing_id())
        order.append(COPY)
    raw, folder = new_folder(spark), new_folder(spark)
    try:
        # Written first: the ranges are sampled from it, and its size is known.
        stored = write_table(df, raw) if size is None else df
        size = folder_bytes(spark, raw) if size is None else size
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / PART_BYTES))
        ranged = stored.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        part = F.spark_partition_id()
        if bucketed:
            part = F.get(F.split(F.lit(",".join(map(str, part_names(parts)))), ",").cast("array<int>"), part)
        placed = ranged.select(
            *columns,
            part.alias(PART),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK)).alias(POSITION),
        )
        if not bucketed:
            return write_table(placed, folder)
        table, name = write_bucketed(placed, [PART], parts, folder, dealt=True)
        forget_table(spark, name)
        return table
    finally:
        delete_folder(spark, raw)


def part_names(parts: int) -> list[int]:
    """Ascending names for parts that hash to ``parts`` different buckets, one part each.

    Parts named 0, 1, 2, ... would share some buckets and leave others empty.
    """
    names, taken, begin = [], np.zeros(parts, bool), 0
    while len(names) < parts:  # some parts * ln(parts) numbers in all
        some = np.arange(begin, begin + 4 * parts)
        bucket, at = np.unique(_murmur(some) % parts, return_index=True)
        at = at[~taken[bucket]]
        taken[bucket] = True
        names += sorted(some[at].tolist())
        begin += 4 * parts
    return names


def _murmur(numbers: np.ndarray) -> np.ndarray:
    """Spark's ``hash`` of integers, which buckets are dealt by."""
    word = lambda x: x & 0xFFFFFFFF
    turned = lambda x, n: word(x << n) | x >> 32 - n
    k = turned(word(numbers.astype(np.uint64) * 0xCC9E2D51), 15)
    h = word(turned(42 ^ word(k * 0x1B873593), 13) * 5 + 0xE6546B64) ^ 4
    h = word((h ^ h >> 16) * 0x85EBCA6B)
    h = word((h ^ h >> 13) * 0xC2B2AE35)
    return (h ^ h >> 16).astype(np.uint32).view(np.int32).astype(np.int64)


def _offsets(table: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Per part, the sums over all earlier parts: one row a part, hence broadcast."""
    totals = table.groupBy(PART).agg(*[v.alias(k) for k, v in sums.items()])
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    shifted = [F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_before_{k}") for k in sums]
    return F.broadcast(totals.select(PART, *shifted))


def number_rows(
    df: DataFrame, order: Sequence[str | Column], name: str = "number", unique: bool = False
) -> DataFrame:
    """Add the 1-based row number in ``order`` (a total order)."""
    table = sort_table(df, order, unique=unique)
    numbered = table.join(_offsets(table, {"rows": F.count(F.lit(1))}), PART)
    return numbered.select(
        (F.col("_before_rows") + F.col(POSITION) + 1).alias(name), *df.columns
    )


def running_totals(
    df: DataFrame, order: Sequence[str | Column], totals: dict[str, str], size: int | None = None
) -> DataFrame:
    """Add, per entry ``new: column``, the sum of ``column`` up to and with each row.

    ``size`` is as in ``sort_table``.
    """
    table = sort_table(df, order, unique=True, bucketed=True, size=size)
    sums = {c: F.sum(c) for c in totals.values()}
    within = (
        Window.partitionBy(PART)
        .orderBy(POSITION)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = table.join(_offsets(table, sums), PART)
    return joined.select(
        *df.columns,
        *[(F.col(f"_before_{c}") + F.sum(c).over(within)).alias(new) for new, c in totals.items()],
    )


def with_successor(
    df: DataFrame, order: Sequence[str | Column], keep: Sequence[str], name: str = "next", size: int | None = None
) -> DataFrame:
    """Add the struct of the ``keep`` columns of the following row, null on the last.

    This is ``lead`` over the whole table: a caller who wants it per group compares
    the group's column with the successor's, and no group has to fit one task. ``size`` is
    as in ``sort_table``.
    """
    table = sort_table(df, order, keep=keep, bucketed=True, size=size)
    whole = F.struct(*keep)
    within = Window.partitionBy(PART).orderBy(POSITION)
    heads = table.filter(F.col(POSITION) == 0).select(
        PART, F.lead(whole).over(Window.orderBy(PART)).alias("_head_after")
    )
    led = table.withColumn("_within", F.lead(whole).over(within))
    return led.join(F.broadcast(heads), PART).select(
        *keep, F.coalesce("_within", "_head_after").alias(name)
    )
