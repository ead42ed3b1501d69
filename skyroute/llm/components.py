"""Connected components of a link table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyroute.functions.scratch import TwoSlots


def connect(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every node that is not its component's smallest.

    ``links`` has two columns of one orderable type. Each round hangs the larger
    neighbours of every node under its smallest one, then the smaller ones; rounds grow
    with the logarithm of the longest path. The state is written each round, so lineage
    stays one round long. Links to oneself and repeated links change
    nothing; a link with a null end is no link.
    """
    a, b = links.columns
    spark = links.sparkSession
    slots = TwoSlots(spark)
    ordered = links.dropna().select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    ordered = ordered.filter("u <> v").distinct()
    state = slots.write(ordered)
    seen = None
    while True:
        now = state.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen or not now[0]:
            break
        seen = now
        both = state.unionAll(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = slots.write(small.unionAll(smallest.select("u", F.col("m").alias("v"))).distinct())
    return state.select(F.col("u").alias("node"), F.col("v").alias("root"))
